"""Exact running totals of a stream: against the batch and against brute force, stopped and started again."""

import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.streaming import running_totals as rt


def brute(changes, additive=False):
    out, codes = {}, {}
    for e, pos, kind, own in sorted((c for c in changes if c[0] is not None and c[1] is not None), key=lambda c: c[1]):
        own = [c for c in own or [] if c is not None]
        total, unique, open_, type_, n = out.get(e, (0, 0, 0, None, 0))
        known = codes.setdefault(e, {})
        if kind == rt.ERROR and own:
            total, n, type_ = total + len(own), n + 1, own[0][:2]
            if additive:
                unique, open_ = unique + len(set(own)), open_ + len(set(own))
        for c in dict.fromkeys(own):
            if kind == rt.ERROR and not known.get(c):
                if not additive:
                    unique, open_ = unique + (c not in known), open_ + 1
                known[c] = True
            elif kind == rt.REMOVED and known.get(c):
                open_, known[c] = max(0, open_ - 1), False
        out[e] = (total, unique, open_, type_, n)
    return out


def some(seed, n=300):
    r = random.Random(seed)
    return [(r.choice(["e1", "e2", "e3", "e4", None]), pos if pos % 50 else None, r.choice([rt.ERROR, rt.ERROR, rt.REMOVED, "other"]), r.choice([None, [], [None]] + [[f"{r.randrange(9):05d}" for _ in range(r.randrange(1, 4))] for _ in range(6)])) for pos in range(n)]


def got(df):
    return {r.execution_id: tuple(r)[1:] for r in df.select("execution_id", "total_occurrences", "unique_errors", "open_errors", "error_type", "n_events").collect()}


@pytest.mark.parametrize("additive", [False, True])
def test_stream_equals_brute_force_and_goes_on(spark, tmp_path, additive):
    changes = some(int(additive))
    folder = f"{tmp_path}/run"
    for k, cut in enumerate((0, 100, 180)):  # three batches; the run ends and starts again between them
        part = changes[cut : (100, 180, 300)[k]]
        spark.createDataFrame(part, rt.CHANGES).coalesce(1).write.parquet(f"{tmp_path}/in/{k}")
        stream = spark.readStream.schema(rt.CHANGES).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in/*")
        totals = rt.run_to_end(spark, stream, folder, 4, additive)
        want = brute(changes[: cut + len(part)], additive)
        assert got(totals) == want
    again = rt.run_to_end(spark, spark.readStream.schema(rt.CHANGES).parquet(f"{tmp_path}/in/*"), folder, 4, additive)
    assert got(again) == want, "nothing new: nothing counts twice"
    if not additive:
        batch = got(rt.batch_totals(spark.createDataFrame(changes, rt.CHANGES)))
        assert batch == {e: t for e, t in want.items() if t[4]}


def test_removals_shrink_and_reopened_codes_count_once(spark):
    rows = [("e", 1, rt.ERROR, ["10001", "10001", "10002"]), ("e", 2, rt.REMOVED, ["10001", "10009"]), ("e", 3, rt.ERROR, ["20001"]), ("e", 4, rt.ERROR, ["10001"]), ("e", 5, rt.REMOVED, ["20001"])]
    assert got(rt.batch_totals(spark.createDataFrame(rows, rt.CHANGES))) == {"e": (5, 3, 2, "10", 3)} == brute(rows)
    assert got(rt.batch_totals(spark.createDataFrame([], rt.CHANGES))) == {}
    assert brute(rows, True)["e"][1:3] == (4, 2) and rt.batch_totals(spark.createDataFrame(rows, rt.CHANGES).withColumn("x", F.lit(1))).columns[0] == "execution_id"
