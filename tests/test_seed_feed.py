"""Seed feeds: every row once, wherever a run stops; stored states of any kind."""

import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.sources import seed_feed


@pytest.fixture()
def seed(tmp_path):
    (tmp_path / "seed").mkdir()
    (tmp_path / "seed" / "a.csv").write_bytes(b'parcel_id,note\r\n1,"a, ""b""\nc"\r\n\r\n2\r\n,no id\r\n3,x,extra\r\n')
    (tmp_path / "seed" / "b.csv").write_bytes(b"parcel_id,note\n4, y \n5,z")
    return str(tmp_path / "seed")


def test_rows_are_numbered_over_files(spark, seed):
    rows = seed_feed.seed_rows(spark, seed, size=4)
    assert [tuple(r) for r in rows.orderBy("row_no").collect()] == [(1, "1", 'a, "b"\nc'), (2, "2", None), (3, None, "no id"), (4, "3", "x"), (5, "4", " y "), (6, "5", "z")]


@pytest.mark.parametrize("batch", [1, 2, 4, 5, 100])
def test_stop_and_restart_at_any_row(spark, seed, tmp_path, batch):
    known = spark.createDataFrame([("3",)], "parcel_id string")
    valid = F.col("parcel_id").isNotNull()
    states = []
    for k in range(12):
        feed = seed_feed.SeedFeed(spark, str(tmp_path / "feed"))  # as a new run would
        if k == 1:  # a run that stopped after its batch and before its state: the batch comes again
            feed._store = lambda state: (_ for _ in ()).throw(KeyboardInterrupt())
            with pytest.raises(KeyboardInterrupt):
                feed.step(seed_feed.seed_rows(spark, seed), batch, valid, known, ("parcel_id",)) if not states[-1].exhausted else feed._store(None)
            continue
        states.append(feed.step(seed_feed.seed_rows(spark, seed), batch, valid, known, ("parcel_id",)))
        if states[-1].exhausted and k > 1:
            break
    got = sorted(r.row_no for r in feed.accepted().collect())
    assert got == [1, 2, 5, 6]
    end = states[-1]
    assert (end.next_row, end.accepted, end.skipped_existing, end.skipped_invalid, end.exhausted) == (7, 4, 1, 1, True)
    assert feed.step(seed_feed.seed_rows(spark, seed), batch, valid) == end and feed.state() == end


def test_stored_states():
    assert seed_feed.parse_state(json.dumps({"schema_version": "seed-feed.v1", "next_row": 7.9, "accepted": "x", "skipped_existing": True})) == seed_feed.State(next_row=7)
    assert seed_feed.parse_state(json.dumps({"schema_version": "seed-feed.v2", "next_row": -3, "exhausted": True, "accepted": 2})) == seed_feed.State(accepted=2, exhausted=True)
    for odd in ("[]", '{"schema_version": "other"}', "{}"):
        with pytest.raises(ValueError):
            seed_feed.parse_state(odd)


def test_odd_seeds(spark, tmp_path):
    (tmp_path / "e.csv").write_bytes(b"")
    assert seed_feed.seed_rows(spark, str(tmp_path)).count() == 0
    (tmp_path / "h.csv").write_bytes(b"a,b\n")
    assert seed_feed.seed_rows(spark, str(tmp_path)).columns == ["row_no", "a", "b"] and seed_feed.seed_rows(spark, str(tmp_path)).count() == 0
    (tmp_path / "x.csv").write_bytes(b"b,a\n1,2\n")
    with pytest.raises(ValueError):
        seed_feed.seed_rows(spark, str(tmp_path))
