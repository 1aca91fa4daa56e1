"""Every query that SQL can express, against DuckDB on the same tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

from ledgerloom.plans import catalog


def rows(df: pd.DataFrame) -> list[tuple]:
    def text(x):
        if isinstance(x, (list, tuple)) or type(x).__name__ == "ndarray":
            return "[" + ",".join(map(text, x)) + "]"
        if x is None or pd.isna(x):
            return "null"
        if isinstance(x, float):
            return f"{x:.6f}"
        return str(x)

    def num(x):
        return float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x

    df = df[sorted(df.columns)]
    return sorted(tuple(text(num(x.item() if hasattr(x, "item") and not hasattr(x, "__len__") else x)) for x in r) for r in df.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for p in Path(sf).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_against_sql(spark, duck, sf, name):
    ours = catalog.QUERIES[name](spark, sf).toPandas()
    theirs = duck.sql(catalog.ORACLE_SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert rows(ours) == rows(theirs)


def test_token_subsequence_against_brute_force(spark, sf):
    from pyspark.sql import functions as F

    from ledgerloom.functions.text import registry_address

    got = {tuple(r) for r in catalog.QUERIES["token_subsequence"](spark, sf).collect()}
    items = {r[0]: r[1].split(" ") for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", registry_address(F.col("text"))).collect()}
    docs = {r[0]: r[1].split(" ") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", registry_address(F.col("text"))).collect()}

    def holds(q, words):
        it = iter(words)
        return " ".join(q) in " ".join(words) or all(w in it for w in q)

    assert got == {(i, d) for i, q in items.items() for d, w in docs.items() if holds(q, w)}


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 10
    assert set(catalog.ORACLE_SQL) <= set(catalog.QUERIES)


def test_token_subsequence_looks_at_whole_items(spark, tmp_path):
    head = "a1 b2 c3 d4 e5 f6 g7 h8"
    spark.createDataFrame([(1, head + " i9"), (2, head + " j10"), (3, head)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    spark.createDataFrame([(1, head), (2, f"x {head} y i9 z"), (3, f"j10 {head}"), (4, f"{head} j10 i9")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {tuple(r) for r in catalog.QUERIES["token_subsequence"](spark, str(tmp_path)).collect()}
    assert got == {(1, 2), (1, 4), (2, 4), (3, 1), (3, 2), (3, 3), (3, 4)}
