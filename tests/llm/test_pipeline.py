"""The corpus pipeline stage by stage, and the driver's registry."""

from pyspark.sql import functions as F

import corpus_pipeline
from ledgerloom.llm import langid, toxicity

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k == len(corpus_pipeline.STAGES) - 1:
            pieces = docs.toPandas()
            assert set(pieces.doc_id) == {r[0] for r in before.select("doc_id").collect()}
            assert (pieces.groupby("sequence_id").length.sum() <= 2048).all()
            continue
        assert docs.columns == columns and 0 < docs.count() <= kept
        kept = docs.count()
        if name == "toxicity":
            model = toxicity.train(before, spark.read.parquet(f"{SF}/labels.parquet"), where=~toxicity.held_out())
            assert toxicity.toxicity(docs, model).where("predicted = 1").count() == 0
        if name == "language_id":
            net = langid.train(before, where=~langid.held_out())
            assert langid.language(docs, net).where("lang_pred = 'und'").count() == 0
        if name == "simhash_near_dedup":
            pdf = docs.toPandas()
            assert not pdf.text.duplicated().any()
            first = before.toPandas().sort_values("doc_id").drop_duplicates("text").set_index("text").doc_id
            assert all(first[t] == i for t, i in zip(pdf.text, pdf.doc_id))
        if name == "substring_dedup":
            assert docs.count() == before.count() and docs.where("n_chars <> length(text)").count() == 0


def test_stages_of_nothing_and_nulls(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = docs.limit(300).unionByName(spark.createDataFrame([(10**9, None, None, None, None), (10**9 + 1, "", "en", "s", 0), (10**9 + 2, "12 34", None, "s", 5)], docs.schema))
    assert corpus_pipeline.remove_toxic(spark, odd, SF).where("doc_id >= 1000000000").count() == 3
    assert corpus_pipeline.keep_known_languages(spark, odd, SF).where("doc_id >= 1000000000").count() == 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_stages_keep_clashing_columns_and_repeated_rows(spark, tmp_path):
    names = ["score", "predicted", "lang_pred", "fp", "component_id", "copies", "group", "n_words", "kept_text", "removed", "__block"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(250)
    odd = docs.unionByName(docs.limit(20)).withColumns({n: F.concat(F.lit(f"{n} of "), F.col("doc_id").cast("string")) for n in names})
    odd.write.parquet(str(tmp_path / "docs"))
    now = spark.read.parquet(str(tmp_path / "docs"))
    columns = now.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = now.count()
        stage(spark, now, SF).write.parquet(str(tmp_path / name))
        now = spark.read.parquet(str(tmp_path / name))
        assert now.columns == columns and 0 < now.count() <= before
        assert all(r[n] == f"{n} of {r.doc_id}" for r in now.limit(30).collect() for n in names)
    assert now.count() == now.select("doc_id").distinct().count()


def test_registry():
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {n[: n.index("_") + 1] for n in names if n.startswith("op")} and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= names


def test_repeated_rows_and_null_ids_leave_one_document(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    body = " ".join(f"the house number {i} stands beside the river and people of the town walk there" for i in range(12))
    near = body.replace("number 7 ", "number seventy ")
    other = " ".join(f"in summer the garden of family {i} is full of roses that grow over the old wall" for i in range(12))
    rows = [(10**9 + 3, body), (10**9 + 3, body), (None, body), (None, body), (10**9 + 9, near), (None, other), (None, other), (10**9 + 3, other + " at last"), (10**9 + 3, "12 34")]
    odd = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], docs.schema)
    alone = corpus_pipeline.remove_near_duplicates(spark, odd, SF).collect()
    assert sorted((r.doc_id, r.text) for r in alone) == sorted([(10**9 + 3, body), (10**9 + 3, other + " at last"), (10**9 + 3, "12 34")])
    now = docs.limit(300).unionByName(odd.where("text <> '12 34'"))
    for _, stage in corpus_pipeline.STAGES[:-2]:
        now = stage(spark, now, SF)
    assert sorted((r.doc_id, r.text) for r in now.where("doc_id >= 1000000000 or doc_id is null").collect()) == sorted([(10**9 + 3, body), (10**9 + 3, other + " at last")])
    now = corpus_pipeline.remove_repeated_substrings(spark, now, SF)
    assert sorted(r.text for r in now.where("doc_id >= 1000000000").collect()) == sorted([body, other + " at last"])
    assert corpus_pipeline.pack_sequences(spark, now, SF).where("doc_id >= 1000000000 and length < 100").count() == 0
