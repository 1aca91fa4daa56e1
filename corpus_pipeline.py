"""From raw documents to packed training sequences, in five stages that each work on what the one before kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. Null
and empty texts pass the toxicity stage, and are rejected by language ID, which finds no letter in them. An empty table
gives an empty result in every stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import langid, packing, simhash, substring_dedup, toxicity

#: Columns that stages read; whatever else documents carry is packed aside, so that no name of theirs can clash.
KNOWN = ("doc_id", "text", "lang", "source", "n_chars")
#: Language ID rejects texts without a letter and those whose best language gets less than this.
LEAST_LANGUAGE_SCORE = 0.35


def packed(docs: DataFrame) -> DataFrame:
    """docs with all other columns than KNOWN in one struct."""
    others = [F.col(f"`{c}`") for c in docs.columns if c not in KNOWN]
    return docs.select(*[c for c in KNOWN if c in docs.columns], *([F.struct(*others).alias("others__")] if others else []))


def unpacked(out: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of packed() documents again, in their order."""
    return out.select(*[F.col(c) if c in KNOWN else F.col("others__").getField(c).alias(c) for c in columns])


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier doesn't reject; it learns from the labels outside fold 2 of 4."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, where=~toxicity.held_out())
    return unpacked(toxicity.toxicity(packed(docs), model).where("predicted = 0"), docs.columns)


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a recognised language; the network learns from those outside fold 1 of 3."""
    net = langid.train(docs, where=~langid.held_out())
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return unpacked(langid.language(packed(docs), net).where(known), docs.columns)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id (nulls last) of each near-duplicate group: fingerprints within two bits, or texts
    whose five-word shingles are similar to 0.8 or more. Repeated rows are one."""
    return unpacked(simhash.one_of_each(packed(docs)), docs.columns)


def remove_repeated_substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with repeated windows of 35 words cut from its text."""
    out = substring_dedup.dedup_substrings(packed(docs))
    out = out.withColumn("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("kept_text").cast(docs.schema["n_chars"].dataType))
    return unpacked(out, docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    import public_tokenizers

    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", remove_toxic),
    ("language_id", keep_known_languages),
    ("simhash_near_dedup", remove_near_duplicates),
    ("substring_dedup", remove_repeated_substrings),
    ("best_fit_packing", pack_sequences),
]

#: SQL can't express learned classifiers; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet to the shared folder and read again by the next."""
    from ledgerloom.llm.cluster import new_folder

    folder = new_folder(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
