"""One query for each operator of this subpackage, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: count and checksum of its ids, digest of the decoded text."""
    import public_tokenizers

    from .sentencepieces import decode, encode

    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
    out = decode(encode(docs, model), model)
    return out.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_ids"),
        F.crc32(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary")).alias("ids_crc32"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
        (F.sha2(F.col("decoded"), 256) == F.col("text_sha256")).alias("round_trip"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated windows of 35 words removed; per document the counts and a digest of the kept text."""
    from .substring_dedup import dedup_substrings

    out = dedup_substrings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text"), 256).alias("kept_sha256"))


def op3_min_cost_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From one shard for each source to 40 shards of near equal bytes, moving the fewest bytes: the affected shards are
    written to the shared folder, and their rows read back from them."""
    from .reshard import reshard

    old = F.coalesce(F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(40)), F.lit(0)).cast("int")
    out = reshard(table(spark, sf_dir, "documents"), old)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "old_shard", "moved")


def op4_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ids written to Arrow sequence files in the shared folder, and every document read back from them."""
    import public_tokenizers

    from .cluster import new_folder
    from .token_store import read_documents, write_sequences

    folder = new_folder(spark, "token-files")
    write_sequences(table(spark, sf_dir, "documents"), folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1, drops_space=True)
    return read_documents(spark, folder)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision for every document; labels of fold 2 of 4 are never learned from."""
    from .toxicity import held_out, toxicity, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), where=~held_out())
    return toxicity(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    from .simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdict of every document, by a decision list learned from the labels."""
    from .cluster import cut
    from .quality_rules import apply_rules, learn_from, statistics

    stats = cut(statistics(table(spark, sf_dir, "documents").select("doc_id", "text")))
    out = apply_rules(stats, learn_from(stats, table(spark, sf_dir, "labels")))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op8_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors found for every twentieth one."""
    from .multi_index import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and its probability for every document; fold 1 of 3 is never learned from."""
    from .langid import held_out, language, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = train(docs, where=~held_out())
    return language(docs.select("doc_id", "text"), net).select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op11_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score and decision for every document; labels of fold 2 of 4 are never learned from."""
    from .subwords import held_out, quality, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels"), where=~held_out())
    return quality(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    from .prefix_trie import trie_nodes

    return trie_nodes(table(spark, sf_dir, "conversations"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    from .ranked_search import search

    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_sentencepiece,
        op2_substring_dedup,
        op3_min_cost_flow_resharding,
        op4_token_id_files,
        op5_toxicity,
        op6_simhash_near_dedup,
        op7_quality_rules,
        op8_multi_index_hashing,
        op9_best_fit_packing,
        op10_language_id,
        op11_subword_quality,
        op12_conversation_trie,
        op13_ranked_search,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op2_substring_dedup": r"""
        WITH words AS (
            SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents),
        starts AS (
            SELECT doc_id, unnest(range(1, len(w) - 33)) AS s, w FROM words WHERE len(w) >= 35),
        wins AS (SELECT doc_id, s, md5(array_to_string(w[s:s + 34], ' ')) AS h FROM starts),
        rep AS (SELECT doc_id, s FROM wins WHERE h IN (SELECT h FROM wins GROUP BY h HAVING count(*) > 1)),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM rep),
        lost AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM gone GROUP BY doc_id)
        SELECT words.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
            sha256(array_to_string(CASE WHEN n IS NULL THEN w
                ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda z: NOT list_contains(ps, z[2])), lambda z: z[1]) END, ' ')) AS kept_sha256
        FROM words LEFT JOIN lost USING (doc_id)""",
    # crc32 is a fold over bits; turns of equal number go by the words and digest of their text and role
    "op12_conversation_trie": r"""
        WITH turns AS (
            SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
                sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] AS id
            FROM conversations WHERE conv_id IS NOT NULL),
        own AS (
            SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, words, id) - 1 AS i, words, id FROM turns),
        convs AS (
            SELECT c AS conv_id, c - c % 20 AS base,
                xor(list_reduce(list_transform(range(1, strlen(c::VARCHAR) + 1), lambda p: ascii(substr(c::VARCHAR, p, 1))::BIGINT),
                    lambda a, b: list_reduce(range(8), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)), xor(a, b)), 4294967295), 4294967295) % 4 AS h
            FROM (SELECT DISTINCT conv_id AS c FROM turns)),
        rebuilt AS (
            SELECT convs.conv_id, 0 AS part, i, words, id FROM convs JOIN own ON own.conv_id = base AND i < h
            UNION ALL SELECT convs.conv_id, 1, i, words, id FROM convs JOIN own ON own.conv_id = convs.conv_id AND i >= h),
        seqs AS (
            SELECT convs.conv_id, coalesce(list(id ORDER BY part, i) FILTER (id IS NOT NULL), []) AS ids, coalesce(list(words ORDER BY part, i) FILTER (id IS NOT NULL), []) AS words
            FROM convs LEFT JOIN rebuilt USING (conv_id) GROUP BY convs.conv_id),
        steps AS (SELECT conv_id, ids, words, unnest(range(0, len(ids) + 1)) AS d FROM seqs),
        paths AS (
            SELECT conv_id, d, sha256(array_to_string(ids[1:d], '')) AS node, CASE WHEN d > 0 THEN sha256(array_to_string(ids[1:d - 1], '')) END AS up,
                CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, d = len(ids) AS last FROM steps),
        nodes AS (
            SELECT node, d, min(up) AS up, min(conv_id) AS conv_id, count(*) AS n, min(words) AS words,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (last), '')) AS ends_sha256
            FROM paths GROUP BY node, d),
        kids AS (SELECT up, d - 1 AS d, count(*) AS n FROM nodes WHERE d > 0 GROUP BY up, d),
        sums AS (
            SELECT p.node, p.d, sum(CASE WHEN k.n IS NULL THEN 1 ELSE 0 END) AS leaves, sum((nodes.n - 1) * nodes.words) AS saved
            FROM nodes LEFT JOIN kids k ON k.up = nodes.node AND k.d = nodes.d
            JOIN paths p ON p.conv_id = nodes.conv_id AND p.d <= nodes.d GROUP BY p.node, p.d)
        SELECT nodes.conv_id, nodes.d::BIGINT AS depth, above.conv_id AS parent_conv_id, nodes.n AS n_convs, coalesce(kids.n, 0)::BIGINT AS n_children,
            sums.leaves::BIGINT AS n_leaves, sums.saved::BIGINT AS saved_tokens, nodes.ends_sha256
        FROM nodes JOIN sums ON sums.node = nodes.node AND sums.d = nodes.d
        LEFT JOIN kids ON kids.up = nodes.node AND kids.d = nodes.d
        LEFT JOIN nodes above ON above.node = nodes.up AND above.d = nodes.d - 1""",
    "op13_ranked_search": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws
            FROM documents),
        stats AS (SELECT count(*) AS docs, sum(len(ws))::BIGINT AS len FROM words WHERE len(ws) > 0),
        tfs AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(ws) AS n, unnest(ws) AS term FROM words) GROUP BY doc_id, n, term),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark),
        weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, stats GROUP BY term, docs),
        scored AS (
            SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // stats.len)))))::BIGINT AS score
            FROM asked JOIN tfs USING (term) JOIN weights USING (term), stats GROUP BY item_id, doc_id)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score
        FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 10""",
}
