"""The queries of this subpackage by name, and their counterparts in DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfare.llm import (
    backoff_scoring, chat_rotation, conversation_trie, digest_merge, digest_sql, embedding_join, histogram_packing,
    lattice_sampling, merkle_manifest, minhash_dedup, packed_ids, quality_model, ring_sharding, rule_cascade,
)
from wayfare.session import shared_path, ship_package
from wayfare.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]


def public_tokenizer(name: str) -> str:
    """Path of a public tokenizer's file, the same on every executor."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_pivot_join(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_join.linked(table(spark, sf, "embeddings"), cosine=0.95)


def op2_chat_rotation(spark: SparkSession, sf: str) -> DataFrame:
    rotated = chat_rotation.perspectives(table(spark, sf, "conversations"))
    mask = F.transform("spans", lambda s: F.concat_ws("-", s["start"], s["end"]))
    return rotated.select("conv_id", "speaker", "part", "start", "text", F.array_join(mask, " ").alias("mask"))


def op3_packed_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Matrices are written to the shared folder and read back; ids and positions are returned as checksums."""
    path = shared_path(spark, "matrices")
    packed = packed_ids.packed(table(spark, sf, "documents"), public_tokenizer("word_bpe_49k.json"))
    packed_ids.write_matrices(packed, path)
    return spark.read.schema(packed_ids.SCHEMA).parquet(path).select(
        "matrix", "n_rows", "row_length", F.crc32("ids").alias("ids_crc32"), "cu_seqlens", "resets", "doc_ids",
        "starts", "lengths", "rows",
    )


def op4_minhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf, "documents"), size=3, percent=85)


def op5_ring_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return ring_sharding.sharded(table(spark, sf, "documents"), shards=8)


def op6_histogram_packing(spark: SparkSession, sf: str) -> DataFrame:
    tokenizer = public_tokenizer("word_bpe_49k.json")
    return histogram_packing.pack_documents(table(spark, sf, "documents"), tokenizer, capacity=2048)


def op7_backoff_scoring(spark: SparkSession, sf: str) -> DataFrame:
    return backoff_scoring.scored(table(spark, sf, "documents"))


def op8_quality_model(spark: SparkSession, sf: str) -> DataFrame:
    return quality_model.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


def op9_lattice_sampling(spark: SparkSession, sf: str) -> DataFrame:
    """Ids are returned as number and checksum; round_trip says whether they decode to the normalised text."""
    model = public_tokenizer("piece_bpe_32k.model")
    sampled = lattice_sampling.segmentations(table(spark, sf, "documents"), model, checked=True)
    back = F.col("decoded_crc32") == F.col("text_crc32")
    return sampled.select(
        "doc_id", "sample", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"),
        "logp", "value", "inclusion", back.alias("round_trip"),
    )


def op10_rule_cascade(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    text = F.col("text")
    counted = rule_cascade.judged(docs).select(
        "doc_id",
        rule_cascade.n_words(text).alias("n_words"),
        rule_cascade.word_chars(text).alias("word_chars"),
        rule_cascade.n_symbols(text).alias("n_symbols"),
        rule_cascade.n_dup_lines(text).alias("n_dup_lines"),
        rule_cascade.n_repeat_words(text).alias("n_repeat_words"),
        F.col("failed_rule").isNull().alias("passed"),
    )
    base_failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return counted.withColumn("base_failed", base_failed).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (F.col("passed") & ~F.col("base_failed")).alias("kept"),
    )


def op11_digest_merge(spark: SparkSession, sf: str) -> DataFrame:
    return digest_merge.exact_duplicates(table(spark, sf, "documents"), keep="largest")


def op12_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return merkle_manifest.manifest(table(spark, sf, "documents"))


def op13_prefix_trie(spark: SparkSession, sf: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf, "conversations"))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        ship_package(spark)
        return query(spark, sf)

    return run


QUERIES: dict[str, Query] = {
    "op1_pivot_join": _shipped(op1_pivot_join),
    "op2_chat_rotation": op2_chat_rotation,
    "op3_packed_ids": _shipped(op3_packed_ids),
    "op4_minhash_dedup": _shipped(op4_minhash_dedup),
    "op5_ring_sharding": op5_ring_sharding,
    "op6_histogram_packing": _shipped(op6_histogram_packing),
    "op7_backoff_scoring": _shipped(op7_backoff_scoring),
    "op8_quality_model": _shipped(op8_quality_model),
    "op9_lattice_sampling": _shipped(op9_lattice_sampling),
    "op10_rule_cascade": op10_rule_cascade,
    "op11_digest_merge": _shipped(op11_digest_merge),
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_prefix_trie": _shipped(op13_prefix_trie),
}

SQL: dict[str, str] = {
    **digest_sql.SQL,
    "op1_pivot_join": """
        WITH RECURSIVE
        v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
        reach(node, label) AS (
            SELECT a, a FROM links
            UNION SELECT links.b, reach.label FROM reach JOIN links ON links.a = reach.node),
        lowest AS (SELECT node, min(label) AS component FROM reach GROUP BY node),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
        SELECT v.vec_id, coalesce(n, 0) AS n_links, coalesce(component, v.vec_id) AS component_id,
            coalesce(component, v.vec_id) = v.vec_id AS kept
        FROM v LEFT JOIN counts ON counts.a = v.vec_id LEFT JOIN lowest ON lowest.node = v.vec_id
    """,
    "op2_chat_rotation": """
        WITH m AS (
            SELECT conv_id, coalesce(role, 'unknown') AS role, coalesce(text, '') || '<|end|>' || chr(10) AS body,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place
            FROM conversations),
        speakers AS (SELECT DISTINCT conv_id, role AS speaker FROM m WHERE role <> 'system'),
        pieces AS (
            SELECT m.conv_id, speaker, place, (place - 1) // 256 AS part, role = speaker AS learned, body,
                CASE role WHEN 'system' THEN '<|system|>' WHEN speaker THEN '<|assistant|>'
                    ELSE '<|user name=' || role || '|>' END || chr(10) AS head
            FROM m JOIN speakers ON m.conv_id IS NOT DISTINCT FROM speakers.conv_id),
        ends AS (
            SELECT *, sum(length(head) + length(body)) OVER (
                PARTITION BY conv_id, speaker, part ORDER BY place) AS upto
            FROM pieces),
        parts AS (
            SELECT conv_id, speaker, part, string_agg(head || body, '' ORDER BY place) AS text,
                coalesce(string_agg(CASE WHEN learned THEN (upto - length(body))::BIGINT || '-' || upto::BIGINT END,
                    ' ' ORDER BY place), '') AS mask
            FROM ends GROUP BY ALL)
        SELECT conv_id, speaker, part, text, mask, coalesce(sum(length(text)) OVER (
            PARTITION BY conv_id, speaker ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
        FROM parts
    """,
    "op4_minhash_dedup": r"""
        WITH RECURSIVE
        split AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        found AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(w) = 0 THEN []
                WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
            FROM split),
        sizes AS (SELECT doc_id, count(*) AS n FROM found GROUP BY doc_id),
        both_have AS (
            SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
            FROM found a JOIN found b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM both_have JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * c >= 85 * (x.n + y.n - c)),
        edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
        reach(node, label) AS (
            SELECT a, a FROM edges
            UNION SELECT edges.b, reach.label FROM reach JOIN edges ON edges.a = reach.node),
        lowest AS (SELECT node, min(label) AS component FROM reach GROUP BY node)
        SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component, d.doc_id) AS component_id,
            coalesce(component, d.doc_id) = d.doc_id AS kept
        FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN lowest ON lowest.node = d.doc_id
    """,
    "op10_rule_cascade": r"""
        WITH split AS (
            SELECT doc_id, coalesce(text, '') AS t,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                list_filter(string_split(coalesce(text, ''), chr(10)),
                    lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
            FROM documents),
        windows AS (
            SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM split)),
        twice AS (
            SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM windows) WHERE c > 1),
        covered AS (
            SELECT doc_id, count(DISTINCT i + k) AS n
            FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
        counts AS (
            SELECT doc_id, len(w) AS n_words,
                length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
                length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
                len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines,
                coalesce(n, 0) AS n_repeat_words
            FROM split LEFT JOIN covered USING (doc_id)),
        judged AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
            NOT base_failed AND 100 * n_symbols <= 5 * word_chars AND 100 * n_dup_lines <= 50 * n_lines
                AND word_chars >= 2 * n_words AND word_chars <= 15 * n_words AS kept
        FROM judged
    """,
}
