"""One query per operator, over whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.llm import alignment, decontamination, exact_dedup, jaccard_join, licenses, line_dedup, packing, pii, prefix_trie, sharding, suffix_dedup, token_counts, toxicity
from voxmill.llm.common import table

SHARDS = 16


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards of near equal bytes."""
    docs = table(spark, sf_dir, "documents")
    return sharding.shard_documents(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keeper of each document's group of equal texts."""
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), digests=True)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when lines go that equal, or are one edit from, an earlier line."""
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).drop("kept_text")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of each line of every document; a crossing token goes to the line that holds most of it."""
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), rule="most")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps when each repeated string of 200 bytes goes."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document with a passage of the benchmark, and the item."""
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The spans of personal data in every document."""
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The components of documents whose sets of four-word shingles reach 0.85."""
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"), k=4, percent=85)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The groups and links of the tokens of two vocabularies in every document."""
    return alignment.align(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the trie of all rebuilt conversations."""
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence notices, tags and expressions of every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_sharding, op2_exact_dedup, op3_packing, op4_line_dedup, op5_token_counts, op6_suffix_dedup, op7_decontamination, op8_toxicity, op9_pii, op10_jaccard_join, op11_alignment, op12_prefix_trie, op13_licenses)}

ORACLES = {
    "op2_exact_dedup": r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER g AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       doc_id = first_value(doc_id) OVER g AS kept,
       text_sha256
FROM t
WINDOW g AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
""",
    "op12_prefix_trie": r"""
WITH crc AS (
  SELECT list(v ORDER BY i) AS steps
  FROM (SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda s, x: CASE WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END) AS v
        FROM range(256) AS r(i))),
own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
stems AS (
  SELECT o.conv_id, o.turns, s.turns AS head,
         3 - (list_reduce(list_concat([4294967295], list_transform(string_split(o.conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                          lambda s, b: xor(s >> 8, crc.steps[(xor(s, b) & 255) + 1])) & 3) AS h
  FROM own o LEFT JOIN own s ON s.conv_id = o.conv_id - o.conv_id % 20 CROSS JOIN crc),
whole AS (
  SELECT conv_id, list_concat(coalesce(head[1:h], []), turns[h + 1:]) AS turns FROM stems),
prefixes AS (
  SELECT conv_id, turns[1:d] AS p, d, d = len(turns) AS ends FROM whole, LATERAL (SELECT unnest(range(len(turns) + 1)) AS d)),
nodes AS (
  SELECT p, d, min(conv_id) AS conv_id, count(*) AS n,
         coalesce(len(regexp_extract_all(p[-1].t, '[^\x20\x09-\x0D]+')), 0) AS w,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY p, d),
kids AS (SELECT p[1:d - 1] AS p, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
full_nodes AS (SELECT n.*, coalesce(k.n_children, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (p)),
above AS (
  SELECT p[1:a] AS p, sum((n - 1) * w) AS saved, count(*) FILTER (n_children = 0) AS n_leaves
  FROM full_nodes, LATERAL (SELECT unnest(range(d + 1)) AS a) GROUP BY 1)
SELECT f.conv_id, f.d::BIGINT AS depth, u.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, a.n_leaves, a.saved::BIGINT AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN above a USING (p) LEFT JOIN nodes u ON f.d > 0 AND u.p = f.p[1:f.d - 1]
""",
}
