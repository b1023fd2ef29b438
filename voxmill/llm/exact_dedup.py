"""Exact dedup by progressive refinement: length, prefix hash, full hash.

The first scan leaves (length, prefix hash) of each text. Only rows whose length occurs again go on
to the prefix, only those whose (length, prefix hash) occurs again go on to the full hash, which the
second scan takes of the whole text. Rows that dropped out on the way are groups of one.

Survivors reach the second scan as a set of hashed slots: at most ``slots`` of them, so the broadcast is
bounded whatever the corpus. Two groups that share a slot only cost a few needless hashes. No
text is ever shuffled, hot groups are counted by partial aggregation, and the join that hands a
group's keeper back to its members is one that adaptive execution splits where a group is hot.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.llm.common import numbered, pick, stored, text_or_empty, without_space

PREFIX = 64


def _slot(length: Column, prefix: Column, slots: int) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(slots))


def surviving_slots(docs: DataFrame, slots: int = 1 << 18) -> DataFrame:
    """The slots of (length, prefix hash) groups of two rows or more; at most ``slots`` rows."""
    normal = without_space(text_or_empty())
    seen = stored(
        pick(docs, "text")
        .select(F.octet_length(normal).alias("length"), F.xxhash64(F.substring(normal, 1, PREFIX)).alias("prefix"))
        .groupBy("length", "prefix")
        .agg(F.count("*").alias("n")),
        "lengths",
    )
    lengths = seen.groupBy("length").agg(F.sum("n").alias("of_length")).where("of_length > 1")
    return (
        seen.where("n > 1")
        .join(lengths, "length", "left_semi")
        .select(_slot(F.col("length"), F.col("prefix"), slots).alias("slot"))
        .distinct()
    )


def _hashed(docs: DataFrame, digests: bool, slots: int, *more: str) -> DataFrame:
    """doc_id, points, live, text_sha256 and the columns ``more`` of every row; the digest of live rows, or of all."""
    normal = without_space(text_or_empty())
    live = surviving_slots(docs, slots)
    sha = F.sha2(F.col("normal").cast("binary"), 256)
    hashed = (
        pick(docs, "doc_id", "text", *more)
        .select("doc_id", F.char_length(text_or_empty()).alias("points"), normal.alias("normal"), *more)
        .withColumn("slot", _slot(F.octet_length("normal"), F.xxhash64(F.substring("normal", 1, PREFIX)), slots))
        .join(F.broadcast(live.withColumn("live", F.lit(True))), "slot", "left")  # at most `slots` rows
        .select("doc_id", "points", F.col("live").isNotNull().alias("live"), (sha if digests else F.when(F.col("live"), sha)).alias("text_sha256"), *more)
    )
    return stored(hashed, "hashed")


def _order(*more: Column) -> Column:
    return F.struct(F.col("points"), F.col("doc_id").isNotNull().alias("known"), F.bitwise_not(F.col("doc_id")).alias("id_down"), *more)


def exact_dedup(docs: DataFrame, digests: bool = False, slots: int = 1 << 18) -> DataFrame:
    """doc_id, keep_id, group_size, kept (and text_sha256) for every row of docs(doc_id, text).

    Texts are equal when they agree once white space is deleted; null counts as empty. Of equal texts
    the row with the most code points stays, then the smallest doc_id (a null id comes last). digests:
    also the SHA-256 of each normalised text, which single texts otherwise go without. Here ``kept`` tells
    of the id: all rows of a group with the keeper's id have it. Of rows, kept_documents() keeps one a group.
    """
    hashed = _hashed(docs, digests, slots)
    # stored, so that the join below is of plain rows and adaptive execution can split a hot group
    groups = stored(
        hashed.where("live").groupBy("text_sha256").agg(F.count("*").alias("group_size"), F.max(_order()).alias("best"))
        .where("group_size > 1")
        .select("text_sha256", "group_size", F.bitwise_not(F.col("best.id_down")).alias("keep_id")),
        "groups",
    )
    joined = hashed.join(groups, "text_sha256", "left")
    out = joined.select(
        "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | F.col("doc_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        *(["text_sha256"] if digests else []),
    )
    return out


def kept_documents(docs: DataFrame, slots: int = 1 << 18) -> DataFrame:
    """One row of each group of equal texts, with its own columns: the keeper of exact_dedup(), or one of
    several rows with its id. Rows are told apart by number, so null and repeated ids stay where their texts differ.
    """
    rows, number = numbered(docs)
    hashed = _hashed(rows, False, slots, number).where("live")
    # stored, so that the join below is of plain rows and adaptive execution can split a hot group
    groups = stored(
        hashed.groupBy("text_sha256").agg(F.count("*").alias("group_size"), F.max(_order(F.bitwise_not(F.col(number)).alias("row_down"))).alias("best"))
        .where("group_size > 1")
        .select("text_sha256", F.bitwise_not(F.col("best.row_down")).alias("keep_row")),
        "groups",
    )
    gone = hashed.join(groups, "text_sha256").where(F.col(number) != F.col("keep_row")).select(number)
    return rows.join(gone, number, "left_anti").select(*[rows[f"`{c}`"] for c in docs.columns])
