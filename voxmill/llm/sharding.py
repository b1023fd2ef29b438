"""Sharding by sampled splitters.

Records get a 64-bit key whose high bits hash the text, so equal texts lie side by side, and
whose low bits hash the record's id, so that a hot text can still be cut. A size-weighted sample
of keys gives quantile boundaries; records fall into the ranges between them; a range that turns
out overfull is sampled again, at a higher rate, and subdivided until it fits. Exact sums per range
and a running sum inside each range then give every record its place in the whole order, and the
order cut into equal shares of bytes gives the shards.

Work: one scan of the texts, which leaves a slim table (id, size, checksum, key); all else runs on
that. One shuffle of the slim table by range. To the driver come the boundaries and one
row per range, both bounded by ``ranges`` and not by the data.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxmill.llm.common import pick, stored

LOW_BITS = 24


def record_key(text: Column, record_id: Column) -> Column:
    """40 bits of the text's hash, then 24 bits of the id's."""
    low = (1 << LOW_BITS) - 1
    return F.xxhash64(text).bitwiseAND(F.lit(~low)).bitwiseOR(F.xxhash64(record_id, F.lit(7)).bitwiseAND(F.lit(low)))


def _range_of(key: Column, bounds: list[int]) -> Column:
    """How many of the sorted ``bounds`` are at or under ``key``, by binary search in a folded constant."""
    if not bounds:
        return F.lit(0)
    array = F.split(F.lit(",".join(map(str, bounds))), ",").cast("array<bigint>")
    steps = F.lit([1 << b for b in reversed(range(len(bounds).bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= len(bounds)) & (F.get(array, at + step - 1) <= key), at + step
        ).otherwise(at),
    )


def _sampled(slim: DataFrame, rate: Column) -> list[int]:
    """Keys drawn with a chance of ``rate`` x size. The draw hashes the key, so a rerun draws the same."""
    u = F.shiftrightunsigned(F.xxhash64("key", F.lit(11)), 11) / F.lit(float(1 << 53))
    return [r[0] for r in slim.where(u < rate * F.col("size")).select("key").distinct().collect()]


def splitters(slim: DataFrame, ranges: int, oversampling: int = 8, rounds: int = 4) -> tuple[list[int], list]:
    """Boundaries, and (range, bytes, rows) of each range that has rows.

    slim: has ``key`` and ``size``. A range is overfull beyond twice its share; its part of the next
    sample is drawn at a rate that rises with its excess. It ends when none is overfull or all that
    are hold one key only.
    """
    total = slim.agg(F.sum("size"), F.count("*")).first()
    if not total[1]:
        return [], []
    drawn = sorted(_sampled(slim, F.lit(ranges * oversampling / total[0])))
    bounds = drawn[oversampling // 2 :: oversampling]
    for turn in range(rounds + 1):
        filled = (
            slim.groupBy(_range_of(F.col("key"), bounds).alias("range"))
            .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("key").alias("least"), F.max("key").alias("most"))
            .collect()
        )
        full = [r for r in filled if r.least != r.most and (r.bytes > 2 * total[0] / ranges or r.rows > 4 * total[1] / ranges)]
        if turn == rounds or not full:
            return bounds, sorted((r.range, r.bytes, r.rows) for r in filled)
        pieces = {r.range: -(-max(r.bytes * ranges // total[0], r.rows * ranges // (2 * total[1])) // 1) + 1 for r in full}
        mapping = F.from_json(F.lit("{" + ",".join(f'"{k}":{oversampling * v}' for k, v in pieces.items()) + "}"), "map<string,double>")
        spread = F.from_json(F.lit("{" + ",".join(f'"{r.range}":{r.bytes}' for r in full) + "}"), "map<string,double>")
        at = _range_of(F.col("key"), bounds).cast("string")
        again = sorted(_sampled(slim.withColumn("at", at), F.coalesce(F.try_element_at(mapping, F.col("at")) / F.try_element_at(spread, F.col("at")), F.lit(0.0))))
        inside: dict[int, list[int]] = {}
        for k in again:
            inside.setdefault(bisect_right(bounds, k), []).append(k)
        new = {k for v in inside.values() for k in v[oversampling // 2 :: oversampling] or v[len(v) // 2 :][:1]}
        bounds = sorted({*bounds, *new})
    raise AssertionError("unreachable")


def shard(records: DataFrame, shards: int, ranges: int = 1024, law: str = "bytes", split: tuple[list[int], list] | None = None) -> DataFrame:
    """``records`` with ``shard`` (0 to shards - 1) and ``slot`` (gapless from 0 in each shard).

    records: has ``key`` long and ``size`` long > 0; other columns are carried along. law ``bytes``:
    shards are equal in bytes to within one record on either side; ``rows``: in rows, to within one.
    An empty table gives an empty result; repeated rows each get a slot of their own. Rows whose keys
    are equal can't be told apart by a range, so they meet in one task as slim rows. split: what ``splitters`` gave for
    the same keys and sizes, if known.
    """
    if law not in ("bytes", "rows"):
        raise ValueError(f"no such law: {law}")
    spark = records.sparkSession
    bounds, filled = split or splitters(records, ranges)
    total = sum(b for _, b, _ in filled) if law == "bytes" else sum(n for _, _, n in filled)
    starts, seen_bytes, seen_rows = [], 0, 0
    for r, b, n in filled:
        starts.append((r, seen_bytes, seen_rows))
        seen_bytes, seen_rows = seen_bytes + b, seen_rows + n
    start = spark.createDataFrame(starts, "range int, bytes_before long, rows_before long")
    others = [c for c in ("doc_id",) if c in records.columns]
    inside = Window.partitionBy("range").orderBy("key", *others, "size")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = F.col("bytes_before") + F.col("run") - F.col("size") if law == "bytes" else F.col("rows_before") + F.col("nth") - 1
    placed = (
        records.withColumn("range", _range_of(F.col("key"), bounds))
        .withColumn("run", F.sum("size").over(running))
        .withColumn("nth", F.row_number().over(inside).cast("long"))
        .join(F.broadcast(start), "range")  # one row per range
        .withColumn("place", F.col("rows_before") + F.col("nth") - 1)
        .withColumn("shard", F.least(F.expr("CAST(0 AS BIGINT)") + F.floor(at * F.lit(shards).cast("decimal(10,0)") / F.lit(max(1, total)).cast("decimal(20,0)")), F.lit(shards - 1)).cast("int"))
    )
    placed = stored(placed.drop("run", "nth", "bytes_before", "rows_before"), "placed")
    first = placed.groupBy("shard").agg(F.min("place").alias("first_place"))  # at most `shards` rows
    return placed.join(F.broadcast(first), "shard").withColumn("slot", F.col("place") - F.col("first_place")).drop("place", "first_place")


def _slim() -> list[Column]:
    text = F.coalesce(F.col("text"), F.lit(""))
    return [(F.octet_length(text).cast("long") + 1).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), record_key(text, F.col("doc_id")).alias("key")]


def shard_documents(docs: DataFrame, shards: int = 16, ranges: int = 1024, law: str = "bytes") -> DataFrame:
    """doc_id, size, text_crc32, shard, slot, range of every row of docs(doc_id, text).

    size: UTF-8 bytes of the text plus 1. A null text has size 1 and the checksum of no bytes (0), and
    lies with the empty texts. Null and repeated ids are kept as rows of their own.
    """
    slim = pick(docs, "doc_id", "text").select("doc_id", *_slim())
    return shard(stored(slim, "slim"), shards, ranges, law).drop("key")


def write_shards(docs: DataFrame, path: str, shards: int = 16, ranges: int = 1024) -> None:
    """The rows of docs as one folder per shard, in the order of their slots; each range of keys is one file, written by one task.

    Texts are scanned twice and shuffled twice: by range to be placed, and to the writer of their file.
    """
    split = splitters(stored(pick(docs, "doc_id", "text").select(*_slim()), "slim"), ranges)
    folder = "_shard"
    while folder in [c.lower() for c in docs.columns]:
        folder += "_"
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["doc_id"], docs["text"]).select("row", "doc_id", *_slim())
    placed = shard(rows, shards, ranges, split=split)
    flat = placed.select("row", F.col("shard").alias(folder), "slot", "range").repartition(folder, "range").sortWithinPartitions(folder, "slot")
    flat.select("row.*", folder).write.partitionBy(folder).parquet(path)
