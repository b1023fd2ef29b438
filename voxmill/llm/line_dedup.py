"""Line dedup by a deletion-neighbourhood join.

Equal lines are one distinct line, named by its first place: (doc_id, line number). A line of n code points may differ
by n // ``per_edit`` edits, ``edits`` at most; of two lines the shorter one's bound holds. Lines are compared
without the white space at their ends; empty ones always stay.

A variant of a line is what is left of it when s + e of its characters are deleted: s of them leave a slot whose place belongs to
the variant's key (a substitution deletes at the same place on both sides), e of them leave nothing (a
deletion on one side only). Two lines that share a key with s slots, and e and f further deletions, are within s + e + f edits of
each other, and lines within the bound share such a key. So lines emit their variants as hashed keys, equal keys
meet, and for each e the least line of a key stands for all: no key lists pairs. Edit distances are then computed.

An exact filter goes first. d edits leave one of d + 1 pieces of the shorter line as it was, at its place or a few
signs off. Lines emit a key for each piece, as the shorter of two, and for each place where such a piece of a shorter (or
equal) line may lie in them; only lines that meet another under a key emit variants. With one edit the pieces are halves.

A variant's hash comes from prefix hashes of its line, so each costs a few operations whatever the line's length: a line of n code
points emits about n keys under a bound of 1, and n^d under a bound of d.

Texts are scanned three times; they are shuffled once, to be joined with what they lose. Lines shuffle as hashes; the
text of a line only if it may have a partner, by a set of at most ``slots`` hashed slots.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.llm import shingles as sh
from voxmill.llm.common import SPACE, pick, small_batches, stored, text_or_empty

RESULT = "doc_id long, n_lines long, n_repeated long, n_near long, kept_sha256 string, kept_text string"
FIRST = "struct<late:boolean,doc_id:bigint,n:int,th:bigint>"
#: Keys in a batch that a task sends on.
SEND = 1 << 16


def bound(size: Column, edits: int, per_edit: int) -> Column:
    return F.least(F.lit(edits), F.floor(size / per_edit)).cast("int")


def _whole(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))


def _lines(docs: DataFrame) -> DataFrame:
    """doc_id, th (hash of the text), n, line of each line that isn't empty."""
    cut = F.transform(F.split("text", "\n"), lambda x: F.trim(x, F.lit(SPACE)))
    # the text is hashed before it is cut, once and not for each line
    hashed = _whole(docs).withColumn("th", F.xxhash64("text"))
    return hashed.select("doc_id", "th", F.posexplode(cut).alias("n", "line")).where("line <> ''")


def _piece_keys(line: Column, size: Column, edits: int, per_edit: int) -> Column:
    """(delta, piece) of a line. delta is null for a piece of the line itself; else the line may hold, as a line delta longer, that
    piece of another. Keys that aren't of the bound that the shorter line has are null."""
    keys = []
    for b in range(1, edits + 1):
        for delta in range(b + 1):
            short = size - delta
            fits = bound(short, edits, per_edit) == b
            for j in range(b + 1):
                start, end = (F.floor(short * at / (b + 1)).cast("int") for at in (j, j + 1))
                piece = lambda shift, start=start, end=end, short=short, b=b, j=j: F.xxhash64(F.lit(b), F.lit(j), short, F.substring(line, start + 1 + shift, end - start))
                # edits before the first piece count as its own, as do those after the last
                for shift in [0] if j == 0 else [delta] if j == b else range(-b, b + 1):
                    # end pieces lie inside by their definition
                    inside = fits & (start + shift >= 0) & (end + shift <= size) if 0 < j < b else fits
                    own = delta == 0 and shift == 0
                    keys.append(F.when(inside, F.struct(F.lit(None if own else delta).cast("int").alias("delta"), piece(shift).alias("piece"))))
    return F.when(size >= per_edit, F.array(*keys))


def _deleted(size: int, m: int) -> np.ndarray:
    """The places of m deletions in a line, ascending, one column per choice."""
    if m == 1:
        return np.arange(size)[None]
    return np.array(list(combinations(range(size), m)), np.int64).reshape(-1, m).T


def variant_keys(line: str, s: int, e: int) -> np.ndarray:
    """The distinct keys of a line's variants with s slots and e further deletions."""
    points = sh.mixed(np.frombuffer(line.encode("utf-32-le"), "<u4").astype(np.uint64))
    size = len(points)
    power, inverse = sh.powers(size + 2)
    prefix = np.zeros(size + 1, np.uint64)
    np.cumsum(points * power[:size], out=prefix[1:])
    if not s + e:
        return sh.mixed(prefix[size:], size)
    at = _deleted(size, s + e)
    left = prefix[at[0]].copy()
    for k in range(1, s + e + 1):
        end = prefix[at[k]] if k < s + e else prefix[size]
        left += (end - prefix[at[k - 1] + 1]) * inverse[k]
    out = []
    for slots in combinations(range(s + e), s):
        h = sh.mixed(left, size - s - e)
        for k in slots:
            h = sh.mixed(h + (at[k] - k + 1).astype(np.uint64), 1 + s)
        out.append(h)
    return np.unique(np.concatenate(out))


def common_start(a: str, i: int, b: str, j: int) -> int:
    """How far a[i:] and b[j:] agree, by slices that double and then halve."""
    most, have, step = min(len(a) - i, len(b) - j), 0, 32
    while have < most and a[i + have : i + min(have + step, most)] == b[j + have : j + min(have + step, most)]:
        have, step = min(have + step, most), 2 * step
    while step:
        end = min(have + step, most)
        if a[i + have : i + end] == b[j + have : j + end]:
            have = end
        step //= 2
    return have


def within(a: str, b: str, most: int) -> bool:
    """Whether two lines are within ``most`` edits: per number of edits and diagonal, the furthest place that is reached."""
    reached = {0: common_start(a, 0, b, 0)}
    for e in range(most + 1):
        if e:
            new = {}
            for k in range(-e, e + 1):
                steps = [reached[k + d] + (d >= 0) for d in (-1, 0, 1) if k + d in reached]
                i = min(max(steps), len(a), len(b) - k) if steps else -1
                if i >= 0 and i + k >= 0:
                    new[k] = i + common_start(a, i, b, i + k)
            reached = new
        if reached.get(len(b) - len(a)) == len(a):
            return True
    return False


def _verified(pairs: DataFrame, edits: int, per_edit: int) -> DataFrame:
    """(h1, h2) of pairs(h1, h2, line, other) within the bound; the distance is computed in time that grows with the length alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            both = zip(b.column("line").to_pylist(), b.column("other").to_pylist(), strict=True)
            ok = [within(x, y, min(edits, min(len(x), len(y)) // per_edit)) for x, y in both]
            yield b.select(["h1", "h2"]).filter(pa.array(ok, pa.bool_()))

    return pairs.select("h1", "h2", "line", "other").mapInArrow(run, "h1 long, h2 long")


def _emitted(b: int, same: bool, shorter: bool, longer: bool) -> list[tuple[int, int]]:
    """The (s, e) that a line with the bound b needs for partners of its own length, of greater and of lesser length."""
    every = [(s, e) for s in range(b + 1) for e in range(b + 1 - s)]
    return [(s, e) for s, e in every if (same and 0 < s + 2 * e <= b) or (longer and e) or (shorter and s + 2 * e + 1 <= b)]


def _variants(kept: DataFrame, edits: int, per_edit: int) -> DataFrame:
    """(first, s, e, size, v) of each variant of kept(first, line, same, shorter, longer)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            firsts = b.column("first")
            rows: list[tuple[int, int, int, int, np.ndarray]] = []
            held = 0

            def sent() -> Iterator[pa.RecordBatch]:
                n = [len(r[4]) for r in rows]
                cols = [np.repeat([r[k] for r in rows], n) for k in range(4)]
                v = np.concatenate([r[4] for r in rows]).view(np.int64)
                for i in range(0, len(v), SEND):
                    part = slice(i, i + SEND)
                    yield pa.RecordBatch.from_arrays([firsts.take(pa.array(cols[0][part])), *[pa.array(c[part], pa.int32()) for c in cols[1:]], pa.array(v[part])], ["first", "s", "e", "size", "v"])

            flags = zip(*[b.column(c).to_pylist() for c in ("line", "same", "shorter", "longer")], strict=True)
            for i, (line, *how) in enumerate(flags):
                size = len(line)
                for s, e in _emitted(min(edits, size // per_edit), *how):
                    rows.append((i, s, e, size, variant_keys(line, s, e)))
                    held += len(rows[-1][4])
                    if held >= SEND:
                        yield from sent()
                        rows, held = [], 0
            if rows:
                yield from sent()

    return kept.select("first", "line", "same", "shorter", "longer").mapInArrow(run, f"first {FIRST}, s int, e int, size int, v long")


def _partners(distinct: DataFrame) -> DataFrame:
    """(h1, same, shorter, longer): the lines that meet another under a key, and of what length against their own it is."""
    keys = distinct.where("keys IS NOT NULL").select("h1", F.explode("keys").alias("k")).where("k IS NOT NULL").select("h1", "k.*")
    own, other = F.col("delta").isNull(), F.col("delta")
    met = keys.groupBy("piece").agg(F.min(F.when(own, F.col("h1"))).alias("a"), F.max(F.when(own, F.col("h1"))).alias("b"), F.min(other).alias("near"), F.max(other).alias("far"))
    # stored, so that the join is of plain rows and adaptive execution can split a hot piece
    met = stored(met.where("a <> b OR (a IS NOT NULL AND near IS NOT NULL)"), "pieces")
    each = keys.join(met, "piece").select(
        "h1",
        F.when(own, (F.col("a") != F.col("b")) | F.coalesce(F.col("near") == 0, F.lit(False))).otherwise(F.col("delta") == 0).alias("same"),
        (own & F.coalesce(F.col("far") > 0, F.lit(False))).alias("shorter"),
        F.coalesce(F.col("delta") > 0, F.lit(False)).alias("longer"),
    )
    return stored(each.groupBy("h1").agg(*[F.max(c).alias(c) for c in ("same", "shorter", "longer")]), "live")


def near_lines(docs: DataFrame, distinct: DataFrame, edits: int, per_edit: int, slots: int) -> DataFrame:
    """(h1, h2) of the distinct lines that have an earlier line within the bound."""
    live = _partners(distinct)
    slot = F.pmod(F.xxhash64("h1"), F.lit(slots))
    wanted = live.select(slot.alias("slot")).distinct()
    texts = _lines(docs).select(F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), "line").withColumn("slot", slot)
    texts = texts.join(F.broadcast(wanted), "slot", "left_semi")  # at most `slots` rows
    texts = texts.groupBy("h1", "h2").agg(F.first("line").alias("line"))
    kept = stored(texts.join(live, "h1").join(distinct.select("h1", "h2", "first"), ["h1", "h2"]).select("h1", "h2", "first", "line", "same", "shorter", "longer"), "halves")
    # the lines of a few files may hold most of the work, so they are dealt anew
    rows = stored(_variants(kept.repartition(F.xxhash64("h1", "h2")), edits, per_edit), "variants")
    # most keys are of one line; only the rest are ranked
    often = stored(rows.groupBy("v").agg(F.count("*").alias("c")).where("c > 1").select("v"), "often")
    rows = stored(rows.join(often, "v"), "shared")
    least = [F.min(F.when(F.col("e") == e, F.col("first"))).alias(f"least{e}") for e in range(edits + 1)]
    best = stored(rows.groupBy("v").agg(*least), "least")
    # the shorter of two has the fewer further deletions
    ok = lambda e: F.col("s") + F.col("e") + e <= bound(F.col("size") - F.col("e") + F.least(F.col("e"), F.lit(e)), edits, per_edit)
    joined = rows.join(best, "v").select("first", F.array_min(F.array_compact(F.array(*[F.when(ok(e), F.col(f"least{e}")) for e in range(edits + 1)]))).alias("keeper"))
    found = joined.where("keeper < first").groupBy("first").agg(F.min("keeper").alias("keeper"))
    ends = kept.select("first", "h1", "h2", "line")
    pairs = found.join(ends, "first").join(kept.select(F.col("first").alias("keeper"), F.col("line").alias("other")), "keeper")
    return _verified(pairs, edits, per_edit)


def lost_lines(docs: DataFrame, edits: int, per_edit: int, slots: int) -> DataFrame:
    """doc_id, th, lost (line numbers), n_near of each document that loses lines."""
    keys = _piece_keys(F.col("line"), F.col("size"), edits, per_edit) if edits else F.lit(None).cast("array<struct<delta:int,piece:bigint>>")
    # a column, so that a line's length is taken once
    lines = _lines(docs).withColumn("size", F.char_length("line"))
    hashed = lines.select("doc_id", "th", "n", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), keys.alias("keys"))
    place = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "n", "th")
    distinct = stored(hashed.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("times"), F.first("keys").alias("keys")), "distinct")
    near = stored(near_lines(docs, distinct, edits, per_edit, slots), "near").withColumn("near", F.lit(True))
    marked = stored(
        distinct.join(near, ["h1", "h2"], "left").where("near OR times > 1").select("h1", "h2", "first", F.coalesce("near", F.lit(False)).alias("near")),
        "marked",
    )
    gone = hashed.select("doc_id", "th", "n", "h1", "h2", place.alias("place")).join(marked, ["h1", "h2"]).where("near OR place <> first")
    return gone.groupBy("doc_id", "th").agg(F.collect_set("n").alias("lost"), F.count_distinct(F.when(F.col("near") & (F.col("place") == F.col("first")), F.col("n"))).alias("n_near"))


def dedup_lines(docs: DataFrame, edits: int = 1, per_edit: int = 16, slots: int = 1 << 18) -> DataFrame:
    """RESULT for each row of docs(doc_id, text).

    A line goes if it equals an earlier one (n_repeated), or else if some distinct line within the bound
    came earlier (n_near), whether or not that one stays; order is by doc_id, null last, then line number. The others are joined
    again as they were, with their white space. A null or empty text has one empty line. Rows that repeat a
    doc_id and its text are one document, and each gets its result.
    """
    small_batches(docs.sparkSession)
    lost = stored(lost_lines(docs, edits, per_edit, slots), "lost")
    rows = _whole(docs).withColumn("th", F.xxhash64("text"))
    on = rows["doc_id"].eqNullSafe(lost["doc_id"]) & (rows["th"] == lost["th"])
    joined = rows.join(lost, on, "left").select(rows["doc_id"], "text", "lost", "n_near")

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[list] = [[], [], [], [], []]
            for text, gone, near in zip(b.column("text").to_pylist(), b.column("lost").to_pylist(), b.column("n_near").to_pylist(), strict=True):
                lines, gone = text.split("\n"), set(gone or ())
                kept = "\n".join(x for i, x in enumerate(lines) if i not in gone)
                for col, x in zip(out, (len(lines), len(gone) - (near or 0), near or 0, hashlib.sha256(kept.encode()).hexdigest(), kept), strict=True):
                    col.append(x)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, t) for c, t in zip(out, types, strict=True)]], [x.split()[0] for x in RESULT.split(", ")])

    return joined.mapInArrow(rest, RESULT)
