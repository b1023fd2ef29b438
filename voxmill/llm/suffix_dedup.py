"""Removal of repeated byte strings by a hash-compared suffix sort.

A suffix matters here for its first ``length`` bytes only, its window. Windows are dealt to buckets by an anchor:
the least k-byte string in them by hash (then the leftmost), so equal windows have equal anchors at
equal offsets. An anchor's run of windows is one row. Anchors that occur once hold no repeated window. Rows whose
whole runs agree (by two hashes of 64 bits over all bytes) are one class. Of each class the first row and, if it has more than
one, the last send their bytes to a bucket, where the two are verified byte by byte; the first goes on. Should they differ, the
class is split: the windows of all its rows, and of the other classes of its anchor, are dealt by all their bytes, as below.

In a bucket the suffixes of each anchor and offset are sorted by mergesort. Two suffixes are compared by
their longest common extension, which a binary search over prefix polynomial hashes finds in log2(length)
steps, and then by one byte. Neighbours that agree over the whole window are verified byte by byte. A class of two rows or
more is repeated throughout and serves the sort for what others share with it; an anchor of one class needs no sort.

Rows are told apart by their ids where these are whole numbers that don't repeat, else by numbers stored with them.

A bucket holds about ``bucket`` runs. Where an anchor has more than ``crowd`` classes, its windows are dealt by all
their bytes instead: they become runs of one window, which go the same way by classes, so nothing unbounded
meets in a task.
"""

from __future__ import annotations

import hashlib
import struct
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.llm import shingles as sh
from voxmill.llm.common import numbered, pick, small_batches, stored, text_or_empty

RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
ANCHORS = "rk long, lo int, n int, rel int, h long, f long, g long"
#: Bytes of runs in a batch that a task sends on.
SEND = 4 << 20
#: Windows that are sorted at once, but for a larger cell.
BLOCK = 1 << 15
_SECOND = np.random.Generator(np.random.PCG64(7919)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_FIRST = np.random.Generator(np.random.PCG64(104729)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_LOW = np.uint64((1 << 32) - 1)


def sliding_least(v: np.ndarray, width: int) -> np.ndarray:
    """min(v[i : i + width]) for each i, by doubling."""
    have = 1
    while 2 * have <= width:
        v = np.minimum(v[:-have], v[have:])
        have *= 2
    return np.minimum(v[: len(v) - (width - have)], v[width - have :]) if width > have else v


def runs_of(data: np.ndarray, offsets: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Per run of windows with the same anchor: its text, first window's start, number of windows, the anchor's
    place after that start, the anchor's hash, and two hashes of all bytes of the run. Places are in ``data``."""
    none = np.zeros(0, np.int64)
    nothing = (*[none] * 4, *[none.view(np.uint64)] * 3)
    if len(data) < length:
        return nothing
    first = sh.prefix_hashes(data, _FIRST)
    at = np.arange(len(data) - k + 1)
    h = sh.mixed(sh.span_hashes(first, at, at + k))
    anchor = (sliding_least((h & ~_LOW) | at.astype(np.uint64), length - k + 1) & _LOW).astype(np.int64)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(anchor)]
    inside = np.flatnonzero(np.arange(len(anchor)) + length <= offsets[1:][text])
    if not len(inside):
        return nothing
    a = anchor[inside]
    new = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
    lo, n = inside[new], np.diff(np.append(new, len(inside)))
    rel = a[new] - lo
    shape, end = (n * 1024 + rel).astype(np.uint64), lo + n - 1 + length
    f = sh.span_hashes(sh.prefix_hashes(data, _SECOND), lo, end)
    g = sh.span_hashes(first, lo, end)
    return text[lo], lo, n, rel, h[a[new]], sh.mixed(f + shape, 3), sh.mixed(g, 4)


def anchors(whole: DataFrame, length: int, k: int, bits: int) -> DataFrame:
    mask = np.uint64((1 << bits) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in ANCHORS.split(", ")]
        for b in batches:
            rk = b.column("rk").to_numpy()
            for first, data, offsets in sh.chunks(b.column("text")):
                text, lo, n, rel, h, f, g = runs_of(data, offsets, length, k)
                cols = [pa.array(rk[first + text])] + [pa.array(x.astype(np.int32)) for x in (lo - offsets[text], n, rel)] + [pa.array(x.view(np.int64)) for x in (h, f & mask, g & mask)]
                yield pa.RecordBatch.from_arrays(cols, names)

    return stored(whole.select("rk", "text").mapInArrow(run, ANCHORS), "anchors")


class Suffixes:
    """Bytes with prefix hashes, compared over at most ``length`` bytes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length = data, length
        self.prefix = sh.prefix_hashes(data, _FIRST)
        self.inverse = sh.powers(len(self.prefix))[1]

    def common(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Longest common extension of suffixes p and q, by binary search over hashes."""
        got = np.zeros(len(p), np.int64)
        base_p, base_q, inv_p, inv_q = self.prefix[p], self.prefix[q], self.inverse[p], self.inverse[q]
        step = 1 << (self.length.bit_length() - 1)
        while step:
            n = got + step
            ok = n <= self.length
            end = np.where(ok, n, 0)
            same = (self.prefix[p + end] - base_p) * inv_p == (self.prefix[q + end] - base_q) * inv_q
            got = np.where(ok & same, n, got)
            step >>= 1
        return got

    def less(self, p: np.ndarray, q: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        n = self.common(p, q)
        whole = n >= self.length
        m = np.where(whole, 0, n)
        return np.where(whole, or_equal, self.data[p + m] < self.data[q + m])

    def sort(self, starts: np.ndarray, cell: np.ndarray) -> np.ndarray:
        """``starts`` sorted by suffix within equal, ascending ``cell``, by mergesort of all cells at once."""
        starts = starts.copy()
        begin = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
        size = np.diff(np.append(begin, len(cell)))
        first, count = np.repeat(begin, size), np.repeat(size, size)
        width = 1
        while width < size.max(initial=0):
            live = np.flatnonzero(count > width)
            j = live - first[live]
            run, within = j // width, j % width
            other = (run ^ 1) * width
            low = np.minimum(other, count[live])
            high = np.minimum(other + width, count[live])
            left, lo, hi = run % 2 == 0, low.copy(), high.copy()
            # how many of the other run go before: those less; for the right run also those equal
            for _ in range(width.bit_length()):
                open_ = lo < hi
                mid = np.where(open_, (lo + hi) // 2, 0)
                before = self.less(starts[first[live] + mid], starts[live], ~left) & open_
                lo = np.where(before, mid + 1, lo)
                hi = np.where(open_ & ~before, mid, hi)
            out = starts.copy()
            out[first[live] + run // 2 * 2 * width + within + lo - low] = starts[live]
            starts = out
            width *= 2
        return starts

    def equal(self, p: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Whether the windows at p and q have the same bytes."""
        view = np.lib.stride_tricks.sliding_window_view(self.data, self.length)
        return np.concatenate([(view[p[i : i + 4096]] == view[q[i : i + 4096]]).all(axis=1) for i in range(0, len(p), 4096)] or [np.zeros(0, bool)])


def repeated_windows(runs: list[bytes], h: np.ndarray, rel: np.ndarray, length: int) -> list[np.ndarray]:
    """For each run of bytes, which of its windows also start in another run."""
    counts = np.array([len(r) - length + 1 for r in runs])
    begins = np.append(0, np.cumsum([len(r) for r in runs]))[:-1]
    owner = np.repeat(np.arange(len(runs)), counts)
    j = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts, offset = begins[owner] + j, rel[owner] - j
    order = np.lexsort((starts, offset, h[owner]))
    cell_h, cell_o = h[owner][order], offset[order]
    cell = np.cumsum(np.append(0, (cell_h[1:] != cell_h[:-1]) | (cell_o[1:] != cell_o[:-1])))
    s = Suffixes(np.frombuffer(b"".join(runs), np.uint8), length)
    # whole cells at a time, so that what a sort touches stays near
    starts = starts[order]
    begins_at = np.flatnonzero(np.append(True, cell[1:] != cell[:-1]))
    at = np.searchsorted(begins_at, np.arange(0, len(cell), BLOCK))
    cuts = np.unique(np.append(begins_at[at[at < len(begins_at)]], len(cell)))
    ranked = np.concatenate([s.sort(starts[a:b], cell[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)])
    pair = np.flatnonzero(cell[1:] == cell[:-1])
    pair = pair[s.common(ranked[pair], ranked[pair + 1]) >= length]
    true = s.equal(ranked[pair], ranked[pair + 1])
    if not true.all():  # equal hashes of different bytes: sort the bytes themselves
        view = np.lib.stride_tricks.sliding_window_view(s.data, length)
        ranked = np.array(sorted(ranked.tolist(), key=lambda x: view[x].tobytes()))
        pair = np.flatnonzero(s.equal(ranked[:-1], ranked[1:]))
    again = np.zeros(len(s.data), bool)
    again[ranked[pair]] = True
    again[ranked[pair + 1]] = True
    return [again[b : b + c] for b, c in zip(begins, counts, strict=True)]


def _spans(flags: np.ndarray, lo: int, length: int) -> list[tuple[int, int]]:
    """Byte spans that the flagged windows cover; windows begin at lo."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return [(lo + int(a), lo + int(b) - 1 + length) for a, b in zip(edges[::2], edges[1::2], strict=True)]


def _sent(texts: DataFrame, columns: dict[str, pa.DataType], rows_of) -> DataFrame:
    """Rows of ``columns`` that ``rows_of(rk, raw, runs)`` makes of each text, in batches of bounded size."""
    names, types = list(columns), list(columns.values())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, held = [], 0
        batch = lambda: pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)
        for b in batches:
            for rk, text, runs in zip(b.column("rk").to_pylist(), b.column("text").to_pylist(), b.column("runs").to_pylist(), strict=True):
                for r in rows_of(rk, text.encode(), runs):
                    out.append(r)
                    held += 100 + (len(r[-1]) if type(r[-1]) is bytes else 0)
                    if held > SEND:
                        yield batch()
                        out, held = [], 0
        yield batch()

    kinds = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.binary(): "binary"}
    return texts.mapInArrow(run, ", ".join(f"{n} {kinds[t]}" for n, t in columns.items()))


def _with_runs(whole: DataFrame, wanted: DataFrame, slots: int) -> DataFrame:
    """(rk, text, runs) of the texts that have rows in wanted(rk, ...)."""
    wanted = stored(wanted.groupBy("rk").agg(F.collect_list(F.struct(*[c for c in wanted.columns if c != "rk"])).alias("runs")), "wanted")
    slot = F.pmod(F.xxhash64("rk"), F.lit(slots))
    live = wanted.select(slot.alias("slot")).distinct()
    texts = whole.select("rk", "text").withColumn("slot", slot).join(F.broadcast(live), "slot", "left_semi")  # at most `slots` rows
    return texts.drop("slot").join(wanted, "rk")


def sorted_runs(whole: DataFrame, classes: DataFrame, length: int, bucket: int, slots: int) -> DataFrame:
    """(rk, s, e) spans of the single rows of classes(cell, h, f, g, c, first, last) that repeat, and, with rk null, (h, f, g) of the classes of two rows or more that do.

    ``s`` is -1 for classes whose first and last row differ. cell: runs that may hold equal windows have one. first, last: (rk, lo, n, rel).
    """
    buckets = max(1, -(-classes.count() // bucket))
    ends = F.when(F.col("c") > 1, F.array("first", "last")).otherwise(F.array("first"))
    rows = classes.select("cell", "h", "f", "g", (F.col("c") == 1).alias("single"), F.explode(ends).alias("r")).select("cell", "h", "f", "g", "single", "r.*")
    columns = {"bucket": pa.int64(), "cell": pa.int64(), "h": pa.int64(), "f": pa.int64(), "g": pa.int64(), "single": pa.bool_(), "rk": pa.int64(), "lo": pa.int32(), "rel": pa.int32(), "bytes": pa.binary()}

    def bring(rk: int, raw: bytes, runs: list) -> Iterator[tuple]:
        for r in runs:
            yield r["cell"] % buckets, r["cell"], r["h"], r["f"], r["g"], r["single"], rk, r["lo"], r["rel"], raw[r["lo"] : r["lo"] + r["n"] - 1 + length]

    def sort_bucket(group: pa.Table) -> pa.Table:
        rk, lo, rel, cell, single, raw = (group.column(c).to_pylist() for c in ("rk", "lo", "rel", "cell", "single", "bytes"))
        names = list(zip(*[group.column(c).to_pylist() for c in ("h", "f", "g")], strict=True))
        first: dict[tuple, int] = {}
        twice, differ, out = set(), set(), []
        for i, name in enumerate(names):
            if first.setdefault(name, i) != i:
                (twice if raw[i] == raw[first[name]] else differ).add(name)
        out += [(None, None, None, *name) for name in twice] + [(None, -1, None, *name) for name in differ]
        crowd = Counter(cell[i] for i in first.values())
        live = [i for i in first.values() if crowd[cell[i]] > 1]
        if live:
            flags = repeated_windows([raw[i] for i in live], np.array([cell[i] for i in live]), np.array([rel[i] for i in live], np.int64), length)
            out += [(rk[i], *span, *names[i]) for i, again in zip(live, flags, strict=True) if single[i] for span in _spans(again, lo[i], length)]
        types = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        return pa.table({n: pa.array([r[i] for r in out], t) for i, (n, t) in enumerate(zip(("rk", "s", "e", "h", "f", "g"), types, strict=True))})

    return stored(_sent(_with_runs(whole, rows, slots), columns, bring).groupBy("bucket").applyInArrow(sort_bucket, "rk long, s int, e int, h long, f long, g long"), "sorted")


def covered_spans(whole: DataFrame, length: int, k: int, bucket: int, crowd: int, slots: int, bits: int) -> DataFrame:
    """(rk, s, e): byte spans of texts that repeated windows cover, in pieces."""
    rows = anchors(whole, length, k, bits)
    # stored, so that the join is of plain rows and adaptive execution can split a hot anchor
    often = stored(rows.groupBy("h").agg(F.count("*").alias("c")).where("c > 1").select("h"), "often")
    shared = stored(rows.join(often, "h"), "shared")
    place, name = F.struct("rk", "lo", "n", "rel"), ["h", "f", "g"]
    ends = [F.count("*").alias("c"), F.min(place).alias("first"), F.max(place).alias("last")]
    classes = stored(shared.groupBy(*name).agg(*ends), "classes")
    hot = stored(classes.groupBy("h").agg(F.count("*").alias("classes")).where(F.col("classes") > crowd).select("h", F.lit(True).alias("hot")), "hot")
    marked = classes.join(hot, "h", "left")
    # the rows of one class lie in one cell; where an anchor isn't hot, so do all of its classes
    cell = F.when(F.col("hot"), F.xxhash64(*name)).otherwise(F.col("h"))
    found = sorted_runs(whole, marked.where("hot IS NULL OR c > 1").select(cell.alias("cell"), *name, "c", "first", "last"), length, bucket, slots)

    def of(rows: DataFrame, found: DataFrame) -> DataFrame:
        """The spans that the sort found: of single rows, and of all rows of repeated classes."""
        repeated = stored(found.where("rk IS NULL AND s IS NULL").select(*name).distinct(), "repeated")
        copies = rows.join(repeated, name, "left_semi").select("rk", F.col("lo").alias("s"), (F.col("lo") + F.col("n") - 1 + length).alias("e"))
        return copies.unionByName(found.where("rk IS NOT NULL").select("rk", "s", "e"))

    out = of(shared, found)
    dealt = marked.where("hot").select("first.*", "h")
    split = stored(found.where("s = -1").select(*name).distinct(), "split")
    mistaken = bool(split.limit(1).count())
    if mistaken:
        others = marked.join(split.select("h").distinct(), "h", "left_semi").join(split, name, "left_anti").select("first.*", "h")
        own = shared.join(split, name, "left_semi").select("rk", "lo", "n", "rel", "h")
        dealt = dealt.unionByName(others).unionByName(own).distinct()
    if mistaken or hot.limit(1).count():
        columns = {"rk": pa.int64(), "lo": pa.int32(), "n": pa.int32(), "rel": pa.int32(), "h": pa.int64(), "f": pa.int64(), "g": pa.int64()}

        def windows(rk: int, raw: bytes, runs: list) -> Iterator[tuple]:
            for r in runs:
                for i in range(r["lo"], r["lo"] + r["n"]):
                    yield rk, i, 1, 0, r["h"], *struct.unpack("<qq", hashlib.blake2b(raw[i : i + length], digest_size=16).digest())

        single = stored(_sent(_with_runs(whole, dealt, slots), columns, windows), "windows")
        again = stored(single.groupBy(*name).agg(*ends).where("c > 1"), "classes")
        found = sorted_runs(whole, again.select(F.xxhash64(*name).alias("cell"), *name, "c", "first", "last"), length, bucket, slots)
        out = out.unionByName(of(single, found))
    return out


def remove_repeats(docs: DataFrame, length: int = 200, k: int = 32, bucket: int = 512, crowd: int = 4096, slots: int = 1 << 18, bits: int = 64) -> DataFrame:
    """RESULT for each row of docs(doc_id, text), with the bytes that stay as ``kept``.

    Every byte goes that lies in a string of ``length`` bytes which also starts anywhere else, in the same text or another;
    occurrences that overlap count. Null and empty texts, and those under ``length`` bytes, lose nothing. Rows that repeat
    count as another place, even with the same doc_id. What stays of a text may cut a character, so it is binary. ``bits`` of
    each of a run's two hashes are used; fewer make more classes that have to be split.
    """
    small_batches(docs.sparkSession)
    rows, number = numbered(pick(docs, "doc_id", "text"))
    whole = rows.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"), F.col(number).alias("rk"))
    spans = covered_spans(whole, length, k, bucket, crowd, slots, bits).groupBy("rk").agg(F.collect_list(F.struct("s", "e")).alias("spans"))
    joined = whole.join(spans, "rk", "left").select("doc_id", "text", "spans")

    def rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: list[list] = [[], [], [], [], []]
            for text, spans_of in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), strict=True):
                raw, kept, at, gone, runs = text.encode(), [], 0, 0, 0
                last = -1
                for s, e in sorted((x["s"], x["e"]) for x in spans_of or ()):
                    if s > last:
                        runs += 1
                        kept.append(raw[at:s])
                    gone += max(0, e - max(s, last))
                    last = max(last, e)
                    at = last
                kept = b"".join([*kept, raw[at:]])
                for c, x in zip(cols, (len(raw), gone, runs, hashlib.sha256(kept).hexdigest(), kept), strict=True):
                    c.append(x)
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *[pa.array(c, t) for c, t in zip(cols, types, strict=True)]], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])

    return joined.mapInArrow(rest, RESULT + ", kept binary")
