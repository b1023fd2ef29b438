"""Benchmark decontamination: SimHash of item-sized windows, multi-index Hamming blocks, exact check.

Every text is hashed into word shingles. A window without any shingle of the benchmark has similarity 0 to
all items, so only texts with such a shingle go on, whole; their shingle counts over all documents
give the weights. In those texts, each window of an item's size that holds enough of the benchmark to reach
the threshold gets a 64-bit SimHash. A distinct shingle votes with the root of its weight, so that the angle of
two vote sums follows from their weighted Jaccard similarity alone (cosine 2 s / (1 + s) at least); a shingle of no item
votes as the known ones of its window do on average. The items' fingerprints are indexed by blocks, each under all values within radius // blocks
flips, so that any fingerprint within the radius agrees in one block at least. Candidates within the
radius are then checked by weighted Jaccard similarity of their shingles.

The benchmark is taken in blocks of about ``block_items`` items or ``block_bytes`` bytes, so what a task holds of it is
bounded whatever its size. Texts are scanned once per block; those that hold anything of the benchmark are shuffled by their hash, together with all
shingles of the whole benchmark that they hold and the weights of these. So results don't depend on how items fall into blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.llm import shingles as sh
from voxmill.llm.common import numbered, pick, small_batches, stored, text_or_empty

BITS, BLOCKS = 64, 8
RADIUS = 22
RUN = 1 << 15
# votes are whole numbers, so that sums are exact in any order and ties fall alike
VOTE = 1024
HITS = "doc_id long, item_id long, similarity double, window_start int, window_words int, distance int"


def bits_of(h: np.ndarray) -> np.ndarray:
    return np.unpackbits(np.ascontiguousarray(h).view(np.uint8).reshape(-1, 8), axis=1)


def simhash(votes: np.ndarray) -> np.ndarray:
    """Fingerprints from summed votes of +-weight per bit."""
    return np.packbits(votes > 0, axis=1).reshape(-1, 8).copy().view(np.uint64).ravel()


def votes_of(weight: np.ndarray) -> np.ndarray:
    return np.round(np.sqrt(weight) * VOTE)


def window_sums(rows: np.ndarray, h: np.ndarray, n: int, starts: np.ndarray) -> np.ndarray:
    """Sums of ``rows`` over the distinct hashes in h[s : s + n] for each start; exact for whole numbers."""
    sums = np.zeros((len(h) + 1, rows.shape[1]))
    np.cumsum(rows, axis=0, out=sums[1:])
    out = sums[starts + n] - sums[starts]
    order = np.argsort(h, kind="stable")
    again = h[order][1:] == h[order][:-1]
    at, before = order[1:][again], order[:-1][again]
    near = at - before < n
    at, before = at[near], before[near]
    if len(at):
        # a repeat counts no more in the windows that hold the one before it as well
        sums[:] = 0
        np.add.at(sums, np.maximum(at - n + 1, 0), rows[at])
        np.add.at(sums, before + 1, -rows[at])
        out -= np.cumsum(sums, axis=0, out=sums)[starts]
    return out


def weights_of(df: np.ndarray, documents: int) -> np.ndarray:
    return np.log1p(documents / np.maximum(df, 1))


class Items:
    """A block of benchmark items: shingles by item, and, per window size, the multi-index of fingerprints."""

    def __init__(self, items: list[tuple[int, str]], k: int):
        self.k, self.ids, self.sets, self.sizes = k, [], [], []
        for item, text in items:
            w, _ = _words(text)
            if len(w):
                self.ids.append(item)
                self.sizes.append(len(w))
                self.sets.append(np.unique(sh.grams(w, k)))
        self.known = np.unique(np.concatenate([*self.sets, np.zeros(0, np.uint64)]))
        # items of fewer than k words are one shingle of their own size
        self.short = sorted({n for n in self.sizes if n < k})

    def weigh(self, df: np.ndarray, documents: int, radius: int) -> None:
        """The weights of the block's shingles, and the index that follows from them."""
        weight, self.radius = weights_of(df, documents), radius
        self.weights = [weight[np.searchsorted(self.known, s)] for s in self.sets]
        self.other = [float(w.mean()) for w in self.weights]
        self.total = np.array([w.sum() for w in self.weights])
        prints = np.array([int(simhash(((bits_of(s) * 2.0 - 1) * votes_of(w)[:, None]).sum(0, keepdims=True))[0]) for s, w in zip(self.sets, self.weights, strict=True)], np.uint64)
        near = [v for v in range(256) if v.bit_count() <= radius // BLOCKS]
        self.by_size: dict[int, tuple] = {}
        for size in sorted(set(self.sizes)):
            own = np.array([i for i, n in enumerate(self.sizes) if n == size])
            blocks = prints[own].view(np.uint8).reshape(-1, BLOCKS)
            table = []
            for b in range(BLOCKS):
                values = (blocks[:, b][:, None] ^ np.array(near, np.uint8)[None, :]).ravel()
                order = np.argsort(values, kind="stable")
                table.append((np.repeat(own, len(near))[order], np.searchsorted(values[order], np.arange(257))))
            self.by_size[size] = (prints, table)
        self.least = {size: min(t for t, n in zip(self.total, self.sizes, strict=True) if n == size) for size in self.by_size}

    def candidates(self, size: int, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(window, item, distance) of every pair of this size within the radius, each once."""
        own, table = self.by_size[size]
        keys, n = [], len(own)
        for b in range(BLOCKS):
            values = prints.view(np.uint8).reshape(-1, BLOCKS)[:, b].astype(np.int64)
            items, at = table[b]
            lens = at[values + 1] - at[values]
            window = np.repeat(np.arange(len(prints)), lens)
            within = np.arange(len(window)) - np.repeat(np.cumsum(lens) - lens, lens)
            item = items[at[values][window] + within]
            ok = np.bitwise_count(prints[window] ^ own[item]) <= self.radius
            keys.append(window[ok] * n + item[ok])
        window, item = np.divmod(np.unique(np.concatenate(keys)), n)
        return window, item, np.bitwise_count(prints[window] ^ own[item])

    def similarity(self, window: np.ndarray, item: int, known: np.ndarray, weight: np.ndarray) -> float:
        """Weighted Jaccard of a window's distinct shingles and an item's; a shingle of no item of the benchmark weighs as the item's mean."""
        own = self.sets[item]
        shared = np.isin(own, window, assume_unique=True)
        at, is_known = _found(window, known)
        union = self.weights[item].sum() + np.where(is_known, weight[at], self.other[item]).sum() - self.weights[item][shared].sum()
        return float(self.weights[item][shared].sum() / union)


def _words(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return sh.words(raw, np.array([0, len(raw)]))


def _found(h: np.ndarray, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``known``, whether it is there) of each hash; ``known`` is not empty."""
    at = np.searchsorted(known, h)
    at[at == len(known)] = 0
    return at, known[at] == h


def matches(text: str, items: Items, threshold: float, known: np.ndarray, weight: np.ndarray) -> list[tuple[int, float, int, int, int]]:
    """(item, similarity, first word, words, distance) of the best window per item at or over the threshold.

    known, weight: the benchmark's shingles that the text holds, ascending, and their weights.
    """
    w, _ = _words(text)
    best: dict[int, tuple] = {}
    flags, grams = {}, {}
    for size in items.by_size if len(known) else ():
        k, span = min(items.k, size), min(size, len(w))
        if span < k or not span:
            continue
        if k not in grams:
            grams[k] = sh.grams(w, k)
            flags[k] = np.append(0, np.cumsum(_found(grams[k], known)[1]))
        n = span - k + 1
        every = np.flatnonzero(flags[k][n:] > flags[k][:-n])
        # runs of near window starts, so that a long text is never held as votes at once
        for starts in np.split(every, np.flatnonzero((np.diff(every) > n) | (np.diff(every // RUN) > 0)) + 1):
            if not len(starts):
                continue
            h = grams[k][starts[0] : starts[-1] + n]
            at, is_known = _found(h, known)
            own = np.where(is_known, weight[at], 0.0)
            # what a window shares with an item weighs no more than all it holds of the benchmark
            held = np.append(0.0, np.cumsum(own))
            held = held[starts - starts[0] + n] - held[starts - starts[0]]
            enough = held >= threshold * items.least[size] - 1e-6
            starts, held, first = starts[enough], held[enough], starts[0]
            if not len(starts):
                continue
            local = starts - first
            bits = bits_of(h) * 2.0 - 1
            votes = window_sums(bits * votes_of(own)[:, None], h, n, local)
            if not is_known.all():
                counts = np.append(0, np.cumsum(is_known))
                mean = held / np.maximum(counts[local + n] - counts[local], 1)
                votes += window_sums(bits * ~is_known[:, None], h, n, local) * votes_of(mean)[:, None]
            window, item, distance = items.candidates(size, simhash(votes))
            able = held[window] >= threshold * items.total[item] - 1e-6
            for x, i, d in zip(window[able], item[able], distance[able], strict=True):
                s = int(starts[x])
                value = items.similarity(np.unique(grams[k][s : s + n]), int(i), known, weight)
                if value >= threshold and (int(i) not in best or (-value, s) < best[int(i)][:2]):
                    best[int(i)] = (-value, s, span, int(d))
    return [(items.ids[i], -v, s, span, d) for i, (v, s, span, d) in sorted(best.items())]


def contaminated(docs: DataFrame, benchmark: DataFrame, k: int = 5, threshold: float = 0.8, radius: int = RADIUS, block_items: int = 20_000, block_bytes: int = 8 << 20) -> DataFrame:
    """HITS: each pair of a row of docs(doc_id, text) and an item of benchmark(item_id, text) with a window of
    the item's size in words whose shingles reach ``threshold``, with the best (then first) such window.

    An item of fewer than k words is one shingle; items and texts without words match nothing; a text shorter than an
    item is one window. Rows that repeat give their pairs again; nulls count as empty texts, null ids are kept.
    """
    spark = docs.sparkSession
    small_batches(spark)
    n_items, n_bytes = pick(benchmark, "text").agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(1, -(-n_items // block_items), -(-n_bytes // block_bytes))
    dealt = pick(benchmark, "item_id", "text").withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)))
    whole = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    n_docs = max(docs.count(), 1)
    # a block is a part of the benchmark that is bounded in items and in bytes
    block_of = lambda block: Items([(r.item_id, r.text) for r in dealt.where(F.col("block") == block).orderBy("item_id", "text").collect()], k)
    found = None
    for block in range(blocks):
        one = _touched(whole, block_of(block))
        found = one if found is None else found.unionByName(one)
    texts, df = _with_weights(found, n_docs)
    out = None
    for block in range(blocks):
        items = block_of(block)
        known = spark.createDataFrame(pa.table({"x": items.known.view(np.int64)}))
        counts = df.join(known, "x").toArrow()  # at most one row per shingle of the block
        own = np.zeros(len(items.known), np.int64)
        own[np.searchsorted(items.known, counts["x"].to_numpy().view(np.uint64))] = counts["df"].to_numpy()
        items.weigh(own, n_docs, radius)
        hits = _hits(texts, items, threshold)
        out = hits if out is None else out.unionByName(hits)
    return out


def _touched(whole: DataFrame, items: Items) -> DataFrame:
    """(a, b, doc_id, text, found) of the texts with a shingle of these items: two hashes of id and text, and those shingles."""

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap = np.zeros(1 << 20, bool)
        bitmap[items.known & np.uint64((1 << 20) - 1)] = True
        sizes = [*items.short, items.k]
        for b in batches:
            rows, found = [], []
            for first, data, offsets in sh.chunks(b.column("text")):
                w, starts = sh.words(data, offsets)
                seen: dict[int, list] = {}
                for k in sizes:
                    if len(w) < k or not len(items.known):
                        continue
                    h = sh.grams(w, k)
                    at = np.flatnonzero(bitmap[h & np.uint64((1 << 20) - 1)])
                    at = at[_found(h[at], items.known)[1]]
                    owner = np.searchsorted(starts, at, "right") - 1
                    inside = at + k <= starts[owner + 1]
                    for i, x in zip(owner[inside], at[inside], strict=True):
                        seen.setdefault(int(i), []).append(h[x])
                for i in sorted(seen):
                    rows.append(first + i)
                    found.append(np.unique(np.array(seen[i], np.uint64)).view(np.int64))
            picked = b.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([picked.column("doc_id"), picked.column("text"), pa.array(found, pa.list_(pa.int64()))], ["doc_id", "text", "found"])

    keys = [F.xxhash64("doc_id", "text").alias("a"), F.xxhash64("text", "doc_id", F.lit(5)).alias("b")]
    rows = whole.mapInArrow(touched, "doc_id long, text string, found array<long>").select(*keys, "doc_id", "text", "found")
    return stored(rows.groupBy("a", "b").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.count("*").alias("times"), F.first("found").alias("found")), "touched")


def _with_weights(found: DataFrame, n_docs: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text, times, known, weight) of all touched texts, known ascending; and (x, df): the documents that hold each shingle."""
    each = found.select("a", "b", "times", F.explode("found").alias("x")).distinct()
    df = stored(each.groupBy("x").agg(F.sum("times").alias("df")), "frequencies")
    weight = F.log1p(F.lit(float(n_docs)) / F.greatest(F.col("df"), F.lit(1)))
    of_text = each.join(df, "x").groupBy("a", "b").agg(F.collect_list(F.struct("x", weight.alias("w"))).alias("xs"))  # at most one entry a shingle of the text
    texts = found.groupBy("a", "b").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text"), F.max("times").alias("times"))
    joined = texts.join(of_text, ["a", "b"])
    return stored(joined.select("doc_id", "text", "times", F.col("xs.x").alias("known"), F.col("xs.w").alias("weight")), "texts"), df


def _hits(texts: DataFrame, items: Items, threshold: float) -> DataFrame:
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*(x.split()[0] for x in HITS.split(", ")), "times"]
        types = [pa.int64(), pa.int64(), pa.float64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
        for b in batches:
            out = []
            for d, t, n, x, w in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "times")), b.column("known"), b.column("weight"), strict=True):
                known, weight = x.values.to_numpy().view(np.uint64), w.values.to_numpy()
                order = np.argsort(known)
                out += [(d, *m, n) for m in matches(t, items, threshold, known[order], weight[order])]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)

    hits = texts.mapInArrow(windows, f"{HITS}, times long")
    return hits.withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).drop("times")


def clean_documents(docs: DataFrame, benchmark: DataFrame, **how) -> DataFrame:
    """The rows without a hit, with their own columns; rows are told apart by number, whatever their ids."""
    rows, number = numbered(docs)
    texts = rows.select(rows[number].alias("doc_id"), rows["`text`"])
    gone = stored(contaminated(texts, benchmark, **how).select(F.col("doc_id").alias(number)).distinct(), "leaks")
    return rows.join(gone, number, "left_anti").select(*[rows[f"`{c}`"] for c in docs.columns])
