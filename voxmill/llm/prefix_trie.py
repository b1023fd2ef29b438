"""The prefix trie of conversations, by union-find over sorted neighbours.

A turn is two 64-bit hashes of its role and text, and its number of words; a conversation is one row, the array of its
turns. Equal sequences are one class with its members' number and least id. Classes are range-partitioned by their hash
sequences and sorted, so that the members of any prefix are neighbours, and each pair of neighbours is an edge of the
depth that they share (LCP).

Each range builds its forest alone: edges are taken in descending depth, and a union-find merges the components they
join. A component merge creates the branching node of that depth (or widens it, when one side has it already); below
it, the merged components' chains of single nodes are closed. The depths shared across range boundaries are known
beforehand from the ranges' first and last rows. A node that reaches a boundary at such a depth is open: the range
gives its part of it, keyed by the prefix, and the rest of its forest is contracted into that part. Each
figure of a node is a sum (or a least id) over ranges, if a node counts itself where its first row lies; so the parts of open nodes
are merged by one small aggregation.

What is held where: a task has one range of about ``turns`` turns at a time, 16 bytes each and no texts. A conversation is one
row, so a single one may have some tens of millions of turns. Copies of a conversation are counted before anything is sorted; a
popular first turn is spread over ranges. A digest of ids is sequential by its nature: ids are first joined to
strings by spans of 4,096 and then stream through a hash, in order.

Odd input: rows without a conversation id belong to none and are left out. Turns that share a number, and those
without one (which come first), are ordered by their hash; repeated rows are turns of their own. Null role or text is empty. No
conversations give no nodes. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxmill.llm.common import pick, stored

EMPTY = hashlib.sha256(b"").hexdigest()
#: So many low bits of ids lie in one span, whose members are joined to one string.
SPAN_BITS = 12
NODES = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, total long, own long, "
    "ends_sha256 string, key string, parent_key string"
)


def sequences(conversations: DataFrame) -> DataFrame:
    """conv_id and its turns in order, each with two hashes x, y and its number of words w."""
    rows = pick(conversations, "conv_id", "turn", "role", "text").where("conv_id IS NOT NULL")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(
        F.col("turn").isNotNull().alias("numbered"), "turn", F.xxhash64(role, text).alias("x"), F.xxhash64(F.lit(7), text, F.length(text), role).alias("y"),
        F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+")).alias("w"),
    )
    ordered = rows.groupBy(F.col("conv_id").cast("long").alias("conv_id")).agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return ordered.withColumn("turns", F.transform("turns", lambda t: F.struct(t["x"].alias("x"), t["y"].alias("y"), t["w"].alias("w"))))


def regrown(convs: DataFrame, every: int = 20) -> DataFrame:
    """Each conversation on the stem of the one whose id is the multiple of ``every`` below it: that one's first h turns,
    then its own after as many; h is crc32 of the decimal id, modulo 4."""
    stem = F.col("conv_id") - F.pmod("conv_id", F.lit(every))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    heads = convs.where(F.pmod("conv_id", F.lit(every)) == 0).select(F.col("conv_id").alias("stem"), F.slice("turns", 1, 3).alias("head"))
    both = convs.withColumns({"stem": stem, "h": h}).join(heads, "stem", "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return both.select("conv_id", F.concat(head, own).alias("turns"))


def _member_digests(convs: DataFrame) -> DataFrame:
    """(conv_id, n, ends_sha256) for each class of equal sequences: its least id, its members, and the digest of their ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, n, state = None, 0, 0, hashlib.sha256()
        names = ["conv_id", "n", "ends_sha256"]
        for b in batches:
            out = []
            for x, y, size, least, m, ids in zip(*(b.column(c).to_pylist() for c in ("x", "y", "size", "least", "n", "ids")), strict=True):
                if key == (x, y, size):
                    state.update(b",")
                else:
                    if key is not None:
                        out.append((first, n, state.hexdigest()))
                    key, first, n, state = (x, y, size), least, 0, hashlib.sha256()
                state.update(ids.encode())
                n += m
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], names)
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v]) for v in (first, n, state.hexdigest())], names)

    chunk = F.shiftright("conv_id", SPAN_BITS).alias("chunk")
    joined = (
        convs.groupBy("x", "y", "size", chunk).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
        .select("x", "y", "size", "chunk", F.element_at("ids", 1).alias("least"), F.size("ids").cast("long").alias("n"), F.array_join(F.transform("ids", lambda i: i.cast("string")), ",").alias("ids"))
    )
    return joined.repartition("x", "y", "size").sortWithinPartitions("x", "y", "size", "chunk").mapInArrow(run, "conv_id long, n long, ends_sha256 string")


def classes(convs: DataFrame, turns: int) -> DataFrame:
    """The distinct sequences, dealt to ranges of paths: rng, conv_id, n, ends_sha256, path (two hashes a turn), words."""
    path = F.flatten(F.transform("turns", lambda t: F.array(t["x"], t["y"])))
    convs = convs.select("conv_id", path.alias("path"), F.transform("turns", lambda t: t["w"]).alias("words"))
    whole = [F.xxhash64(F.lit(seed), "path").alias(name) for seed, name in ((1, "x"), (2, "y"))]
    convs = stored(convs.select("*", *whole, F.size("path").alias("size")), "regrown")
    digests = stored(_member_digests(convs.select("conv_id", "x", "y", "size")), "members")
    found = stored(convs.select("conv_id", "path", "words").join(digests, "conv_id"), "distinct")
    total = found.agg(F.sum(F.size("words"))).first()[0] or 0
    return stored(found.repartitionByRange(total // turns + 1, "path").withColumn("rng", F.spark_partition_id()), "classes")


def boundaries(rows: DataFrame) -> dict[int, tuple[int, int]]:
    """For each range: the depth shared with the range before and with the one behind; -1 where there is none.

    One row of two numbers a range comes to the driver.
    """
    ends = rows.groupBy("rng").agg(F.min("path").alias("first"), F.max("path").alias("last"))
    ends = ends.withColumn("next", F.lead("first").over(Window.orderBy("rng")))
    differ = F.array_position(F.zip_with("last", "next", lambda a, b: a.eqNullSafe(b)), False)
    shared = F.when(F.col("next").isNull(), F.lit(-1)).otherwise(F.floor((differ - 1) / 2).cast("int"))
    found = ends.select("rng", shared.alias("shared")).orderBy("rng").collect()
    return {r.rng: (before, r.shared) for r, before in zip(found, [-1, *(x.shared for x in found)], strict=False)}


def _shared(path: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Turns that each path shares with the next; all pairs advance at once, those that differ drop out."""
    out = np.zeros(max(0, len(starts) - 2), np.int64)
    least = np.minimum(starts[1:-1] - starts[:-2], starts[2:] - starts[1:-1])
    going = np.flatnonzero(least > 0)
    depth = 0
    while len(going):
        p, q = 2 * (starts[going] + depth), 2 * (starts[going + 1] + depth)
        going = going[(path[p] == path[q]) & (path[p + 1] == path[q + 1])]
        depth += 1
        out[going] = depth
        going = going[least[going] > depth]
    return out


class Range:
    """The forest of one range of sorted, distinct paths.

    path: two hashes a turn, all rows after one another; starts: each row's first turn, then the number of turns; words: of
    each turn; conv, n, ends: of each row; before, behind: the depths shared with the neighbouring ranges.

    A component is known by its leftmost row. ``top`` is the depth of the node that its last merge made, or of its
    row's end; the figures are that node's, without the words of its own last text.
    """

    def __init__(self, path: np.ndarray, starts: np.ndarray, words: np.ndarray, conv: np.ndarray, n: np.ndarray, ends: list[str], before: int, behind: int):
        self.path, self.starts, self.words, self.ends, self.before, self.behind = path, starts, words, ends, before, behind
        self.weights = np.append(0, np.cumsum(words))
        m, length, lcp = len(conv), np.diff(starts), _shared(path, starts)
        self.parent, self.hi, self.top = list(range(m)), list(range(m)), length.tolist()
        self.least, self.n = conv.tolist(), n.tolist()
        self.leaves = (length > np.append(lcp, behind)).astype(int).tolist()  # else the next row goes on from this one
        self.children, self.total, self.own = [0] * m, [0] * m, [0] * m
        self.end = list(range(m))  # the row that ends at the top node, or -1
        self.below: list[list[int]] = [[] for _ in range(m)]  # chains that hang from the top node
        #: (first row, last row, top depth, depth it hangs from, least id, n, children, leaves, total, own, end)
        self.chains: list[tuple] = []
        self.hangs_from: list[int] = []  # the chain whose top node is a chain's parent
        for e in np.argsort(-lcp, kind="stable").tolist():
            self._merge(self._find(e), self._find(e + 1), int(lcp[e]))
        if m:
            self._close(self._find(0), -1)

    def _find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def _begins(self, row: int, depth: int) -> int:
        """1 if the node of that depth over that first row begins in this range."""
        return int(row > 0 or depth > self.before)

    def _close(self, c: int, depth: int) -> int:
        """The nodes from component c's top to just below ``depth`` are whole: a chain, which hangs from that depth."""
        k = len(self.chains)
        self.chains.append((c, self.hi[c], self.top[c], depth, self.least[c], self.n[c], self.children[c], self.leaves[c], self.total[c], self.own[c], self.end[c]))
        self.hangs_from.append(-1)
        for child in self.below[c]:
            self.hangs_from[child] = k
        return k

    def _merge(self, a: int, b: int, depth: int) -> None:
        """Component b, to the right, joins a in the node at ``depth``."""
        sums, end, below = [0, 0, 0, 0], -1, []
        for c in (a, b):
            top = self.top[c]
            if top > depth:
                at, w = self.starts[c], self.weights
                known = min(top, max(depth, self.before)) if c == 0 else depth  # nodes that deep begin in an earlier range
                parts = (self._begins(c, depth + 1), self.leaves[c], self.total[c] + self.n[c] * int(w[at + top] - w[at + depth]), self.own[c] + int(w[at + top] - w[at + known]))
                under = [self._close(c, depth)]
            else:
                parts, under = (self.children[c], self.leaves[c], self.total[c], self.own[c]), self.below[c]
                end = max(end, self.end[c])
            sums = [s + p for s, p in zip(sums, parts, strict=True)]
            below, under = (below, under) if len(below) > len(under) else (under, below)
            below.extend(under)
            self.below[c] = []
        self.parent[b] = a
        self.hi[a], self.top[a], self.end[a], self.below[a] = self.hi[b], depth, end, below
        self.least[a], self.n[a] = min(self.least[a], self.least[b]), self.n[a] + self.n[b]
        self.children[a], self.leaves[a], self.total[a], self.own[a] = sums

    def _key(self, lo: int, hi: int, depth: int) -> str | None:
        """The prefix of a node that goes on in a neighbouring range; None if it is whole."""
        if lo == 0 and depth <= self.before or hi == len(self.ends) - 1 and depth <= self.behind:
            at = 2 * self.starts[lo]
            return f"{depth}-{hashlib.sha256(self.path[at : at + 2 * depth].tobytes()).hexdigest()}"
        return None

    def nodes(self) -> Iterator[tuple]:
        """NODES of all chains."""
        for (lo, hi, top, stop, least, n, children, leaves, total, own, end), k in zip(self.chains, self.hangs_from, strict=True):
            at = int(self.starts[lo])
            weights = self.words[at + max(stop, 0) : at + top].tolist()
            key = self._key(lo, hi, top)
            for depth in range(top, stop, -1):
                weight = weights[depth - 1 - max(stop, 0)] if depth else 0
                total += n * weight
                own += weight * self._begins(lo, depth)
                up, parent = None, None
                if depth > stop + 1:
                    up, parent = self._key(lo, hi, depth - 1), least
                elif depth:
                    up, parent = self._key(*self.chains[k][:2], depth - 1), self.chains[k][4]
                yield least, depth, None if up else parent, n, children, leaves, total, own, self.ends[end] if end >= 0 else EMPTY, key, up
                key, children, end = up, self._begins(lo, depth), -1


def forests(rows: DataFrame, bounds: dict[int, tuple[int, int]]) -> DataFrame:
    """NODES of every range; ranges come to a task one after the other, each in the order of its paths."""

    def forest(rng: int, parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(parts).combine_chunks()
        col = {c: t.column(c).combine_chunks() for c in t.column_names}
        starts = np.append(0, np.cumsum(pc.list_value_length(col["words"]).to_numpy())).astype(np.int64)
        path, words = (col[c].flatten().to_numpy(zero_copy_only=False) for c in ("path", "words"))
        found = Range(path, starts, words.astype(np.int64), col["conv_id"].to_numpy(), col["n"].to_numpy(), col["ends_sha256"].to_pylist(), *bounds[rng]).nodes()
        kinds = [pa.int64()] * 8 + [pa.string()] * 3
        while some := list(islice(found, 20_000)):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*some, strict=True), kinds, strict=True)], [x.split()[0] for x in NODES.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, now = [], None
        for b in batches:
            rng = b.column("rng").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(rng)) + 1).tolist(), len(rng)]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                if hi == lo:
                    continue
                if now is not None and rng[lo] != now:
                    yield from forest(now, held)
                    held = []
                now = int(rng[lo])
                held.append(b.slice(lo, hi - lo))
        if held:
            yield from forest(now, held)

    return stored(rows.repartition("rng").sortWithinPartitions("rng", "path").mapInArrow(run, NODES), "nodes")


def prefix_trie(conversations: DataFrame, every: int | None = 20, turns: int = 8192) -> DataFrame:
    """One row for each distinct prefix of the sequences of turns.

    every: conversations are first regrown on those whose ids are its multiples; None takes them as they are.
    turns: about so many, in distinct sequences, make a range.
    """
    convs = stored(sequences(conversations), "sequences")
    rows = classes(regrown(convs, every) if every else convs, turns)
    nodes = forests(rows, boundaries(rows))
    figures = ["n_convs", "n_children", "n_leaves", "total", "own"]
    parts = nodes.where("key IS NOT NULL").groupBy("key").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("parent_key").alias("parent_key"), *[F.sum(c).alias(c) for c in figures],
        F.coalesce(F.max(F.when(F.col("ends_sha256") != EMPTY, F.col("ends_sha256"))), F.lit(EMPTY)).alias("ends_sha256"),
    )
    parts = stored(parts.withColumn("parent_conv_id", F.lit(None).cast("long")), "open_nodes")
    every_node = nodes.where("key IS NULL").unionByName(parts)
    parents = parts.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    under = every_node.where("parent_key IS NOT NULL").join(parents, "parent_key").withColumn("parent_conv_id", F.col("parent")).drop("parent")
    whole = every_node.where("parent_key IS NULL").unionByName(under)
    return whole.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("total") - F.col("own")).alias("saved_tokens"), "ends_sha256")
