"""Cross-tokenizer alignment by lockstep merging.

Each text is encoded by a byte-level vocabulary A and a piece vocabulary B. The byte ends of both are merged: two
pointers stand at the tokens that overlap now, a link is emitted, and the pointer whose token ends first moves on; where both
end at once there is a cut, and cuts part the tokens into groups. All documents of a batch advance at once: the pointers are
two numpy vectors with one entry a lane, a step moves every lane, and finished lanes are compacted away. A
lane is a run of at most ``LANE`` tokens of A in one document, so a very long text is many lanes, not many steps.

A document's links, as distinct (A id, B id) pairs with their numbers, are stored once in the shared folder. Their
corpus-wide counts are summed inside each task before they are shuffled. The commonest pairs, ``table`` of them at most, are
sent to every task as a sorted table; links of all other pairs are joined to their counts by a shuffle. So the result is whole
whatever the table holds, and the table's size is bounded.

Odd input: null and empty texts, and texts whose tokens don't give back their bytes, have no tokens and zeros, and '' as digest.
Repeated rows, and rows without an id, are rows of their own, and each counts. No rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.llm.common import pick, small_batches, stored, text_or_empty
from voxmill.llm.tokens import PIECES, VOCABULARY, Encoder, PieceEncoder, encoder, piece_encoder

#: Tokens of A in a lane.
LANE = 128
#: What stands behind an id in a digest: a like one follows, the other side, another group, the end.
SIGNS = (b",", b"|", b";", b"")
#: Distinct pairs that a task holds before it sends their sums on.
HELD = 1 << 20
_NONE = np.zeros(0, np.uint32)
ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary, times binary"
RESULT = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def lockstep(ends_a: np.ndarray, ends_b: np.ndarray, first_a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(link A, link B, cut A, cut B): places of the tokens of each link, and whether a token ends at a cut.

    ends_*: byte ends, ascending over all documents of a batch, whose bytes follow one another. first_a: the place
    of each document's first token of A, then the number of tokens.
    """
    cut_a, cut_b = np.zeros(len(ends_a), bool), np.zeros(len(ends_b), bool)
    sizes = np.diff(first_a)
    lanes = -(-sizes // LANE)
    a = np.repeat(first_a[:-1], lanes) + LANE * (np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes))
    stop = np.minimum(a + LANE, np.repeat(first_a[1:], lanes))
    b = np.searchsorted(ends_b, np.append(0, ends_a)[a], "right")
    links_a, links_b = [a[:0]], [b[:0]]
    while len(a):
        links_a.append(a)
        links_b.append(b)
        end_a, end_b = ends_a[a], ends_b[b]
        both = end_a == end_b
        cut_a[a[both]] = True
        cut_b[b[both]] = True
        a, b = a + (end_a <= end_b), b + (end_b <= end_a)
        going = a < stop
        if not going.all():
            a, b, stop = a[going], b[going], stop[going]
    return np.concatenate(links_a), np.concatenate(links_b), cut_a, cut_b


def _tokens(text: str, enc_a: Encoder, enc_b: PieceEncoder) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a text in both vocabularies; none unless they give back its bytes. A's are cut from the text, so their length tells."""
    a, b = (enc_a.encode(f" {text}"), enc_b.encode(text)) if text else (_NONE, _NONE)
    want = f" {text}".encode()
    if enc_a.n_bytes[a].sum() == len(want) and b"".join(map(enc_b.bytes_of.__getitem__, b.tolist())) == want:
        return a, b
    return _NONE, _NONE


@cache
def signed_ids(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Each id as decimal bytes with one of ``SIGNS`` behind it, in eight bytes that end in zeros; and how many there are."""
    words = [b"%d%s" % (i, sign) for i in range(size) for sign in SIGNS]
    return np.array(words, "S8").view("<u8"), np.array([len(w) for w in words])


def digests(ids: Sequence[np.ndarray], cuts: Sequence[np.ndarray], firsts: Sequence[np.ndarray], signed: tuple[np.ndarray, np.ndarray]) -> list[str]:
    """The digest of each document's groups, `a1,a2|b1;a3|b2,b3`; '' without tokens."""
    if not len(ids[0]):
        return [""] * (len(firsts[0]) - 1)
    groups = [np.cumsum(np.append(0, c[:-1])) for c in cuts]
    ends = [np.flatnonzero(c) + 1 for c in cuts]  # of each group, in tokens
    place = [np.arange(len(ids[0])) + np.append(0, ends[1][:-1])[groups[0]], np.arange(len(ids[1])) + ends[0][groups[1]]]
    flat = np.zeros(len(ids[0]) + len(ids[1]), np.int64)
    for i, p in zip(ids, place, strict=True):
        flat[p] = i * len(SIGNS)
    flat[place[0][cuts[0]]] += 1
    flat[place[1][cuts[1]]] += 2
    last = firsts[0][1:] + firsts[1][1:]
    some = np.diff(firsts[0]) > 0
    flat[last[some] - 1] += 1
    cells = signed[0][flat].view(np.uint8)
    raw = memoryview(cells[cells != 0])
    at = np.append(0, np.cumsum(signed[1][flat]))[np.append(0, last)].tolist()
    return [hashlib.sha256(raw[s:e]).hexdigest() if e > s else "" for s, e in zip(at[:-1], at[1:], strict=True)]


def _summed(codes: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    new = np.flatnonzero(np.append(True, codes[1:] != codes[:-1])) if len(codes) else np.zeros(0, np.int64)
    return codes[new], np.add.reduceat(times[order], new) if len(new) else times[:0]


def aligned(docs: DataFrame, vocabulary: str, pieces: str) -> DataFrame:
    """A stored row for each document: its figures and its distinct pairs, packed as ascending differences and their numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc_a, enc_b = encoder(vocabulary, True), piece_encoder(pieces)
        signed = signed_ids(max(enc_a.size, enc_b.size))
        for batch in batches:
            both = [_tokens(t.as_py(), enc_a, enc_b) for t in batch.column("text")]
            n = len(both)
            ids = tuple(np.concatenate([_NONE, *(x[k] for x in both)]).astype(np.int64) for k in (0, 1))
            firsts = tuple(np.append(0, np.cumsum([len(x[k]) for x in both])).astype(np.int64) for k in (0, 1))
            link_a, link_b, *cuts = lockstep(np.cumsum(enc_a.n_bytes[ids[0]]), np.cumsum(enc_b.n_bytes[ids[1]]), firsts[0])
            doc = np.repeat(np.arange(n), np.diff(firsts[0]))
            owner, codes = doc[link_a], ids[0][link_a] * enc_b.size + ids[1][link_b]
            n_links = np.bincount(owner, minlength=n)
            space = enc_a.size * enc_b.size
            keys, times = np.unique(owner * space + codes, return_counts=True)  # at most 500 documents a batch
            bounds = np.searchsorted(keys, np.arange(n + 1) * space)
            pairs = [np.diff(keys[s:e], prepend=i * space).astype("<u4" if space < 1 << 32 else "<u8").tobytes() for i, (s, e) in enumerate(zip(bounds[:-1], bounds[1:], strict=True))]
            many = [times[s:e].astype("<u4").tobytes() for s, e in zip(bounds[:-1], bounds[1:], strict=True)]
            groups = np.bincount(doc[cuts[0]], minlength=n)
            cols = [batch.column("doc_id"), *(pa.array(x.astype(np.int64)) for x in (*map(np.diff, firsts), groups, n_links)), pa.array(digests(ids, cuts, firsts, signed), pa.string()), pa.array(pairs, pa.binary()), pa.array(many, pa.binary())]
            yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in ALIGNED.split(", ")])

    rows = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return stored(rows.mapInArrow(run, ALIGNED).withColumn("rk", F.monotonically_increasing_id()), "aligned")


def _links(batch: pa.RecordBatch, space: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, pair, number) of a batch's distinct pairs."""
    kind = np.dtype("<u4" if space < 1 << 32 else "<u8")
    cells = [(np.frombuffer(p.as_buffer(), kind), np.frombuffer(t.as_buffer(), "<u4")) for p, t in zip(batch.column("pairs"), batch.column("times"), strict=True)]
    if not cells:
        return (np.zeros(0, np.int64),) * 3
    row = np.repeat(np.arange(len(cells)), [len(p) for p, _ in cells])
    return row, np.concatenate([np.cumsum(p, dtype=np.int64) for p, _ in cells]), np.concatenate([t for _, t in cells]).astype(np.int64)


def pair_counts(rows: DataFrame, space: int, size_b: int) -> DataFrame:
    """(pair, n, best): how many links hold a pair, and whether none of its B id's pairs has more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def sums() -> tuple[np.ndarray, np.ndarray]:
            return _summed(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))

        for batch in batches:
            _, codes, times = _links(batch, space)
            held.append((codes, times))
            n += len(codes)
            if n > 2 * HELD:
                held = [sums()]
                n = len(held[0][0])
                if n > HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["pair", "n"])
                    held, n = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in sums()], ["pair", "n"])

    counts = stored(rows.select("pairs", "times").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")), "pair_counts")
    most = counts.groupBy((F.col("pair") % size_b).alias("b")).agg(F.max("n").alias("most"))
    return stored(counts.join(most, counts.pair % size_b == most.b).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "best_pairs")


def _commonest(counts: DataFrame, table: int) -> tuple[int, tuple[np.ndarray, ...]]:
    """The least power of two such that at most ``table`` pairs occur so often, and those pairs with n and best, by pair."""
    by_size = dict(counts.groupBy(F.length(F.bin("n")).alias("bits")).count().collect())
    bits, total = 64, 0
    while bits > 1 and total + by_size.get(bits - 1, 0) <= table:
        bits -= 1
        total += by_size.get(bits, 0)
    found = counts.where(F.col("n") >= F.lit(1 << (bits - 1) if bits < 64 else (1 << 63) - 1)).toArrow()
    order = np.argsort(found["pair"].to_numpy())
    return bits, tuple(found[c].to_numpy()[order] for c in ("pair", "n", "best"))


def align(docs: DataFrame, vocabulary: str = VOCABULARY, pieces: str = PIECES, table: int = 1 << 19) -> DataFrame:
    """RESULT for every row of docs(doc_id, text).

    n_best: links whose pair's count is its B id's highest; count_sum: the pairs' counts summed over links.
    """
    spark = docs.sparkSession
    small_batches(spark)
    size_b = piece_encoder(pieces).size
    space = encoder(vocabulary, True).size * size_b
    rows = aligned(docs, vocabulary, pieces)
    counts = pair_counts(rows, space, size_b)
    _, known = _commonest(counts, table)
    shared = spark.sparkContext.broadcast(known)
    plain = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "rk"]
    out = "n_best long, count_sum long, pair long, times long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, n, best = shared.value
        for batch in batches:
            row, codes, times = _links(batch, space)
            at = np.searchsorted(pair, codes)
            found = at < len(pair)
            found[found] = pair[at[found]] == codes[found]
            sums = [np.zeros(batch.num_rows, np.int64) for _ in range(2)]
            np.add.at(sums[0], row[found], times[found] * best[at[found]])
            np.add.at(sums[1], row[found], times[found] * n[at[found]])
            none = pa.nulls(batch.num_rows, pa.int64())
            names = [*plain, "n_best", "count_sum", "pair", "times"]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in plain), *map(pa.array, sums), none, none], names)
            left = np.flatnonzero(~found)
            if len(left):
                none = [pa.nulls(len(left), batch.schema.field(c).type) for c in plain[:-1]]
                keys = pa.array(batch.column("rk").to_numpy()[row[left]])
                yield pa.RecordBatch.from_arrays([*none, keys, *(pa.nulls(len(left), pa.int64()) for _ in range(2)), pa.array(codes[left]), pa.array(times[left])], names)

    schema = ", ".join(f"{c} {t}" for c, t in rows.select(*plain).dtypes)
    both = stored(rows.select(*plain, "pairs", "times").mapInArrow(run, f"{schema}, {out}"), "looked_up")
    rare = (
        both.where("pair IS NOT NULL").select("rk", "pair", "times").join(counts, "pair")
        .groupBy("rk").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    )
    whole = both.where("pair IS NULL").drop("pair", "times").join(rare, "rk", "left")
    return whole.withColumns({"n_best": F.col("n_best") + F.coalesce("more_best", F.lit(0)), "count_sum": F.col("count_sum") + F.coalesce("more_sum", F.lit(0))}).select(*RESULT)
