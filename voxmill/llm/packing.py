"""Lexical retrieval packing.

Documents are encoded once into a table of the shared folder. Document frequencies of all tokens give BM25
weights. Each document goes to the shard of its key, a weighted min-hash of its tokens, so that lexical neighbours and copies
meet with a chance that grows with what they share; shards are sized by their tokens, and a key that holds too many is
spread over several shards. Inside a shard an inverted index answers, for each seed and all of its terms, which unused documents
score best; they fill the seed's window in that order until it is full. The one that no longer fits is cut, and its
rest is the next seed, so only the last window of a shard has padding.

Work: one shuffle of token ids (two bytes each). To the driver come tables of at most one row
per vocabulary entry. A task holds one shard, about ``shard_tokens`` tokens.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.llm.common import pick, small_batches, stored, text_or_empty
from voxmill.llm.shingles import mixed
from voxmill.llm.tokens import VOCABULARY, encoder

END_ID = 1
K1, B = 1.2, 0.75
#: A term that more than one in so many documents of an index has is a column of its matrix.
DENSE = 8
SHARDS_A_TASK = 4
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def encoded(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id and ids (little-endian unsigned 16-bit, END_ID last) of each row; a null text has END_ID alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            ids = [np.append(enc.encode(t.as_py()), END_ID).astype("<u2").tobytes() for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    if encoder(vocabulary).size > 1 << 16:
        raise ValueError("ids don't fit 16 bits")
    rows = pick(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).withColumn("text", text_or_empty())
    return stored(rows.mapInArrow(run, "doc_id long, ids binary"), "encoded")


def _ids(cell: pa.Scalar) -> np.ndarray:
    return np.frombuffer(cell.as_buffer(), "<u2")


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, ascending, and how often each occurs; as np.unique() gives them, in a third of the time."""
    if len(ids) > 2000:
        counts = np.bincount(ids)
        at = np.flatnonzero(counts)
        return at, counts[at]
    s = np.sort(ids)
    new = np.flatnonzero(np.append(True, s[1:] != s[:-1]))
    return s[new], np.diff(np.append(new, len(s)))


def _per_token(coded: DataFrame, size: int, weigh) -> np.ndarray:
    """Sums over all documents of ``weigh(ids) -> (tokens, amounts)``, as one array over the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for b in batches:
            for cell in b.column("ids"):
                tokens, amounts = weigh(_ids(cell))
                total[tokens] += amounts
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["token", "n"])

    out = np.zeros(size, np.int64)
    for r in coded.select("ids").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).collect():
        out[r.token] = r.n
    return out


def sketch_costs(idf: np.ndarray) -> np.ndarray:
    """Per token: its draw. The token of a document with the least draw is the document's key.

    This is weighted min-hashing: two documents have the same key with a chance that is the share of their distinct tokens, weighted
    by the root of idf, that they have in common.
    """
    u = (mixed(np.arange(len(idf), dtype=np.uint64), 5) >> np.uint64(11)).astype(float) / (1 << 53) + 2.0**-60
    return -np.log(u) / np.sqrt(np.maximum(idf, 1e-9))


def sketch_key(ids: np.ndarray, costs: np.ndarray) -> int:
    return int(ids[np.argmin(costs[ids])])


def shard_plan(load: np.ndarray, shard_tokens: int) -> tuple[np.ndarray, np.ndarray]:
    """Per token: its first shard and over how many shards it is spread. Neighbouring light tokens share a shard."""
    first, spread, shard, filled = np.zeros(len(load), np.int64), np.ones(len(load), np.int64), 0, 0
    for t in np.flatnonzero(load):
        if filled and filled + load[t] > shard_tokens:
            shard, filled = shard + 1, 0
        first[t], spread[t] = shard, max(1, -(-int(load[t]) // shard_tokens))
        filled += int(load[t])
        if spread[t] > 1:
            shard, filled = shard + int(spread[t]), 0
    return first, spread


class Index:
    """The BM25 inverted index of a shard's documents that aren't used yet."""

    def __init__(self, counts: list[tuple[np.ndarray, np.ndarray]], lengths: np.ndarray, idf: np.ndarray, mean: float, members: np.ndarray):
        self.members = members
        terms = np.concatenate([counts[i][0] for i in members])
        owner = np.repeat(np.arange(len(members)), [len(counts[i][0]) for i in members])
        tf = np.concatenate([counts[i][1] for i in members]).astype(np.float32)
        norm = (K1 * (1 - B + B * lengths[members] / mean)).astype(np.float32)
        weight = idf[terms] * tf * np.float32(K1 + 1) / (tf + norm[owner])
        order = np.argsort(terms, kind="stable")
        terms, self.owner, weight = terms[order], owner[order], weight[order]
        found, starts, sizes = np.unique(terms, return_index=True, return_counts=True)
        # terms of many documents are columns of a matrix, the others lists
        wide = sizes * DENSE > len(members)
        self.column = np.full(len(idf), -1, np.int64)
        self.column[found[wide]] = np.arange(wide.sum())
        self.dense = np.zeros((int(wide.sum()), len(members)), np.float32)
        inside = self.column[terms] >= 0
        self.dense[self.column[terms[inside]], self.owner[inside]] = weight[inside]
        self.weight = weight
        self.begin, self.size = np.zeros(len(idf), np.int64), np.zeros(len(idf), np.int64)
        self.begin[found[~wide]], self.size[found[~wide]] = starts[~wide], sizes[~wide]

    def scores(self, query: np.ndarray) -> np.ndarray:
        """Scores of ``members`` for all distinct terms of a query."""
        columns = self.column[query]
        share = np.zeros(len(self.dense), np.float32)
        share[columns[columns >= 0]] = 1
        out = share @ self.dense
        sizes = self.size[query]
        runs = sizes > 0
        begins, sizes = self.begin[query][runs], sizes[runs]
        total = int(sizes.sum())
        if total:
            at = np.repeat(begins - np.append(0, np.cumsum(sizes))[:-1], sizes) + np.arange(total)
            out = out + np.bincount(self.owner[at], self.weight[at], len(self.members)).astype(np.float32)
        return out


def in_order(score: np.ndarray, first: int = 32) -> Iterator[int]:
    """Places by falling score, then by place: the first few are picked out, the others sorted only if asked for."""
    if len(score) > first:
        edge = np.partition(score, len(score) - first)[len(score) - first]
        top = np.flatnonzero(score > edge)
        yield from top[np.lexsort((top, -score[top]))].tolist()
        rest = np.flatnonzero(score <= edge)
    else:
        rest = np.arange(len(score))
    yield from rest[np.lexsort((rest, -score[rest]))].tolist()


def pack_shard(docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of each piece; every id lies in one piece.

    A window is filled with unused documents by falling score for its seed, all terms counted, until it is full.
    """
    pieces, sequence, rest = [], 0, {}
    for i, d in enumerate(docs):
        whole = len(d) // window
        for k in range(whole):
            pieces.append((i, k * window, window, sequence, 0))
            sequence += 1
        if len(d) % window:
            rest[i] = whole * window
    if not rest:
        return pieces
    idf = idf.astype(np.float32)
    counts = [counted(d) for d in docs]
    lengths = np.array([len(d) for d in docs])
    unused = np.zeros(len(docs), bool)
    unused[list(rest)] = True
    left, index = len(rest), None
    next_one, seed = 0, None
    while seed is not None or left:
        if seed is None:
            next_one += int(np.argmax(unused[next_one:]))
            seed = next_one
            unused[seed] = False
            left -= 1
        room, at, found = window, seed, None
        while True:
            take = min(room, len(docs[at]) - rest[at])
            pieces.append((at, rest[at], take, sequence, window - room))
            rest[at] += take
            room -= take
            if not room or not left:
                break
            if found is None:
                # the index is made anew when half of it is used, so that it shrinks with what is left
                if index is None or 2 * left < len(index.members):
                    index = Index(counts, lengths, idf, mean, np.flatnonzero(unused))
                score = np.where(unused[index.members], index.scores(counts[seed][0]), np.float32(-1))
                found = in_order(score)
            at = next(int(index.members[j]) for j in found if unused[index.members[j]])
            unused[at] = False
            left -= 1
        seed = at if rest[at] < len(docs[at]) else None
        sequence += 1
    return pieces


def pack(docs: DataFrame, window: int = 2048, shard_tokens: int = 1 << 20, vocabulary: str = VOCABULARY) -> DataFrame:
    """The pieces of docs(doc_id, text) in sequences of at most ``window`` ids; see PIECES.

    Null texts count as empty: a document of END_ID alone. Repeated rows are documents of their own. An empty
    table has no pieces. Padding: at most one unfilled sequence per shard.
    """
    small_batches(docs.sparkSession)
    coded = encoded(docs, vocabulary)
    size = encoder(vocabulary).size

    def once(ids: np.ndarray) -> tuple[np.ndarray, int]:
        return counted(ids)[0], 1

    df = _per_token(coded, size, once)
    count, total = coded.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("ids")), F.lit(0)) / 2).first()
    idf = np.log1p((count - df + 0.5) / (df + 0.5))
    mean = max(1.0, float(total) / max(count, 1))

    costs = sketch_costs(idf)

    def key_load(ids: np.ndarray) -> tuple[int, int]:
        return sketch_key(ids, costs), len(ids)

    first, spread = shard_plan(_per_token(coded, size, key_load), shard_tokens)
    # a few shards a task, whatever the corpus
    tasks = int(-(-(first + spread).max(initial=1) // SHARDS_A_TASK))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            shards = []
            for cell, i in zip(b.column("ids"), b.column("doc_id"), strict=True):
                key = sketch_key(_ids(cell), costs)
                shards.append(int(first[key]) + (zlib.crc32(str(i.as_py()).encode()) ^ zlib.crc32(cell.as_buffer())) % int(spread[key]))
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.int64()), b.column("doc_id"), b.column("ids")], ["shard", "doc_id", "ids"])

    def packed(group: pa.Table) -> pa.Table:
        shard = group.column("shard")[0].as_py()
        rows = sorted(((r.as_py() is None, r.as_py() or 0, c.as_buffer().to_pybytes()) for r, c in zip(group.column("doc_id"), group.column("ids"), strict=True)))
        ids = [np.frombuffer(r[2], "<u2") for r in rows]
        out = [
            (None if rows[i][0] else rows[i][1], start, length, zlib.crc32(ids[i][start : start + length].astype("<u4").tobytes()), len(ids[i]), shard << 32 | seq, offset)
            for i, start, length, seq, offset in pack_shard(ids, idf, mean, window)
        ]
        names = [x.split()[0] for x in PIECES.split(", ")]
        return pa.table({n: pa.array([r[k] for r in out], pa.int64()) for k, n in enumerate(names)})

    return coded.mapInArrow(placed, "shard long, doc_id long, ids binary").repartition(tasks, "shard").groupBy("shard").applyInArrow(packed, PIECES)
