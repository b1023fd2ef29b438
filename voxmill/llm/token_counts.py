"""Token counts of the sections of a document, by offset-mapped attribution.

A whole document is encoded once; the byte lengths of its ids give each token's span in the text. Tokens are
joined to the sections by interval, both sides being in order, and a token that crosses a boundary
goes where ``rule`` says:

- ``first``: to the section of its first byte;
- ``last``: to that of its last byte;
- ``most``: to the section that holds most of its bytes, the earlier on a tie.

So the counts of a document's sections add up to its tokens under any rule. Sections are given by
their start offsets in code points; the default takes each line, with the line feed that ends it. A task
holds a batch of documents, and nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.llm.common import pick, small_batches, text_or_empty
from voxmill.llm.tokens import VOCABULARY, encoder

RULES = ("first", "last", "most")
RESULT = "doc_id long, section int, start long, end long, n_tokens long, n_crossing long, doc_tokens long"


def line_starts(text: str) -> np.ndarray:
    """Code points at which a line begins."""
    points = np.frombuffer(text.encode("utf-32-le"), "<u4")
    starts = np.flatnonzero(points == 10) + 1
    return np.append(0, starts[starts < len(points)])


def byte_offsets(text: str, points: np.ndarray) -> np.ndarray:
    """UTF-8 offsets of offsets in code points."""
    raw = np.frombuffer(text.encode(), np.uint8)
    return np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))[points]


def attributed(ends: np.ndarray, starts: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, crossing tokens) per section. ends: of each token, in bytes; starts: of each section, from 0."""
    begins = np.append(0, ends)[:-1]
    head, tail = np.searchsorted(starts, begins, "right") - 1, np.searchsorted(starts, ends - 1, "right") - 1
    owner = head if rule == "first" else tail.copy()
    crossing = head != tail
    if rule == "most":
        owner = head.copy()
        for i in np.flatnonzero(crossing):
            cuts = np.array([begins[i], *starts[head[i] + 1 : tail[i] + 1], ends[i]])
            owner[i] = head[i] + int(np.argmax(np.diff(cuts)))
    return np.bincount(owner, minlength=len(starts)), np.bincount(owner[crossing], minlength=len(starts))


def count_tokens(docs: DataFrame, sections: str | None = None, rule: str = "first", vocabulary: str = VOCABULARY) -> DataFrame:
    """RESULT for every section of every row of docs(doc_id, text).

    sections: a column with an array of ascending start offsets in code points; text before the first is a section
    as well, repeated offsets and those outside the text are left out, and null means one section. A null or
    empty text has one section with no tokens. Repeated rows are counted each.
    """
    if rule not in RULES:
        raise ValueError(f"no such rule: {rule}")
    small_batches(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for b in batches:
            out: list[list[np.ndarray]] = [[] for _ in range(7)]
            ids_of, given = b.column("doc_id").to_pylist(), b.column("sections").to_pylist() if sections else None
            owner: list = []
            for k, cell in enumerate(b.column("text")):
                text = cell.as_py()
                if sections:
                    inside = sorted({0, *(x for x in given[k] or () if x is not None and 0 < x < len(text))})
                    points = np.array(inside, np.int64)
                else:
                    points = line_starts(text)
                starts = byte_offsets(text, points)
                ends = np.cumsum(enc.n_bytes[enc.encode(text)])
                own, crossing = attributed(ends, starts, rule)
                owner += [ids_of[k]] * len(points)
                for col, x in zip(out[1:], (np.arange(len(points)), points, np.append(points[1:], len(text)), own, crossing, np.full(len(points), len(ends))), strict=True):
                    col.append(x)
            if owner:
                cols = [pa.array(owner, pa.int64())] + [pa.array(np.concatenate(c)).cast(pa.int32() if i == 0 else pa.int64()) for i, c in enumerate(out[1:])]
                yield pa.RecordBatch.from_arrays(cols, [x.split()[0] for x in RESULT.split(", ")])

    cols = [F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")]
    names = ["doc_id", "text"]
    if sections:
        cols.append(F.col(sections).cast("array<bigint>").alias("sections"))
        names.append(sections)
    return pick(docs, *names).select(*cols).mapInArrow(run, RESULT)
