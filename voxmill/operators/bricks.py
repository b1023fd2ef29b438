"""Dense voxels as bricks of 4,096 cells, 16 x 16 x 16 of a volume or 64 x 64 of an image: little-endian u16 bytes, x fastest; an absent brick or cell is 0.

A brick's key is any columns ``by`` (a node and a channel, say) and its place i, j, k in units of a brick. Partial bricks of
one key are combined by their greatest values: in a table inside each task first, which holds a bounded number, then by one shuffle of what is left,
where the sorted bricks of a key stream through one brick. So no task's memory depends on how many partials a key has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIDE = 16
VOLUME, IMAGE = (SIDE, SIDE, SIDE), (64, 64, 1)
CELLS = 4096
PLACE = ("i", "j", "k")
#: Bricks that a task's table holds before they are sent on: 8 kB each.
HELD = 2048
#: Sparse voxels, or bricks, that are worked on at once.
VOXELS_AT_ONCE, BRICKS_AT_ONCE = 4096, 256


class Table:
    """Bricks by key, into which voxels are written by their greatest value. A key is a tuple of the ``by`` values and the place."""

    def __init__(self, schema: pa.Schema, sides: tuple[int, int, int] = VOLUME):
        self.schema, self.sides, self.slots, self.data = schema, sides, {}, np.zeros((64, CELLS), np.uint16)

    def __len__(self) -> int:
        return len(self.slots)

    def _slot(self, key: tuple) -> int:
        at = self.slots.setdefault(key, len(self.slots))
        if at >= len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        return at

    def add(self, owner: np.ndarray, owners: list[tuple], at: list[np.ndarray], v: np.ndarray) -> None:
        """Voxels at x, y, z (not negative), each of ``owners[owner]``."""
        if not len(v):
            return
        code, spans = owner.astype(np.int64), []
        for a, side in zip(at, self.sides, strict=True):
            brick = a // side
            span = int(brick.max()) + 1
            code = code * span + brick
            spans.append(span)
        which, found = pd.factorize(code)
        slots = np.empty(len(found), np.int64)
        for n, c in enumerate(found.tolist()):
            place = []
            for span in reversed(spans):
                c, p = divmod(c, span)
                place.append(p)
            slots[n] = self._slot((*owners[c], *reversed(place)))
        x, y, z = (a % side for a, side in zip(at, self.sides, strict=True))
        np.maximum.at(self.data.reshape(-1), slots[which] * CELLS + (z * self.sides[1] + y) * self.sides[0] + x, v)

    def taken(self, but: tuple | None = None) -> pa.RecordBatch:
        """All bricks, which leave the table; those whose key is ``but`` with any i and j stay."""
        stay = [(k, n) for k, n in self.slots.items() if but is not None and (*k[:-3], k[-1]) == but]
        if stay:
            kept = self.data[[n for _, n in stay]]
            gone = [k for k in self.slots if (*k[:-3], k[-1]) != but]
            self.data, self.slots = self.data[[self.slots[k] for k in gone]], {k: n for n, k in enumerate(gone)}
            out = self.taken()
            self.slots, self.data = {k: n for n, (k, _) in enumerate(stay)}, np.concatenate([kept, np.zeros((64, CELLS), np.uint16)])
            return out
        keys = zip(*self.slots, strict=True) if self.slots else [[]] * (len(self.schema) - 1)
        cols = [pa.array(list(k), f.type) for k, f in zip(keys, self.schema, strict=False)]
        out = pa.RecordBatch.from_arrays([*cols, as_binary(self.data[: len(self.slots)])], schema=self.schema)
        self.slots, self.data = {}, np.zeros((64, CELLS), np.uint16)
        return out


def as_binary(cells: np.ndarray) -> pa.Array:
    offsets = np.arange(len(cells) + 1, dtype=np.int32) * (2 * CELLS)
    return pa.Array.from_buffers(pa.binary(), len(cells), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(cells).astype("<u2", copy=False))])


def as_cells(column: pa.Array) -> np.ndarray:
    """The (n, CELLS) values of a column of bricks."""
    if not len(column):
        return np.zeros((0, CELLS), np.uint16)
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[ends[0] : ends[-1]].view("<u2").reshape(-1, CELLS)


def _kinds(df: DataFrame, by: tuple[str, ...]) -> tuple[str, pa.Schema]:
    from pyspark.sql.pandas.types import to_arrow_type

    text = ", ".join([*(f"{c} {df.schema[c].dataType.simpleString()}" for c in by), *(f"{p} int" for p in PLACE), "data binary"])
    return text, pa.schema([*((c, to_arrow_type(df.schema[c].dataType)) for c in by), *((p, pa.int32()) for p in PLACE), ("data", pa.binary())])


def owners_of(batch: pa.RecordBatch, by: tuple[str, ...]) -> tuple[np.ndarray, list[tuple]]:
    """(number of each row's owner, the owners): the distinct values of the ``by`` columns."""
    if not by:
        return np.zeros(batch.num_rows, np.int64), [()]
    which, found = pd.factorize(pd.MultiIndex.from_arrays([batch.column(c).to_pylist() for c in by])) if len(by) > 1 else pd.factorize(batch.column(by[0]).to_pandas())
    return which, [k if len(by) > 1 else (k.item() if hasattr(k, "item") else k,) for k in found]


def pack(voxels: DataFrame, by: tuple[str, ...] = ("c",), sides: tuple[int, int, int] = VOLUME) -> DataFrame:
    """(by, i, j, k, data): partial bricks of voxels(by, x, y, z, v), whose values fit 16 bits; the voxels of one key that a task holds at once share a brick."""
    text, schema = _kinds(voxels, by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(schema, sides)
        for whole in batches:
            for s in range(0, whole.num_rows, VOXELS_AT_ONCE):
                b = whole.slice(s, VOXELS_AT_ONCE)
                table.add(*owners_of(b, by), [b.column(a).to_numpy().astype(np.int64) for a in "xyz"], b.column("v").to_numpy().astype(np.uint16))
                if len(table) > HELD:
                    yield table.taken()
        yield table.taken()

    return voxels.select(*by, "x", "y", "z", "v").mapInArrow(run, text)


def merged(bricks: DataFrame, by: tuple[str, ...] = ("c",)) -> DataFrame:
    """One brick a key: the greatest values of all partial ones. One shuffle of bricks, one brick in hand."""
    text, schema = _kinds(bricks, by)
    key = [*by, *PLACE]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: pa.RecordBatch | None = None  # the key in hand, and its values so far
        best = np.zeros(CELLS, np.uint16)
        for b in (whole.slice(s, BRICKS_AT_ONCE) for whole in batches for s in range(0, whole.num_rows, BRICKS_AT_ONCE)):
            keys = b.select(key)
            new = np.zeros(b.num_rows, bool)
            for c in keys.columns:
                new[1:] |= pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)
            starts = np.append(0, np.flatnonzero(new))
            best_of = np.maximum.reduceat(as_cells(b.column("data")), starts, axis=0)
            heads = keys.take(pa.array(starts))
            if last is not None:
                if heads.slice(0, 1).equals(last):
                    best_of[0] = np.maximum(best_of[0], best)
                else:
                    yield pa.RecordBatch.from_arrays([*last.columns, as_binary(best[None])], schema=schema)
            n = len(starts) - 1
            yield pa.RecordBatch.from_arrays([*heads.slice(0, n).columns, as_binary(best_of[:n])], schema=schema)
            last, best = heads.slice(n, 1), best_of[n].copy()
        if last is not None:
            yield pa.RecordBatch.from_arrays([*last.columns, as_binary(best[None])], schema=schema)

    return bricks.select(*key, "data").repartition(*key).sortWithinPartitions(*key).mapInArrow(run, text)


def merged_but_solo(bricks: DataFrame, shared: str, by: tuple[str, ...] = ("c",)) -> DataFrame:
    """As ``merged``, of bricks that know whether others may share their key (the boolean column ``shared``): the rest aren't shuffled."""
    return bricks.where(f"NOT {shared}").select(*by, *PLACE, "data").unionByName(merged(bricks.where(shared), by))


def lit(cells: np.ndarray, sides: tuple[int, int, int] = VOLUME) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(brick, [x, y, z] in it, value) of the cells over 0."""
    brick, at = np.nonzero(cells)
    return brick, [at % sides[0], at // sides[0] % sides[1], at // (sides[0] * sides[1])], cells[brick, at]


def unpack(bricks: DataFrame, by: tuple[str, ...] = ("c",), sides: tuple[int, int, int] = VOLUME) -> DataFrame:
    """(by, x, y, z, v) of the voxels over 0."""
    text, schema = _kinds(bricks, by)
    schema = pa.schema([*list(schema)[: len(by)], *((a, pa.int32()) for a in (*"xyz", "v"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for s in range(0, whole.num_rows, BRICKS_AT_ONCE):
                b = whole.slice(s, BRICKS_AT_ONCE)
                brick, at, v = lit(as_cells(b.column("data")), sides)
                place = [b.column(p).to_numpy()[brick] * side for p, side in zip(PLACE, sides, strict=True)]
                own = b.select(list(by)).take(pa.array(brick)).columns if by else []
                yield pa.RecordBatch.from_arrays([*own, *(pa.array((p + a).astype(np.int32)) for p, a in zip(place, at, strict=True)), pa.array(v.astype(np.int32))], schema=schema)

    kinds = [k for k in text.split(", ")[: len(by)]]
    return bricks.select(*by, *PLACE, "data").mapInArrow(run, ", ".join([*kinds, "x int", "y int", "z int", "v int"]))


def _cubes(cells: np.ndarray) -> np.ndarray:
    """(n, 8, 8, 8, 8): the eight values of each 2 x 2 x 2 cube last, the cube's first voxel first."""
    h = SIDE // 2
    return cells.reshape(-1, h, 2, h, 2, h, 2).transpose(0, 1, 3, 5, 2, 4, 6).reshape(-1, h, h, h, 8)


def mean_of(cubes: np.ndarray) -> np.ndarray:
    return (cubes.sum(-1, dtype=np.uint32) >> 3).astype(np.uint16)


def second_of(cubes: np.ndarray) -> np.ndarray:
    """The second brightest, equal values counting each."""
    return np.partition(cubes, 6, axis=-1)[..., 6]


def nth_nonzero_of(cubes: np.ndarray, n: int = 5) -> np.ndarray:
    """The n-th brightest that isn't 0, or the dimmest such if there are fewer, or 0."""
    ordered = np.sort(cubes, axis=-1)
    dimmest = np.take_along_axis(ordered, np.minimum((ordered == 0).sum(-1), 7)[..., None], -1)[..., 0]
    return np.maximum(ordered[..., 8 - n], dimmest)


#: What makes one voxel of the (..., 8) values of a cube; users add their own.
REDUCERS: dict[str, Callable[[np.ndarray], np.ndarray]] = {"first": lambda cubes: cubes[..., 0], "mean": mean_of, "second": second_of, "nth_nonzero": nth_nonzero_of}


def halved(bricks: DataFrame, how: str | Callable[[np.ndarray], np.ndarray], by: tuple[str, ...] = ("c",), node: tuple[str, tuple[int, int, int]] | None = None) -> DataFrame:
    """Partial bricks of the level above. how: a key of REDUCERS or such a function.

    Places are global to the level as a rule. node: the column (of ``by``) with a node's path of octree digits, and a node's side in
    voxels; then places are those in the node, and a child's octant follows from the last digit of its path. Sides are even, so a cube is in one brick.
    """
    reducer = REDUCERS[how] if isinstance(how, str) else how
    text, schema = _kinds(bricks, by)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Table(schema)
        for whole in batches:
            for s in range(0, whole.num_rows, BRICKS_AT_ONCE):
                b = whole.slice(s, BRICKS_AT_ONCE)
                owner, owners = owners_of(b, by)
                start = [b.column(p).to_numpy().astype(np.int64) * (SIDE // 2) for p in PLACE]
                if node:
                    k = by.index(node[0])
                    digit = np.array([int(o[k][-1]) - 1 for o in owners])[owner]
                    start = [p + (digit >> a & 1) * (side // 2) for a, (p, side) in enumerate(zip(start, node[1], strict=True))]
                    owners = [(*o[:k], o[k][:-1].rstrip("/"), *o[k + 1 :]) for o in owners]
                small = reducer(_cubes(as_cells(b.column("data"))))
                brick, z, y, x = np.nonzero(small)
                table.add(owner[brick], owners, [start[a][brick] + p for a, p in enumerate((x, y, z))], small[brick, z, y, x])
                if len(table) > HELD:
                    yield table.taken()
        yield table.taken()

    return bricks.select(*by, *PLACE, "data").mapInArrow(run, text)


def pyramid(leaves: DataFrame, depth: int, how: str | Callable[[np.ndarray], np.ndarray], by: tuple[str, ...] = ("c",), node: tuple[str, tuple[int, int, int]] | None = None) -> list[DataFrame]:
    """The bricks of each level, 0 first and the given leaves at ``depth`` last. A level is an eighth of the one below and is checkpointed."""
    out = [leaves]
    for _ in range(depth):
        out.insert(0, merged(halved(out[0], how, by, node), by).checkpoint())
    return out


def at_level(levels: list[DataFrame]) -> DataFrame:
    """All levels as one table with a column ``level``."""
    whole = [b.withColumn("level", F.lit(k)) for k, b in enumerate(levels)]
    found = whole[0]
    for b in whole[1:]:
        found = found.unionByName(b)
    return found
