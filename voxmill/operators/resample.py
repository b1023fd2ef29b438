"""Barycentric resampling of sub-tiles into output leaves by scan conversion, in numpy over many pairs at once.

A sub-tile's eight corners span five tetrahedra. In each, the four barycentric shares of a point are linear along a row
of pixels, so the row's pixels inside are one run, whose ends follow from four plane equations; no other pixel is looked at. Along a run the
position in the sub-tile is linear as well. A pixel is sampled at its corner of least coordinates; where that lies between voxels, nearest takes the brightest of them. Rows and runs are worked on in bounded pieces, and what they give is written
into bricks, so memory depends neither on a leaf's size nor on a sub-tile's.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from voxmill.functions.geometry import BOX
from voxmill.operators import bricks

#: Pairs, rows of pixels, and pixels that are worked on at once.
PAIRS, ROWS, PIXELS = 1024, 1 << 16, 1 << 18

# The five tetrahedra of a cube (corner = x + 2 y + 4 z), for the two orientations.
TETRAHEDRA = {0: ((0, 3, 5, 6), (1, 0, 3, 5), (2, 0, 3, 6), (4, 0, 5, 6), (7, 3, 5, 6)), 90: ((1, 2, 4, 7), (0, 1, 2, 4), (3, 1, 2, 7), (5, 1, 4, 7), (6, 2, 4, 7))}
CORNERS = np.array([[b & 1, b >> 1 & 1, b >> 2 & 1] for b in range(8)], float)
_BY_TURN = np.array([TETRAHEDRA[0], TETRAHEDRA[90]])


def _counted(n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(owner, number within it) of n[i] things for each owner i."""
    owner = np.repeat(np.arange(len(n)), n)
    return owner, np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)


def _pieces(n: np.ndarray, most: int) -> Iterator[slice]:
    """Slices of things whose sizes n add up to about ``most``, or single larger ones."""
    ends = np.cumsum(n)
    at = 0
    while at < len(n):
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, "right")))
        yield slice(at, stop)
        at = stop


class Tetrahedra:
    """The tetrahedra of many sub-tiles, each with its planes and its linear map to the unit cube, in pixels of a leaf."""

    def __init__(self, corners: np.ndarray, turned: np.ndarray, pixels: tuple[int, int, int]):
        ids = _BY_TURN[turned.astype(int)]
        p = np.take_along_axis(corners[:, None], ids[..., None], 2).reshape(-1, 4, 3)
        self.pair = np.repeat(np.arange(len(corners)), 5)
        edges = (p[:, 1:] - p[:, :1]).transpose(0, 2, 1)
        self.low = np.maximum(np.floor(p.min(1) - 0.01).astype(np.int64), 0)
        self.high = np.minimum(np.floor(p.max(1) + 0.01).astype(np.int64) + 1, pixels)
        keep = (np.abs(np.linalg.det(edges)) >= 1e-12) & (self.low < self.high).all(1)
        p, ids, self.pair, self.low, self.high = p[keep], ids.reshape(-1, 4)[keep], self.pair[keep], self.low[keep], self.high[keep]
        tail = np.linalg.inv(edges[keep])
        grad = np.concatenate([-tail.sum(1, keepdims=True), tail], 1)
        #: share k at a point q is grad[k] . q + base[k]; the position there is unit . q + origin
        self.grad, self.base = grad, -np.einsum("tki,ti->tk", grad, p[:, 0]) + np.array([1.0, 0, 0, 0])
        bits = CORNERS[ids]
        self.unit, self.origin = np.einsum("tkj,tki->tji", bits, grad), np.einsum("tkj,tk->tj", bits, self.base)

    def runs(self, eps: float) -> Iterator[tuple[np.ndarray, ...]]:
        """(tetrahedron, y, z, first x, number of x) of the rows that a tetrahedron covers: pair by pair, and in each by slabs of a brick's height."""
        size = self.high - self.low
        last_pair = np.searchsorted(self.pair, np.unique(self.pair), "right")
        for part in _pieces(np.diff(np.append(0, np.cumsum(size[:, 2])[last_pair - 1])), ROWS):  # the planes of some pairs
            lo, hi = (last_pair[part.start - 1] if part.start else 0), last_pair[part.stop - 1]
            tet, z = _counted(size[lo:hi, 2])
            tet += lo
            z += self.low[tet, 2]
            order = np.lexsort((tet, z // bricks.SIDE, self.pair[tet]))
            tet, z = tet[order], z[order]
            for some in _pieces(size[tet, 1], ROWS):
                row, y = _counted(size[tet[some], 1])
                t, zs = tet[some][row], z[some][row]
                y = y + self.low[t, 1]
                at = np.stack([np.zeros(len(y)), y, zs], 1)
                rest = np.einsum("rki,ri->rk", self.grad[t], at) + self.base[t] + eps
                slope = self.grad[t][..., 0]
                steep = np.abs(slope) > 1e-14
                with np.errstate(divide="ignore", invalid="ignore"):
                    edge = -rest / slope
                first = np.where(steep & (slope > 0), edge, -np.inf).max(1)
                last = np.where(steep & (slope < 0), edge, np.inf).min(1)
                lo = np.ceil(np.maximum(first, self.low[t, 0])).astype(np.int64)
                hi = np.floor(np.minimum(last, self.high[t, 0] - 1)).astype(np.int64)
                ok = (hi >= lo) & (steep | (rest >= 0)).all(1)
                yield t[ok], y[ok], zs[ok], lo[ok], (hi - lo + 1)[ok]


def sampled(data: np.ndarray, start: np.ndarray, shape: np.ndarray, t: np.ndarray, mode: str) -> np.ndarray:
    """Values at unit positions t of blocks of ``shape`` (x, y, z) that start there in ``data``, x fastest: nearest (the brightest of those as near) or linear."""
    place = lambda i: start + (i[:, 2] * shape[:, 1] + i[:, 1]) * shape[:, 0] + i[:, 0]
    if mode == "nearest":
        low, high = np.maximum(np.ceil(t * shape - 1e-9) - 1, 0).astype(np.int64), np.minimum(np.floor(t * shape + 1e-9).astype(np.int64), shape - 1)
        out = data[place(low)].astype(float)
        tied = np.flatnonzero((low < high).any(1))
        low, high, start, shape = low[tied], high[tied], start[tied], shape[tied]
        for b in CORNERS[1:].astype(bool) if len(tied) else ():
            out[tied] = np.maximum(out[tied], data[place(np.where(b, high, low))])
        return out
    at = np.clip(t * shape - 0.5, 0, shape - 1)
    low = np.minimum(np.floor(at), np.maximum(shape - 2, 0)).astype(np.int64)
    share, out = at - low, np.zeros(len(t))
    for b in CORNERS.astype(np.int64):
        weight = np.where(b == 1, share, 1 - share).prod(axis=1)
        out += weight * data[place(np.minimum(low + b, shape - 1))]
    return out


def covered(corners: np.ndarray, turned: np.ndarray, data: np.ndarray, start: np.ndarray, shape: np.ndarray, pixels: tuple[int, int, int], mode: str, eps: float = 1e-6) -> Iterator[tuple]:
    """(pair, [x, y, z], value) of the pixels that sub-tiles cover, in bounded pieces; a pixel on a face of two tetrahedra comes twice.

    corners: (n, 8, 3) in pixels of the leaf; turned: whether the other five tetrahedra are taken. Halves are rounded up, whatever the last bits of their sums.
    """
    tets = Tetrahedra(corners, turned, pixels)
    for t, y, z, x, n in tets.runs(eps):
        fixed = np.einsum("rji,ri->rj", tets.unit[t], np.stack([x, y, z], 1)) + tets.origin[t]
        for part in _pieces(n, PIXELS):
            run, step = _counted(n[part])
            run += part.start
            at = np.clip(fixed[run] + tets.unit[t[run], :, 0] * step[:, None], 0, 1)
            pair = tets.pair[t[run]]
            yield pair, [x[run] + step, y[run], z[run]], np.floor(sampled(data, start[pair], shape[pair], at, mode) + 0.5 + 1e-6).astype(np.uint16)


def resample(pairs: DataFrame, mode: str = "nearest", pixels: tuple[int, int, int] = (8, 8, 8), keep: tuple[str, ...] = ("path",)) -> DataFrame:
    """(keep, i, j, k, data) of pairs(keep, box, corners as 24 longs, orientation, block bytes, nx, ny, nz): partial bricks of a leaf
    of such pixels with what the sub-tile covers. Pairs overlap, so ``bricks.merged`` follows; those of one leaf in a task are combined here. The
    bricks of a leaf with a single pair come once each, as a slab of them stays until the next begins."""
    if mode not in ("nearest", "linear"):
        raise ValueError(f"no such interpolation: {mode}")
    text, schema = bricks._kinds(pairs, keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bricks.Table(schema)
        for whole in batches:
            for s in range(0, whole.num_rows, PAIRS):
                b = whole.slice(s, PAIRS)
                number = lambda c: b.column(c).to_numpy(zero_copy_only=False)  # noqa: B023, E731
                box = np.stack([number(c) for c in BOX], 1).astype(float)
                corners = b.column("corners").flatten().to_numpy().reshape(-1, 8, 3).astype(float)
                corners = (corners - box[:, None, :3]) / (box[:, None, 3:] / np.array(pixels))
                cells = [np.frombuffer(c.as_buffer(), "<u2") for c in b.column("block")]
                ends = np.cumsum([len(c) for c in cells])
                owner, owners = bricks.owners_of(b, keep)
                shape = np.stack([number(c) for c in ("nx", "ny", "nz")], 1).astype(np.int64)
                for pair, at, v in covered(corners, number("orientation") == 90, np.concatenate(cells), np.append(0, ends[:-1]), shape, pixels, mode):
                    some = v > 0
                    table.add(owner[pair[some]], owners, [a[some] for a in at], v[some])
                    if len(table) > bricks.HELD:
                        yield table.taken((*owners[owner[pair[-1]]], int(at[2][-1]) // bricks.SIDE))
        yield table.taken()

    return pairs.select(*keep, *BOX, "corners", "orientation", "block", "nx", "ny", "nz").mapInArrow(run, text)
