"""Projection of a volume along an axis: channel arithmetic, crop, reduction, mosaic, blur."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxmill.config import ProjectionConfig
from voxmill.functions.geometry import cell_of_path, scale_clamp, to_u16
from voxmill.operators import bricks


def channel_difference(voxels: DataFrame, signal: int, reference: int, signal_levels: tuple[float, float], reference_levels: tuple[float, float]) -> DataFrame:
    """(x, y, z, d): the scaled signal less the scaled reference; one shuffle, by conditional aggregates instead of a join."""
    v = lambda c: F.coalesce(F.max(F.when(F.col("c") == c, F.col("v"))), F.lit(0))
    paired = voxels.where(F.col("c").isin(signal, reference)).groupBy("x", "y", "z").agg(v(signal).alias("s"), v(reference).alias("r"))
    return paired.select("x", "y", "z", (scale_clamp(F.col("s"), *signal_levels) - scale_clamp(F.col("r"), *reference_levels)).alias("d"))


def project(rows: DataFrame, crop: tuple[int, int], reducer: Column) -> DataFrame:
    """(x, y, p) of rows(x, y, z, d) with z in the crop, both ends in."""
    return rows.where(F.col("z").between(*crop)).groupBy("x", "y").agg(reducer.alias("p"))


def second_brightest_of(rows: DataFrame, crop: tuple[int, int]) -> DataFrame:
    """(x, y, p) with the second brightest: each line of voxels is ranked, so no list is built."""
    rank = F.row_number().over(Window.partitionBy("x", "y").orderBy(F.desc("d")))
    top = rows.where(F.col("z").between(*crop)).withColumn("k", rank).where("k <= 2")
    return top.groupBy("x", "y").agg(F.greatest(F.lit(0.0), F.coalesce(F.max(F.when(F.col("k") == 2, F.col("d"))), F.lit(0.0))).alias("p"))


def running_median(rows: DataFrame, depth: int, reach: int = 2) -> DataFrame:
    """(x, y, z, d): the median of 2 x reach + 1 along z, edges replicated; absent voxels are 0.

    Window functions over each line look ahead and back, so a line is one shuffle and no voxel is copied.
    """
    dense = rows.select("x", "y").distinct().select("x", "y", F.explode(F.sequence(F.lit(0), F.lit(depth - 1))).alias("z"))
    full = dense.join(rows, ["x", "y", "z"], "left").select("x", "y", "z", F.coalesce("d", F.lit(0.0)).alias("d"))
    line = Window.partitionBy("x", "y").orderBy("z")
    seen = [F.when(F.col("z") + k < 0, F.first("d").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            .when(F.col("z") + k > depth - 1, F.last("d").over(line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
            .otherwise(F.lead("d", k).over(line) if k >= 0 else F.lag("d", -k).over(line)) for k in range(-reach, reach + 1)]
    return full.select("x", "y", "z", F.get(F.sort_array(F.array(*seen)), F.lit(reach)).alias("d"))


def as_pixels(projected: DataFrame) -> DataFrame:
    return projected.select("x", "y", to_u16(F.col("p")).alias("p"))


def _scaled(v: np.ndarray, levels: tuple[float, float]) -> np.ndarray:
    return np.float32(65535) * np.clip((v.astype(np.float32) - np.float32(levels[0])) / np.float32(levels[1] - levels[0]), 0, 1)


def _median_max(d: np.ndarray, crop: slice, reach: int = 2) -> np.ndarray:
    wide = np.pad(d, ((0, 0), (reach, reach)), "edge")
    return np.median(np.lib.stride_tricks.sliding_window_view(wide, 2 * reach + 1, 1), axis=-1)[:, crop].max(1)


def _second(d: np.ndarray, crop: slice) -> np.ndarray:
    cut = np.concatenate([d[:, crop], np.zeros((len(d), 2), d.dtype)], 1)
    return np.partition(cut, -2, axis=1)[:, -2]


#: What makes one pixel of each line of (lines, depth) differences and the crop along it; users add their own.
PROJECTIONS: dict[str, Callable[[np.ndarray, slice], np.ndarray]] = {
    "max": lambda d, crop: d[:, crop].max(1),
    "p999": lambda d, crop: np.quantile(d[:, crop].astype(float), 0.999, axis=1),
    "median_max": _median_max,
    "second": _second,
}
#: How far beyond the crop each of these looks along a line; of others, users' own among them, that isn't known and they get whole lines.
REACH = {"max": 0, "p999": 0, "median_max": 2, "second": 0}
#: Values of lines that are reduced at once.
VALUES = 1 << 21
#: For each axis, how a brick's (z, y, x) cells become (u, v, depth).
_TURN = {1: (1, 0, 2), 2: (2, 0, 1), 3: (2, 1, 0)}


def stacked(there: DataFrame, axis: int, nlevels: int, crop_um: tuple[float, float], origin_um: float, voxel_um: float, side: int) -> DataFrame:
    """(path, u, v, nth, low, high) of the leaves there(path) that are behind one another along an axis.

    u and v are the leaf's place across the axis; nth its place among those that are there, as leaves that are missing close up; low and high the first and last
    pixel of the whole stack in the crop, from 1. The crop is counted from the volume's origin, less the leaves that are missing before the first.
    """
    digits = F.replace("path", F.lit("/"), F.lit(""))
    across = [i for i in range(3) if i != axis - 1]
    rows = there.select("path", *[cell_of_path(digits, i).alias(name) for i, name in ((across[0], "u"), (across[1], "v"), (axis - 1, "at"))])
    face = Window.partitionBy("u", "v")
    gap, n = F.min("at").over(face), F.count("*").over(face)
    nth = F.row_number().over(face.orderBy("at")) - 1
    pixel = lambda um: F.lit(round((um - origin_um) / voxel_um)) - gap * side
    low = F.lit(1) if crop_um[0] == float("-inf") else F.greatest(F.lit(1), pixel(crop_um[0]))
    high = n * side if crop_um[1] == float("inf") else F.least(n * side, pixel(crop_um[1]))
    found = rows.select("path", "u", "v", nth.alias("nth"), n.alias("n"), low.cast("int").alias("low"), high.cast("int").alias("high"))
    return found.where("low <= high")


def project_bricks(leaves: DataFrame, stack: DataFrame, config: ProjectionConfig, leaf_px: tuple[int, int, int]) -> DataFrame:
    """Image bricks (i, j, k, data) of leaves(path, c, i, j, k, data), one brick a key, as ``stacked`` has them.

    Bricks that lie behind one another meet in one task, which holds the lines of one brick's face: 256 of the crop's depth, or of the stack's
    for functions that aren't in ``REACH``. Bricks outside that aren't sent there. Dark lines stay dark.
    """
    reduce_ = PROJECTIONS[config.function] if isinstance(config.function, str) else config.function
    reach = REACH.get(config.function) if isinstance(config.function, str) else None
    axis, depth_px = config.axis, leaf_px[config.axis - 1]
    if min(config.signal_levels[0], config.reference_levels[0]) < 0:
        raise ValueError("a black level under 0 makes dark lines bright")
    across = [i for i in range(3) if i != axis - 1]
    du, dv, dd = (bricks.PLACE[i] for i in (*across, axis - 1))
    used = leaves.where(F.col("c").isin(config.signal_channel, config.reference_channel)).join(stack, "path")
    if reach is not None:
        begin = F.col("nth") * depth_px + F.col(dd) * bricks.SIDE
        used = used.where((begin < F.col("high") + reach) & (F.least(begin + bricks.SIDE, (F.col("nth") + 1) * depth_px) > F.col("low") - 1 - reach))
    columns = ["u", "v", "n", "low", "high", "c", "nth", F.col(du).alias("bu"), F.col(dv).alias("bv"), F.col(dd).alias("bd"), "data"]
    key = ["u", "v", "bu", "bv"]
    schema = pa.schema([*((p, pa.int32()) for p in bricks.PLACE), ("data", pa.binary())])
    side = bricks.SIDE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, now, start, lines = bricks.Table(schema, bricks.IMAGE), None, 0, np.zeros((2, 0, 0), np.uint16)

        def done() -> None:
            u, v, bu, bv, _, low, high = now
            step = max(1, VALUES // lines.shape[2])
            pieces = (_scaled(signal, config.signal_levels) - _scaled(reference, config.reference_levels) for signal, reference in (lines[:, s : s + step] for s in range(0, side * side, step)))
            p = np.concatenate([reduce_(difference, slice(low - 1 - start, high - start)) for difference in pieces])
            p = np.rint(np.clip(p, 0, 65535)).astype(np.uint16).reshape(side, side)
            p = p[: leaf_px[across[0]] - bu * side, : leaf_px[across[1]] - bv * side]
            x, y = np.nonzero(p)
            at = [u * leaf_px[across[0]] + bu * side + x, v * leaf_px[across[1]] + bv * side + y, np.zeros(len(x), np.int64)]
            table.add(np.zeros(len(x), np.int64), [()], at, p[x, y])

        for b in batches:
            cells = bricks.as_cells(b.column("data")).reshape(-1, side, side, side)
            for n, (*own, c, nth, bd) in enumerate(zip(*(b.column(x).to_pylist() for x in [*key, "n", "low", "high", "c", "nth", "bd"]), strict=True)):
                if own != now:
                    if now:
                        done()
                        if len(table) > bricks.HELD:
                            yield table.taken()
                    now, (_, low, high) = own, own[4:]
                    start, stop = (0, own[4] * depth_px) if reach is None else (max(0, low - 1 - reach), min(own[4] * depth_px, high + reach))
                    lines = np.zeros((2, side * side, stop - start), np.uint16)
                first, size = nth * depth_px + bd * side, min(side, depth_px - bd * side)
                skip, end = max(start - first, 0), min(size, stop - first)
                block = cells[n].transpose(_TURN[axis]).reshape(side * side, side)[:, skip:end]
                for k, channel in enumerate((config.signal_channel, config.reference_channel)):
                    if c == channel:
                        lines[k][:, first + skip - start : first + end - start] = block
        if now:
            done()
        yield table.taken()

    parts = used.select(*columns).repartition(*key).sortWithinPartitions(*key).mapInArrow(run, "i int, j int, k int, data binary")
    return bricks.merged(parts, ())


class Taps:
    """The weights of one axis: a Gaussian blur of 0.75 x ratio, renormalised at the edges, then a linear resample of n cells to m."""

    def __init__(self, n: int, m: int):
        self.n, self.m, self.ratio = n, m, n / m
        self.sigma = 0.75 * self.ratio
        self.reach = int(4 * self.sigma + 0.5)
        self.bell = np.exp(-np.square(np.arange(-self.reach, self.reach + 1) / self.sigma) / 2)
        self.sums = np.append(0, np.cumsum(self.bell))

    def of(self, start: int, size: int) -> tuple[int, np.ndarray]:
        """(first target, weights[target, cell]) of all targets that read one of the cells from ``start``."""
        low = max(0, int(np.floor((start - self.reach - 1) / self.ratio)) - 1)
        high = min(self.m, int(np.ceil((start + size + self.reach + 1) / self.ratio)) + 1)
        at = np.clip((np.arange(low, high) + 0.5) * self.ratio - 0.5, 0, self.n - 1)
        cells, out = np.arange(start, min(start + size, self.n)), np.zeros((high - low, size))
        for i, share in ((np.floor(at).astype(int), 1 - (at - np.floor(at))), (np.minimum(np.floor(at).astype(int) + 1, self.n - 1), at - np.floor(at))):
            whole = self.sums[np.minimum(self.n - 1 - i, self.reach) + self.reach + 1] - self.sums[np.maximum(-i, -self.reach) + self.reach]
            off = cells[None] - i[:, None]
            near = np.abs(off) <= self.reach
            out[:, : len(cells)] += np.where(near, self.bell[np.clip(off, -self.reach, self.reach) + self.reach], 0) * (share / whole)[:, None]
        used = np.flatnonzero(out.any(1))
        return (low + used[0], out[used[0] : used[-1] + 1]) if len(used) else (low, out[:0])


def resized(image: DataFrame, width: int, height: int, new_width: int, new_height: int) -> DataFrame:
    """Image bricks (i, j, k, data) of image bricks, one a key, blurred and resized.

    Both axes are weighted at once inside a brick: it gives partial sums for the new pixels that read it, some
    64 / ratio + 6 on a side whatever the blur's width. They are summed in a bounded table in each task and then once a new brick.
    """
    w, h, _ = bricks.IMAGE

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        xs, ys, held = Taps(width, new_width), Taps(height, new_height), {}

        def sent() -> pa.RecordBatch:
            rows = []
            for (i, j), block in held.items():
                y, x = (np.flatnonzero(block.any(a)) for a in (1, 0))
                if len(y):
                    cut = block[y[0] : y[-1] + 1, x[0] : x[-1] + 1]
                    rows.append((i, j, int(x[0]), int(y[0]), cut.shape[1], cut.astype("<f8").tobytes()))
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], pa.int32() if n < 5 else pa.binary()) for n in range(6)], ["i", "j", "x", "y", "w", "sums"])

        for b in batches:
            cells = bricks.as_cells(b.column("data")).reshape(-1, h, w)
            for n, (i, j) in enumerate(zip(b.column("i").to_pylist(), b.column("j").to_pylist(), strict=True)):
                (x0, wx), (y0, wy) = xs.of(i * w, w), ys.of(j * h, h)
                sums = wy @ cells[n].astype(float) @ wx.T
                for oi in range(x0 // w, (x0 + len(wx) - 1) // w + 1):
                    for oj in range(y0 // h, (y0 + len(wy) - 1) // h + 1):
                        lx, hx, ly, hy = max(x0, oi * w), min(x0 + len(wx), (oi + 1) * w), max(y0, oj * h), min(y0 + len(wy), (oj + 1) * h)
                        block = held.setdefault((oi, oj), np.zeros((h, w)))
                        block[ly - oj * h : hy - oj * h, lx - oi * w : hx - oi * w] += sums[ly - y0 : hy - y0, lx - x0 : hx - x0]
                if len(held) > 512:
                    yield sent()
        yield sent()

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, np.zeros((h, w))

        def sent() -> pa.RecordBatch:
            cells = np.rint(np.clip(block, 0, 65535)).astype(np.uint16).reshape(1, -1)
            return pa.RecordBatch.from_arrays([*(pa.array([v], pa.int32()) for v in (*now, 0)), bricks.as_binary(cells)], [*bricks.PLACE, "data"])

        for b in batches:
            for *own, x, y, n, cell in zip(*(b.column(c).to_pylist() for c in ("i", "j", "x", "y", "w")), b.column("sums"), strict=True):
                if own != now:
                    if now:
                        yield sent()
                    now, block = own, np.zeros((h, w))
                part = np.frombuffer(cell.as_buffer(), "<f8").reshape(-1, n)
                block[y : y + len(part), x : x + n] += part
        if now:
            yield sent()

    parts = image.select("i", "j", "data").mapInArrow(partial, "i int, j int, x int, y int, w int, sums binary")
    return parts.repartition("i", "j").sortWithinPartitions("i", "j").mapInArrow(summed, "i int, j int, k int, data binary")


def image_bricks(pixels: DataFrame) -> DataFrame:
    """Image bricks of pixels(x, y, p) whose values fit 16 bits."""
    return bricks.merged(bricks.pack(pixels.select("x", "y", F.lit(0).alias("z"), F.col("p").alias("v")), (), bricks.IMAGE), ())


def pixels_of(image: DataFrame) -> DataFrame:
    """(x, y, p) of the pixels over 0."""
    return bricks.unpack(image, (), bricks.IMAGE).select("x", "y", F.col("v").alias("p"))
