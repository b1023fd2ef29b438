"""Tiles in a space-filling order, and region scans that read few row groups of them.

A tile's code is the Morton code of the cell its origin lies in, of a grid of 2^bits cells a side over the whole volume. The
table is range-partitioned and sorted by it, so near tiles share row groups, whose least and greatest code Parquet keeps. A box is cut into
few ranges of codes: octree cells that lie inside whole, and at the budget's end some that only overlap. These go
down to the scan as a filter; the box itself is then tested exactly.
"""

from __future__ import annotations

import heapq
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.functions.geometry import AXES, BOX, morton
from voxmill.operators import spatial

BITS = 16


def cell(axis: str, low: int, size: int, bits: int = BITS) -> Column:
    """The number of the grid cell that a tile's origin lies in; those outside of the volume belong to its edge."""
    at = F.floor((F.col(f"o{axis}") - low).cast("decimal(38,0)") * 2**bits / size).cast("long")
    return F.least(F.greatest(at, F.lit(0)), F.lit(2**bits - 1))


def coded(tiles: DataFrame, origin: tuple[int, ...], shape: tuple[int, ...], bits: int = BITS) -> DataFrame:
    cells = [cell(a, o, s, bits) for a, o, s in zip(AXES, origin, shape, strict=True)]
    return tiles.withColumn("code", morton(*cells, bits=bits))


def write_ordered(tiles: DataFrame, folder: str, origin: tuple[int, ...], shape: tuple[int, ...], files: int, group_bytes: int = 8 << 20, bits: int = BITS) -> None:
    """Write tiles(box, ...) of a volume in order of their codes, in so many files of row groups of about that size."""
    ordered = coded(tiles, origin, shape, bits).repartitionByRange(files, "code", "id").sortWithinPartitions("code", "id")
    ordered.write.mode("overwrite").option("parquet.block.size", group_bytes).parquet(folder)


def code_ranges(low: tuple[int, ...], high: tuple[int, ...], most: int = 32, bits: int = BITS) -> list[tuple[int, int]]:
    """At most ``most`` ranges of codes, both ends in, that hold all cells from ``low`` to ``high``, both in.

    The largest octree cell that lies partly outside is cut next, as long as the ranges are few enough.
    """
    whole: list[tuple[int, int]] = []
    partly = [(-bits, 0, (0, 0, 0))]  # (-level above the cells, first code, first cell)
    while partly:
        up, code, at = heapq.heappop(partly)
        side = 1 << -up
        if any(a > h or a + side <= lo for a, lo, h in zip(at, low, high, strict=True)):
            continue
        inside = all(a >= lo and a + side - 1 <= h for a, lo, h in zip(at, low, high, strict=True))
        if inside or len(whole) + len(partly) + 8 > most:
            whole.append((code, code + (1 << -3 * up) - 1))
            continue
        for d in range(8):
            half = side >> 1
            heapq.heappush(partly, (up + 1, code + d * half**3, tuple(a + (d >> k & 1) * half for k, a in enumerate(at))))
    joined: list[tuple[int, int]] = []
    for first, last in sorted(whole):
        if joined and joined[-1][1] + 1 == first:
            joined[-1] = (joined[-1][0], last)
        else:
            joined.append((first, last))
    return joined


def scan(spark: SparkSession, folder: str, origin: tuple[int, ...], shape: tuple[int, ...], box: tuple[int, ...], most: int = 32, bits: int = BITS) -> DataFrame:
    """The tiles of such a table that begin in a box (origin and shape, half open) and hit it."""
    cells = [[min(max((at - o) * 2**bits // s, 0), 2**bits - 1) for at, o, s in zip(ends, origin, shape, strict=True)] for ends in (box[:3], [o + s - 1 for o, s in zip(box[:3], box[3:], strict=True)])]
    ranges = code_ranges(*map(tuple, cells), most, bits) if min(box[3:]) > 0 else []
    pushed = reduce(Column.__or__, [F.col("code").between(*r) for r in ranges], F.lit(False))
    one = spark.createDataFrame([tuple(box)], ", ".join(f"{c} long" for c in BOX))
    return spatial.in_box(spark.read.parquet(folder).where(pushed), one).drop("code")
