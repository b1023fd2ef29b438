"""Boxes, octree paths and pixel arithmetic as Column functions; boxes are columns ox oy oz sx sy sz in integer nm."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

AXES = ("x", "y", "z")
BOX = [f"{p}{a}" for p in "os" for a in AXES]

# Octree digits of a face, by projection axis, for quadtree digits 0 to 3.
FACE_DIGITS = {1: "1357", 2: "1256", 3: "1234"}


def col(c: str, side: str = "") -> Column:
    return F.col(f"{side}.{c}" if side else c)


def aabb_hit(a: str, b: str) -> Column:
    """Whether boxes overlap; boxes that only touch do not, and a box without extent hits nothing."""
    hit = F.lit(True)
    for x in AXES:
        end = F.least(col(f"o{x}", a) + col(f"s{x}", a), col(f"o{x}", b) + col(f"s{x}", b))
        hit = hit & (end > F.greatest(col(f"o{x}", a), col(f"o{x}", b)))
    return hit


def aabb_contains_origin(box: str, tile: str) -> Column:
    return F.expr(" AND ".join(f"{tile}.o{x} >= {box}.o{x}" for x in AXES))


def aabb_union_pair(a: str, b: str) -> list[Column]:
    least = {x: F.least(col(f"o{x}", a), col(f"o{x}", b)) for x in AXES}
    most = {x: F.greatest(col(f"o{x}", a) + col(f"s{x}", a), col(f"o{x}", b) + col(f"s{x}", b)) for x in AXES}
    return [least[x].alias(f"o{x}") for x in AXES] + [(most[x] - least[x]).alias(f"s{x}") for x in AXES]


def aabb_union() -> list[Column]:
    """Aggregates: the box around all boxes; nulls over none."""
    return [F.min(f"o{x}").alias(f"o{x}") for x in AXES] + [(F.max(F.col(f"o{x}") + F.col(f"s{x}")) - F.min(f"o{x}")).alias(f"s{x}") for x in AXES]


def aabb_volume(side: str = "") -> Column:
    v = F.lit(1.0)
    for x in AXES:
        v = v * col(f"s{x}", side).cast("double")
    return v


def aabb_set(origin: dict[str, Column], shape: dict[str, Column]) -> list[Column]:
    """A box with the given parts in place of its own; a null part keeps it."""
    new = {f"o{x}": origin.get(x) for x in AXES} | {f"s{x}": shape.get(x) for x in AXES}
    return [(F.coalesce(v, F.col(c)) if v is not None else F.col(c)).alias(c) for c, v in new.items()]


def octant(digit: Column, side: str = "") -> dict[str, Column]:
    """The child box of an octree digit 1..8: the lower half is rounded down."""
    out = {}
    for k, x in enumerate(AXES):
        s, half = col(f"s{x}", side), F.shiftright(col(f"s{x}", side), 1)
        up = F.shiftright(digit - 1, k).bitwiseAND(1)
        out[f"o{x}"] = col(f"o{x}", side) + up * half
        out[f"s{x}"] = half + up * (s % 2)
    return out


def longest_axis() -> Column:
    """0, 1 or 2: the first of the longest sides."""
    return F.when((F.col("sx") >= F.col("sy")) & (F.col("sx") >= F.col("sz")), 0).when(F.col("sy") >= F.col("sz"), 1).otherwise(2)


def halved(upper: Column) -> dict[str, Column]:
    """The lower or upper half of a box along its longest axis; the lower is rounded down."""
    axis, out = longest_axis(), {}
    for k, x in enumerate(AXES):
        s, low = F.col(f"s{x}"), F.floor(F.col(f"s{x}") / 2)
        here = axis == k
        out[f"o{x}"] = F.when(here & upper, F.col(f"o{x}") + low).otherwise(F.col(f"o{x}"))
        out[f"s{x}"] = F.when(here, F.when(upper, s - low).otherwise(low)).otherwise(s)
    return out


def is_leaf(voxel_um: tuple[float, float, float], max_pixels: float, side: str = "") -> Column:
    return aabb_volume(side) / F.lit(math.prod(voxel_um) * 1e9) < F.lit(float(max_pixels))


def nlevels(volume_nm3: Column, voxel_um: tuple[float, float, float], max_pixels: float, deepest: int = 20) -> Column:
    """The least k with 8^k leaves of ``max_pixels`` holding the volume; powers are compared, not logarithms."""
    ratio = volume_nm3 / F.lit(math.prod(voxel_um) * 1e9) / F.lit(float(max_pixels))
    level = F.lit(deepest)
    for k in reversed(range(deepest)):
        level = F.when(ratio <= float(8**k), k).otherwise(level)
    return level


def roi_box(f0: tuple[float, ...], f1: tuple[float, ...]) -> list[Column]:
    """The region of interest as fractions of a box, rounded to even."""
    return [F.rint(F.col(f"o{x}") + F.col(f"s{x}") * f).cast("long").alias(f"o{x}") for x, f in zip(AXES, f0, strict=True)] + [
        F.rint(F.col(f"s{x}") * f).cast("long").alias(f"s{x}") for x, f in zip(AXES, f1, strict=True)
    ]


def fraction_of_path(path: Column, axis: int) -> Column:
    """Origin of a path of digits 1..8 as a fraction of the root's side."""
    return F.aggregate(
        F.transform(F.split(path, "/"), lambda d, i: F.shiftright(d.cast("int") - 1, axis).bitwiseAND(1) / F.pow(F.lit(2.0), i + 1)),
        F.lit(0.0),
        lambda s, v: s + v,
    )


def cell_of_path(digits: Column, axis: int) -> Column:
    """Integer coordinate of a string of octree digits, first digit most significant."""
    return F.aggregate(F.filter(F.split(digits, ""), lambda d: d != ""), F.lit(0), lambda s, d: s * 2 + F.shiftright(d.cast("int") - 1, axis).bitwiseAND(1))


def face_path(index: Column, levels: int, axis: int) -> Column:
    return F.translate(F.lpad(F.conv(index.cast("string"), 10, 4), levels, "0"), "0123", FACE_DIGITS[axis])


def quadtree_path(face: Column, axis: int) -> Column:
    """A face path's octree digits as quadtree digits 1..4."""
    return F.translate(face, FACE_DIGITS[axis], "1234")


def stack_path(face: Column, depth: Column, levels: int, axis: int) -> Column:
    """The octree path of the ``depth``-th leaf behind a face: one bit per level, the first most significant."""
    step = 2 ** (axis - 1)
    return F.concat(*[(F.substring(face, k + 1, 1).cast("int") + F.shiftright(depth, levels - 1 - k).bitwiseAND(1) * step).cast("string") for k in range(levels)])


def crop_pixels(crop_um: Column, origin_nm: Column, voxel_um: Column, skipped: Column, leaf_px: int, leaves: Column, lower: bool) -> Column:
    """A crop bound as a pixel of the stack, 1 to its length; a null bound is open."""
    px = F.rint((crop_um - origin_nm / 1000) / voxel_um).cast("long") - skipped * leaf_px
    return F.when(crop_um.isNull(), F.lit(1) if lower else leaves * leaf_px).otherwise(F.greatest(F.lit(1), px) if lower else F.least(leaves * leaf_px, px)).cast("long")


def scale_clamp(v: Column, black: float, white: float) -> Column:
    """0 to 65535 between the black and white levels."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), (v - black) / (white - black))) * 65535.0


def to_u16(v: Column) -> Column:
    """Clamped, then rounded to even."""
    return F.rint(F.greatest(F.lit(0.0), F.least(F.lit(65535.0), v))).cast("int")


def octal_digits(job: Column) -> list[Column]:
    """A job number from 1 as three octree digits."""
    return [(F.shiftright(job - 1, shift).bitwiseAND(7) + 1).alias(f"d{k}") for k, shift in enumerate((6, 3, 0))]


def morton(*cells: Column, bits: int) -> Column:
    """Interleaved bits, x lowest."""
    out = F.lit(0).cast("long")
    for b in range(bits):
        for k, c in enumerate(cells):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c.cast("long"), b).bitwiseAND(1), 3 * b + k))
    return out


def morton_axis(m: Column, axis: int, bits: int) -> Column:
    out = F.lit(0).cast("long")
    for b in range(bits):
        out = out.bitwiseOR(F.shiftleft(F.shiftright(m.cast("long"), 3 * b + axis).bitwiseAND(1), b))
    return out


def human_readable(kb: Column) -> Column:
    """KB with a unit, digits cut off as text."""
    s = kb.cast("string")
    n = F.length(s)
    cut = lambda k, unit: F.concat(F.substring(s, F.lit(1), n - k), F.lit(unit))
    return F.when(n > 9, cut(9, "T")).when(n > 6, cut(6, "G")).when(n > 3, cut(3, "M")).otherwise(F.concat(s, F.lit("B")))
