"""Merging of partial tiles and the pyramid above them, on sparse voxels; an absent voxel is 0."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AT = ["c", "x", "y", "z"]


def max_merge(*sources: DataFrame) -> DataFrame:
    """The greatest value of each voxel over all partial tiles; combined on the map side first."""
    return reduce(DataFrame.unionByName, [s.select(*AT, "v") for s in sources]).groupBy(*AT).agg(F.max("v").alias("v"))


def _down(c: str) -> Column:
    return F.shiftright(c, 1).alias(c)


def downsample_first(voxels: DataFrame) -> DataFrame:
    """The first voxel of each 2 x 2 x 2 cube: a filter, without a shuffle. Cubes whose first voxel is absent are absent."""
    return voxels.where("x % 2 = 0 AND y % 2 = 0 AND z % 2 = 0").select("c", *[_down(a) for a in "xyz"], "v")


def mean_of_cube() -> Column:
    return F.shiftright(F.sum(F.col("v").cast("long")), 3).cast("int")


def _brightest() -> Column:
    # at most eight voxels a cube
    return F.sort_array(F.collect_list("v"), asc=False)


def second_of_cube() -> Column:
    """The second brightest, equal values counting each; 0 with fewer than two."""
    return F.coalesce(F.get(_brightest(), F.lit(1)), F.lit(0))


def nth_nonzero_of_cube(n: int = 5) -> Column:
    """The n-th brightest that isn't 0, or the dimmest such if there are fewer, or 0."""
    lit = F.filter(_brightest(), lambda v: v > 0)
    return F.coalesce(F.get(lit, F.least(F.lit(n), F.size(lit)) - 1), F.lit(0))


REDUCERS = {"mean": mean_of_cube, "second": second_of_cube, "nth_nonzero": nth_nonzero_of_cube}


def downsample(voxels: DataFrame, how: str | Column) -> DataFrame:
    """One level up. how: ``first``, a key of REDUCERS, or an aggregate Column over ``v`` (a user's own, a pandas UDF too)."""
    if isinstance(how, str) and how == "first":
        return downsample_first(voxels)
    reducer = REDUCERS[how]() if isinstance(how, str) else how
    return voxels.groupBy("c", *[_down(a) for a in "xyz"]).agg(reducer.alias("v"))


def pyramid(leaves: DataFrame, depth: int, how: str | Column, existing: DataFrame | None = None) -> DataFrame:
    """(level, c, x, y, z, v) of all levels, leaves at ``depth``, in coordinates global to their level.

    existing(level, node size as ``side``, nx, ny, nz with voxels level, c, x, y, z, v): nodes that already have an image keep it, and nothing is
    computed there: what lies below them is left out before the aggregate. Each level is checkpointed, so the next costs one shuffle of an eighth of it.
    """
    level = leaves.select(*AT, "v")
    out = [level.withColumn("level", F.lit(depth))]
    for k in reversed(range(depth)):
        own = existing.where(F.col("level") == k) if existing is not None else None
        if own is not None:
            cells = own.select("c", "nx", "ny", "nz", "side").distinct()
            # nodes of a level have one side as a rule, so the join is by equal keys, one for each side
            for side in [r.side for r in cells.select("side").distinct().collect()]:
                at = [F.floor(level[a] / (2 * side)) == cells[f"n{a}"] for a in "xyz"] + [level["c"] == cells["c"]]
                level = level.join(cells.where(F.col("side") == side), at, "left_anti")
        level = downsample(level, how)
        if own is not None:
            level = level.unionByName(own.where("v > 0").select(*AT, "v"))
        level = level.checkpoint()
        out.append(level.withColumn("level", F.lit(k)))
    return reduce(DataFrame.unionByName, out).select("level", *AT, "v")


def refresh(old: DataFrame, depth: int, how: str | Column, new: DataFrame) -> DataFrame:
    """The pyramid old(level, c, x, y, z, v) after new(c, x, y, z, v) are merged into its leaves: as if it were built anew.

    Only cubes above voxels that did change are computed. A level's changes are what differs from before, so they die out where a reducer
    gives the same value again; all other voxels are taken as they are.
    """

    def differing(found: DataFrame, before: DataFrame, rises: bool) -> DataFrame:
        known = before.select(*AT, F.col("v").alias("was"))
        return found.join(known, AT, "left").where("was IS NULL OR " + ("v > was" if rises else "v <> was")).select(*AT, "v").checkpoint()

    before = old.where(F.col("level") == depth).select(*AT, "v")
    changed = differing(max_merge(new), before, True)
    now, out = before.join(changed, AT, "left_anti").unionByName(changed), []
    out.append(now.withColumn("level", F.lit(depth)))
    for k in reversed(range(depth)):
        touched = changed.select("c", *[_down(a).alias(f"p{a}") for a in "xyz"]).distinct()
        under = [now["c"] == touched["c"]] + [F.shiftright(now[a], 1) == touched[f"p{a}"] for a in "xyz"]
        before = old.where(F.col("level") == k).select(*AT, "v")
        changed = differing(downsample(now.join(touched, under, "left_semi"), how), before, False)
        now = before.join(changed, AT, "left_anti").unionByName(changed)
        out.append(now.withColumn("level", F.lit(k)))
    return reduce(DataFrame.unionByName, out).select("level", *AT, "v")
