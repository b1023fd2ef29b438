"""Octree nodes, descent, leaf order, and the plan of a volume."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxmill.functions.geometry import AXES, BOX, aabb_hit, octant


def children(nodes: DataFrame) -> DataFrame:
    """The eight children of nodes(path, level, morton, box)."""
    each = nodes.select("*", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("digit"))
    box = octant(F.col("digit"))
    path = F.when(F.col("path") == "", F.col("digit").cast("string")).otherwise(F.concat_ws("/", "path", F.col("digit").cast("string")))
    return each.select(path.alias("path"), (F.col("level") + 1).alias("level"), (F.col("morton") * 8 + F.col("digit") - 1).alias("morton"), *[box[c].alias(c) for c in BOX])


def root(box: DataFrame) -> DataFrame:
    return box.select(F.lit("").alias("path"), F.lit(0).alias("level"), F.lit(0).cast("long").alias("morton"), *BOX)


def levels(box: DataFrame, depth: int) -> list[DataFrame]:
    """All nodes of each level 0..depth: 8^level rows each."""
    out = [root(box)]
    for _ in range(depth):
        out.append(children(out[-1]))
    return out


def descend(tiles: DataFrame, box: DataFrame, depth: int, leaves_only: bool = False) -> DataFrame:
    """(path, level, id) of each node and tile that overlap, with the node's box; it goes down only where they do, and joins at the root alone."""
    pairs = tiles.alias("t").join(F.broadcast(root(box).alias("n")), aabb_hit("t", "n"))
    keep = ["path", "level", "morton", *BOX]
    found = [pairs.select("t.id", *[F.col(f"t.{c}").alias(f"t{c}") for c in BOX], *[F.col(f"n.{c}") for c in keep])]
    for _ in range(depth):
        up = found[-1].select(F.struct("id", *[f"t{c}" for c in BOX]).alias("tile"), *keep)
        each = up.select("*", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("digit"))
        b = octant(F.col("digit"))
        path = F.when(F.col("path") == "", F.col("digit").cast("string")).otherwise(F.concat_ws("/", "path", F.col("digit").cast("string")))
        new = each.select("tile.*", path.alias("path"), (F.col("level") + 1).alias("level"), (F.col("morton") * 8 + F.col("digit") - 1).alias("morton"), *[b[c].alias(c) for c in BOX])
        hit = F.expr(" AND ".join(f"least(to{x} + ts{x}, o{x} + s{x}) > greatest(to{x}, o{x})" for x in AXES))
        # every level is a result as well, so it isn't computed again for those below it
        found.append(new.where(hit) if leaves_only else new.where(hit).checkpoint())
    return found[-1] if leaves_only else reduce(DataFrame.unionByName, found)


def locality(pairs: DataFrame, block_bits: int = 12) -> DataFrame:
    """(id, first_leaf, rank) of tiles by the first leaf that they touch, depth first.

    pairs(id, morton). Ranks are taken within blocks of 2^block_bits leaves, and the sizes of earlier blocks are added: a task sorts
    one block's tiles, and the blocks themselves are ranked the same way in blocks of blocks.
    """
    first = pairs.groupBy("id").agg(F.min("morton").alias("first_leaf")).withColumn("block", F.shiftright("first_leaf", block_bits)).withColumn("super", F.shiftright("first_leaf", 2 * block_bits))
    sizes = first.groupBy("super", "block").agg(F.count("*").alias("n"))
    inside = Window.partitionBy("super").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("in_super", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    supers = sizes.groupBy("super").agg(F.sum("n").alias("all"))
    # one row per 2^(2 x block_bits) leaves
    earlier = Window.orderBy("super").rowsBetween(Window.unboundedPreceding, -1)
    supers = supers.select("super", F.coalesce(F.sum("all").over(earlier), F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("block").orderBy("first_leaf", "id"))
    ranked = first.withColumn("nth", within).join(sizes.select("block", "in_super"), "block").join(supers, "super")
    return ranked.select("id", "first_leaf", (F.col("before") + F.col("in_super") + F.col("nth")).alias("rank"))


def leaf_shape(shapes: DataFrame, divisor: int, reach: int = 20, step: int = 2, volume: int = 4096) -> DataFrame:
    """(g, px, py, pz, dx, dy, dz, cost): the leaf shape nearest to an initial one, in whole pixels.

    shapes(g, ix, iy, iz). Deltas are tried on each axis; the product must divide by ``volume`` and each side by ``divisor``;
    the least sum of absolute deltas wins, then the least dx, dy, dz. A shape without a solution has no row.
    """
    tried = shapes
    for x in AXES:
        tried = tried.select("*", F.explode(F.sequence(F.lit(-reach), F.lit(reach), F.lit(step))).alias(f"d{x}"))
        tried = tried.withColumn(f"p{x}", F.col(f"i{x}") + F.col(f"d{x}")).where((F.col(f"p{x}") % divisor == 0) & (F.col(f"p{x}") > 0))
    tried = tried.where(F.col("px") * F.col("py") * F.col("pz") % volume == 0)
    cost = F.abs("dx") + F.abs("dy") + F.abs("dz")
    best = tried.groupBy("g").agg(F.min(F.struct(cost.alias("cost"), "dx", "dy", "dz", "px", "py", "pz")).alias("b"))
    return best.select("g", *[F.col(f"b.{c}") for c in ("px", "py", "pz", "dx", "dy", "dz", "cost")])
