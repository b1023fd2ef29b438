"""Overlap joins of boxes, and the partition of a catalogue into jobs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxmill.functions.geometry import AXES, BOX, aabb_contains_origin, aabb_hit

#: A side goes out whole to every task only up to this many rows, which are counted first.
BROADCAST_ROWS = 500


def cell_sides(*sides: DataFrame) -> list[int]:
    """The grid cell for boxes: per axis the upper quartile of the sides of either table, the larger of the two; 1 at least."""
    found = [d.agg(*[F.percentile_approx(f"s{x}", 0.75).alias(x) for x in AXES]).first() for d in sides]
    return [max(1, *(r[x] or 1 for r in found)) for x in AXES]


def _level(cell: list[int]) -> Column:
    """How often the cell must be doubled to be as large as a box; 0 at least."""
    return F.greatest(F.lit(0), *[F.ceil(F.log2(F.col(f"s{x}") / c)).cast("int") for x, c in zip(AXES, cell, strict=True)])


def _cells(df: DataFrame, cell: list[int], levels: list[int]) -> DataFrame:
    """A row for each cell that a box touches: at its own level, and at every higher one that is in use."""
    df = df.withColumn("own", _level(cell))
    df = df.withColumn("level", F.explode(F.filter(F.array(*[F.lit(v) for v in levels]), lambda v: v >= F.col("own"))))
    for x, c in zip(AXES, cell, strict=True):
        side = F.expr(f"shiftleft({c}L, level)")
        df = df.withColumn(f"w{x}", side).withColumn(f"c{x}", F.explode(F.sequence(F.floor(F.col(f"o{x}") / side), F.floor((F.col(f"o{x}") + F.col(f"s{x}") - 1) / side))))
    return df


def bucketed_hits(a: DataFrame, b: DataFrame, cell: list[int] | None = None) -> DataFrame:
    """(a_id, b_id) of overlapping boxes with extent, by an equi-join on grid cells.

    Cells follow from the boxes: one of usual size touches eight at most, and larger ones lie in coarser grids, so no box touches
    many. Two boxes meet in the grid of the larger one, in the one cell where their overlap begins, so there is no distinct.
    The join is by sorted shuffles: Spark's estimates don't know how many rows an explode makes, and would send the cells of a side through the driver.
    """
    extent = " AND ".join(f"s{x} > 0" for x in AXES)
    a, b = (d.where(extent) for d in (a, b))
    cell = cell or cell_sides(a, b)
    levels = sorted({r[0] for d in (a, b) for r in d.select(_level(cell)).distinct().collect()})  # a few dozen at most
    left = _cells(a.select(F.col("id").alias("a_id"), *BOX), cell, levels).alias("a")
    right = _cells(b.select(F.col("id").alias("b_id"), *BOX), cell, levels).alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in ("level", *[f"c{x}" for x in AXES])]
    begins = F.greatest("a.own", "b.own") == F.col("a.level")
    for x in AXES:
        begins = begins & (F.floor(F.greatest(f"a.o{x}", f"b.o{x}") / F.col(f"a.w{x}")) == F.col(f"a.c{x}"))
    return left.join(right.hint("merge"), same).where(aabb_hit("a", "b") & begins).select("a_id", "b_id")


def broadcast_hits(a: DataFrame, b: DataFrame) -> DataFrame:
    """The same for any boxes, with b of a checked size held by each task."""
    right = b.select(F.col("id").alias("b_id"), *BOX).alias("b")
    return a.select(F.col("id").alias("a_id"), *BOX).alias("a").join(F.broadcast(right), aabb_hit("a", "b")).select("a_id", "b_id")


def spatial_join(a: DataFrame, b: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """(a_id, b_id) of overlapping boxes: b goes out whole if it has at most ``rows`` rows, else cells are joined."""
    small = b.limit(rows + 1).count() <= rows
    return broadcast_hits(a, b) if small else bucketed_hits(a, b)


def in_box(tiles: DataFrame, box: DataFrame, outside: bool = False) -> DataFrame:
    """Tiles that hit the one-row ``box`` and, unless ``outside``, begin in it."""
    rule = aabb_hit("t", "r")
    if not outside:
        rule = rule & aabb_contains_origin("r", "t")
    return tiles.alias("t").join(F.broadcast(box.alias("r")), rule).select("t.*")


def _halving(state: Column, upper: Callable[[Column, Column, Column], Column]) -> Column:
    """The half of a box (a struct of BOX, bits, n) along its longest axis, the first of equal ones; a box of side 1 stays.

    upper: whether it is the upper half, given the axis as a number and where the upper half begins.
    """
    side = {x: state[f"s{x}"] for x in AXES}
    axis = F.when((side["x"] >= side["y"]) & (side["x"] >= side["z"]), 0).when(side["y"] >= side["z"], 1).otherwise(2)
    low = F.shiftright(F.greatest(*side.values()), 1)
    begin = F.when(axis == 0, state["ox"]).when(axis == 1, state["oy"]).otherwise(state["oz"]) + low
    up = upper(axis, begin, state)
    fields = [F.when(axis == k, F.when(up, begin)).otherwise(None) for k in range(3)]
    new = [F.coalesce(f, state[f"o{x}"]).alias(f"o{x}") for f, x in zip(fields, AXES, strict=True)]
    new += [F.when(axis == k, F.when(up, side[x] - low).otherwise(low)).otherwise(side[x]).alias(f"s{x}") for k, x in enumerate(AXES)]
    half = F.struct(*new, (state["bits"] * 2 + up.cast("long")).alias("bits"), (state["n"] + 1).alias("n"))
    return F.when(F.greatest(*side.values()) > 1, half).otherwise(state)


def _start() -> Column:
    return F.struct(*[F.col(c).cast("long").alias(c) for c in BOX], F.lit(0).cast("long").alias("bits"), F.lit(0).alias("n"))


def kd_jobs(tiles: DataFrame, root: DataFrame, most: int, rounds: int = 64, steps: int | None = None) -> DataFrame:
    """Boxes with at most ``most`` tile origins each (or of side 1), and their counts; empty ones are left out.

    A round follows each tile down as many halvings as its number makes likely (or ``steps``), as bits of one number, and counts tiles by
    their bits; the counts of all boxes in between are sums of these. Only tiles of boxes that are overfull even then go on to another round.
    """
    held = tiles.alias("t").join(F.broadcast(root.alias("r")), aabb_hit("t", "r") & aabb_contains_origin("r", "t"))
    held = held.select(F.lit("").alias("base"), *[F.col(f"t.o{x}").alias(f"t{x}") for x in AXES], *[F.col(f"r.{c}").cast("long").alias(c) for c in BOX])
    whole = held.groupBy(*BOX).agg(F.count("*").alias("ntiles")).checkpoint()
    open_ = (F.col("ntiles") > most) & (F.greatest("sx", "sy", "sz") > 1)
    done = whole.where(~open_)
    n = whole.where(open_).agg(F.coalesce(F.sum("ntiles"), F.lit(0))).first()[0]
    for _ in range(rounds):
        if not n:
            return done
        depth = steps or min(48, max(4, (n // most).bit_length() + 3))
        own = lambda axis, begin, _: F.when(axis == 0, F.col("tx")).when(axis == 1, F.col("ty")).otherwise(F.col("tz")) >= begin
        walk = F.aggregate(F.sequence(F.lit(1), F.lit(depth)), _start(), lambda state, _: _halving(state, own))
        walked = held.withColumn("w", walk)
        cells = walked.groupBy("base", *BOX, "w.bits", "w.n").agg(F.count("*").alias("ntiles"))
        each = cells.select("base", *BOX, "ntiles", "bits", "n", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("j"))
        boxes = each.groupBy("base", *BOX, "j", F.expr("shiftright(bits, n - j)").alias("p")).agg(F.sum("ntiles").alias("ntiles"))
        # the box that the bits lead to
        replay = F.aggregate(F.sequence(F.lit(1), F.col("j")), _start(), lambda state, i: _halving(state, lambda axis, begin, st: F.call_function("shiftright", F.col("p"), F.col("j") - i) % 2 == 1))
        boxes = boxes.withColumn("w", replay).select("base", "j", "p", "ntiles", *[F.col(f"w.{c}").alias(c) for c in BOX]).withColumn("full", open_).checkpoint()
        above = boxes.where("full").select("base", (F.col("j") + 1).alias("j"), F.col("p").alias("up"))
        ready = boxes.where("NOT full").withColumn("up", F.shiftright("p", 1))
        done = done.unionByName(ready.where("j = 1").select(*BOX, "ntiles")).unionByName(ready.join(above, ["base", "j", "up"], "left_semi").select(*BOX, "ntiles"))
        over = boxes.where(F.col("full") & (F.col("j") == depth)).select("base", F.col("p").alias("bits"), "ntiles")
        n = over.agg(F.coalesce(F.sum("ntiles"), F.lit(0))).first()[0]
        if n:
            again = walked.withColumn("bits", F.col("w.bits")).where(F.col("w.n") == depth).join(over.select("base", "bits"), ["base", "bits"])
            held = again.select(F.concat_ws("/", "base", F.col("bits").cast("string")).alias("base"), *[f"t{x}" for x in AXES], *[F.col(f"w.{c}").alias(c) for c in BOX]).checkpoint()
    raise RuntimeError("boxes did not shrink")


def in_descending_order(jobs: DataFrame) -> DataFrame:
    """Jobs with their number, the largest first: ranked among those of equal size, after the counts of all larger sizes."""
    sizes = jobs.groupBy("ntiles").agg(F.count("*").alias("n"))
    # one row per size of a job
    before = sizes.select("ntiles", F.coalesce(F.sum("n").over(Window.orderBy(F.desc("ntiles")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    nth = F.row_number().over(Window.partitionBy("ntiles").orderBy(*BOX))
    return jobs.withColumn("nth", nth).join(before, "ntiles").withColumn("job", F.col("before") + F.col("nth")).drop("nth", "before")
