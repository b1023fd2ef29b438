"""Tile catalogues: YAML in, a Parquet copy, checks of the control-point grid, sub-tiles."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxmill.functions.geometry import AXES

SCHEMA = (
    "id long, path string, ox long, oy long, oz long, sx long, sy long, sz long, type string, dims array<int>, "
    "xlims array<int>, ylims array<int>, zlims array<int>, coordinates array<long>"
)


def _modified(spark: SparkSession, path: str) -> float:
    """When a path last changed, in seconds; 0 if there is none."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.getFileStatus(place).getModificationTime() / 1000 if fs.exists(place) else 0.0


def _parsed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The tiles among records of a catalogue, each of which is an item of its list or the lines before it."""
    import yaml

    loader = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    for f in frames:
        rows = []
        for block, at, text in zip(f.block, f["at"], f.value, strict=True):
            t = yaml.load(f"- {text}", Loader=loader)[0] if "aabb" in text else None
            if isinstance(t, dict) and "aabb" in t:
                rows.append((block, at, t["path"], *t["aabb"]["ori"], *t["aabb"]["shape"], t["shape"]["type"], t["shape"]["dims"], t["grid"]["xlims"], t["grid"]["ylims"], t["grid"]["zlims"], t["grid"]["coordinates"]))
        yield pd.DataFrame(rows, columns=["block", "at", *names[1:]])


def read_yaml(spark: SparkSession, path: str, cache: str | None = None) -> DataFrame:
    """The tiles of a catalogue, ids from 1 in its order; a Parquet copy at ``cache`` that is newer than the YAML is read instead.

    Items of the list begin with a dash in the first column. The file is split there, and tasks parse the items; ids
    count those of earlier blocks of the file, then those before in the block.
    """
    if cache and _modified(spark, cache) > _modified(spark, path):
        return spark.read.parquet(cache)
    records = spark.read.option("lineSep", "\n- ").text(path).select(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"), "value")
    tiles = records.mapInPandas(_parsed, "block long, at long, " + SCHEMA.split(", ", 1)[1])
    blocks = tiles.groupBy("block").agg(F.count("*").alias("n"))
    # one row a block of the file
    before = F.coalesce(F.sum("n").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    nth = F.row_number().over(Window.partitionBy("block").orderBy("at"))
    named = tiles.withColumn("nth", nth).join(blocks.select("block", before.alias("before")), "block")
    df = named.select((F.col("before") + F.col("nth")).alias("id"), *[x.split()[0] for x in SCHEMA.split(", ")[1:]])
    if cache:
        df.write.mode("overwrite").parquet(cache)
        return spark.read.parquet(cache)
    return df


def violations() -> Column:
    """The names of the grid rules that a tile breaks."""
    even = lambda c: F.size(F.array_distinct(F.transform(F.slice(c, 2, 1000), lambda v, i: v - F.get(F.col(c), i)))) <= 1
    rising = F.forall(F.slice("zlims", 2, 1000), lambda v: F.exists(F.col("zlims"), lambda u: u < v)) & (F.sort_array("zlims") == F.col("zlims")) & (F.size(F.array_distinct("zlims")) == F.size("zlims"))
    inside = [(F.array_min(f"{a}lims") >= 0) & (F.array_max(f"{a}lims") < F.get("dims", F.lit(k))) for k, a in enumerate(AXES)]
    rules = {"xlims_even": even("xlims"), "ylims_even": even("ylims"), "zlims_rising": rising} | {f"{a}lims_inside": ok for a, ok in zip(AXES, inside, strict=True)}
    return F.array_compact(F.array(*[F.when(~ok, F.lit(n)) for n, ok in rules.items()]))


#: What all tiles of a catalogue must share.
SHARED = {"same_zlims_count": "size(zlims)", "same_xlims": "xlims", "same_ylims": "ylims"}


def shared_violations(tiles: DataFrame) -> DataFrame:
    """(rule, kinds, broken) of the rules that hold between tiles: how many different values there are, and whether that is too many."""
    each = tiles.select(F.explode(F.array(*[F.struct(F.lit(rule).alias("rule"), F.expr(f"concat_ws(',', {what})" if "size" not in what else f"cast({what} AS string)").alias("value")) for rule, what in SHARED.items()])).alias("r"))
    return each.groupBy("r.rule").agg(F.count_distinct("r.value").alias("kinds")).withColumn("broken", F.col("kinds") > 1)


def grid_nodes(tiles: DataFrame) -> DataFrame:
    """(id, ix, iy, iz, x, y, z) of each control point of tiles(id, xlims, ylims, coordinates), indexes from 1, x fastest."""
    each = tiles.select("id", F.size("xlims").alias("nx"), F.size("ylims").alias("ny"), "coordinates", F.explode(F.sequence(F.lit(0), (F.size("coordinates") / 3 - 1).cast("int"))).alias("k"))
    at = [F.get("coordinates", F.col("k") * 3 + i).alias(a) for i, a in enumerate(AXES)]
    return each.select("id", (F.col("k") % F.col("nx") + 1).alias("ix"), (F.floor(F.col("k") / F.col("nx")) % F.col("ny") + 1).cast("int").alias("iy"), (F.floor(F.col("k") / (F.col("nx") * F.col("ny"))) + 1).cast("int").alias("iz"), *at)


def corner_nodes(nodes: DataFrame) -> DataFrame:
    """(id, ix, iy, iz, b, x, y, z): the eight corners of each sub-tile of nodes(id, ix, iy, iz, x, y, z).

    A node is a corner of up to eight cells, so it is sent to each: one explode, no self-join. The ends of a tile's grid come from a
    window over its nodes: a join with them would be broadcast, as Spark's estimates don't know how many rows an explode makes.
    """
    tile = Window.partitionBy("id")
    last = nodes.select("*", *[F.max(f"i{a}").over(tile).alias(f"n{a}") for a in AXES])
    each = last.select("*", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("b"))
    for k, a in enumerate(AXES):
        each = each.withColumn(f"j{a}", F.col(f"i{a}") - F.shiftright("b", k).bitwiseAND(1))
    each = each.where(" AND ".join(f"j{a} >= 1 AND j{a} < n{a}" for a in AXES))
    return each.select("id", *[F.col(f"j{a}").alias(f"i{a}") for a in AXES], "b", *AXES)


def subtiles(nodes: DataFrame, corners: bool = False) -> DataFrame:
    """(id, ix, iy, iz, box, orientation): each sub-tile's box from its corners, not from the tile's own; with ``corners`` also these, as 24 numbers."""
    found = [F.min(a).alias(f"o{a}") for a in AXES] + [(F.max(a) - F.min(a)).alias(f"s{a}") for a in AXES]
    if corners:
        eight = F.sort_array(F.collect_list(F.struct("b", *AXES)))
        found.append(F.flatten(F.transform(eight, lambda c: F.array(c["x"], c["y"], c["z"]))).alias("corners"))
    out = corner_nodes(nodes).groupBy("id", "ix", "iy", "iz").agg(*found)
    return out.withColumn("orientation", F.when((F.col("ix") + F.col("iy") + F.col("iz")) % 2 == 1, 90).otherwise(0))


def corner_indices(nx: int, ny: int) -> list[Column]:
    """The eight 1-based indexes into a grid's coordinates, x fastest, for columns ix, iy, iz."""
    return [
        (1 + (F.col("ix") - 1 + (b & 1)) + nx * (F.col("iy") - 1 + (b >> 1 & 1)) + nx * ny * (F.col("iz") - 1 + (b >> 2 & 1))).alias(f"corner{b}")
        for b in range(8)
    ]
