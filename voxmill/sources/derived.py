"""The engine's input relations, derived from the star-schema tables by integer arithmetic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tile boxes: id, ox, oy, oz, sx, sy, sz. Each 2,000 tiles lie further along x, so that tiles don't get denser with their number."""
    return read(spark, sf_dir, "part", "p_partkey", "p_size").selectExpr(
        "p_partkey AS id", "p_partkey * 37 % 997 + p_partkey div 2000 * 1000 AS ox", "p_partkey * 91 % 991 AS oy", "(p_partkey * 53 + p_partkey * p_partkey) % 983 AS oz",
        "CAST(p_size AS BIGINT) * 4 + 20 AS sx", "CAST(p_size AS BIGINT) * 3 + 40 AS sy", "CAST(p_size AS BIGINT) * 2 + 60 AS sz",
    )


def tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tile catalogue over ``boxes``: path, dims, and a grid of 3 x 2 x 3 control points inside each box."""
    return boxes(spark, sf_dir).select(
        "*",
        F.format_string("/%02d/%05d", F.col("id") % 100, F.col("id")).alias("path"),
        F.array(*[F.lit(v) for v in (16, 32, 64, 1)]).alias("dims"),
        F.array(*[F.lit(v) for v in (0, 7, 14)]).alias("xlims"),
        F.array(*[F.lit(v) for v in (0, 31)]).alias("ylims"),
        F.array(F.lit(3), (F.col("id") % 20 + 10).cast("int"), F.lit(60)).alias("zlims"),
    )


def grid_nodes(tiles: DataFrame) -> DataFrame:
    """(id, ix, iy, iz, x, y, z) of each control point, indexes from 1, component x fastest."""
    at = lambda o, s, i, n: (F.col(o) + F.floor(F.col(s) * (F.col(i) - 1) / n)).cast("long")
    grid = tiles.select("*", F.explode(F.sequence(F.lit(1), F.size("zlims"))).alias("iz")).select("*", F.explode(F.sequence(F.lit(1), F.size("ylims"))).alias("iy"))
    grid = grid.select("*", F.explode(F.sequence(F.lit(1), F.size("xlims"))).alias("ix"))
    return grid.select("id", "ix", "iy", "iz", at("ox", "sx", "ix", 2).alias("x"), at("oy", "sy", "iy", 1).alias("y"), at("oz", "sz", "iz", 2).alias("z"))


def voxels(spark: SparkSession, sf_dir: str, side: int = 16) -> DataFrame:
    """Sparse voxels of four sources: src, c, x, y, z, v. An absent voxel is 0. Tiles of ``side`` voxels lie along x, one for each 16,384 orders."""
    m = side - 1
    return read(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice").selectExpr(
        "shiftright(l_orderkey, 4) & 3 AS src", "l_linenumber % 3 AS c", f"CAST((l_partkey & {m}) + shiftright(l_orderkey, 14) * {side} AS INT) AS x", f"CAST(l_suppkey & {m} AS INT) AS y", f"CAST(l_orderkey & {m} AS INT) AS z",
        "CAST(CAST(floor(l_extendedprice) AS BIGINT) & 65535 AS INT) AS v",
    )


def node_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """k, job, a three-digit octree path, and whether the image there is lit, per order."""
    k = F.col("o_orderkey")
    digit = lambda n: (F.shiftright(k, n).bitwiseAND(7) + 1).cast("string")
    rows = read(spark, sf_dir, "orders", "o_orderkey", "o_orderstatus")
    return rows.select(k.alias("k"), (k % 512 + 1).alias("job"), F.concat_ws("/", digit(6), digit(3), digit(0)).alias("path"), (F.col("o_orderstatus") != "O").alias("lit"))


# The texts of timed log lines, by the stage group of each.
STAGES = {
    "leaf": ["reading input tile", "initializing", "transforming", "saving output tiles", "waiting"],
    "merge": ["copying / moving single", "merging multiple", "clearing multiple", "reading multiple", "max'ing multiple", "deleting multiple", "writing multiple"],
    "octree": ["clearing octree", "downsampling octree", "saving octree"],
}
CATEGORIES = [*STAGES["leaf"], "overall", "peons", "squatters", "merging", *STAGES["merge"], *STAGES["octree"]]


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """file, line: timed lines of the stages, warnings, errors and faults, one per event."""
    texts = [*STAGES["leaf"], *STAGES["merge"], *STAGES["octree"], "overall"]
    text = F.element_at(F.array(*[F.lit(t) for t in texts]), (F.col("event_id") % len(texts) + 1).cast("int"))
    n = F.coalesce("value", F.lit(0.0)).cast("decimal(18,2)").cast("string")
    line = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("[ ERROR: "), text, F.lit(" might have failed")))
        .when((F.col("event_type") == "signup") & (F.col("event_id") % 3 == 0), F.concat(F.lit("[ WARNING: "), text))
        .when((F.col("event_type") == "view") & (F.col("event_id") % 5 == 0), F.concat(F.lit("Segmentation fault in "), text))
        .otherwise(F.concat(F.lit("[ Info: PEON: "), text, F.lit(" took "), n, F.lit(" sec")))
    )
    events = read(spark, sf_dir, "events", "event_id", "user_id", "event_type", "value")
    return events.select(F.concat(F.lit("squatter"), (F.col("user_id") % 20).cast("string"), F.lit(".log")).alias("file"), "event_id", line.alias("line"))


def monitor_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """event_id, value: twelve-field monitor lines, some with fields missing or cut short."""
    kb = F.floor(F.coalesce("value", F.lit(0.0)) * 1000).cast("long")
    units = F.when(F.col("event_id") % 7 == 0, F.lit("-")).otherwise(F.concat(kb.cast("string"), F.lit("M")))
    fields = [
        F.lit("1"), F.concat(F.lit("node"), F.col("user_id").cast("string")), F.lit("64G"), units, F.lit("8G"), F.lit("0B"), F.lit("900G"), F.lit("10G"),
        F.when(F.col("event_id") % 11 == 0, F.lit("--M")).otherwise(F.lit("5M")), F.lit("3M"), (kb % 100).cast("string"), (F.col("event_id") % 50).cast("string"),
    ]
    whole = F.concat_ws("  ", *fields)
    events = read(spark, sf_dir, "events", "event_id", "user_id", "value")
    return events.select("event_id", F.when(F.col("event_id") % 13 == 0, F.concat_ws(" ", *fields[:5])).otherwise(whole).alias("value"))


def counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """node, seq, interface, rx: network counters that only grow, two interfaces a sample."""
    events = read(spark, sf_dir, "events", "event_id", "user_id", "value")
    rx = F.col("event_id") * 104857600 + F.floor(F.coalesce("value", F.lit(0.0)) * 1000000).cast("long")
    return events.select(F.col("user_id").alias("node"), F.col("event_id").alias("seq"), F.explode(F.array(F.lit(0), F.lit(1))).alias("interface"), rx.alias("rx")).withColumn("rx", F.col("rx") * (F.col("interface") + 1))
