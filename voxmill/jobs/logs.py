"""Profiles of timed log lines, and per-node series of a resource monitor."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxmill.operators.quantiles import quantiles
from voxmill.sources.derived import CATEGORIES, STAGES

SECONDS = r"([0-9.]*)(?= sec)"


def timed(lines: DataFrame) -> DataFrame:
    """Lines that took some time, with the seconds."""
    return lines.where(F.contains("line", F.lit("took"))).withColumn("sec", F.concat(F.lit("0"), F.regexp_extract("line", SECONDS, 1)).cast("double"))


def categorised(lines: DataFrame) -> DataFrame:
    """A row per line and category in it: one line may be of several."""
    found = F.array_compact(F.array(*[F.when(F.contains("line", F.lit(c)), F.lit(c)) for c in CATEGORIES]))
    return timed(lines).select("*", F.explode(found).alias("category"))


def stage_profile(lines: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Per category: lines, extremes, total and quartiles, exact ones by refined histograms or, with ``accuracy``, approximate ones in one pass."""
    rows, quartiles = categorised(lines).select("category", "sec"), {"q25": 0.25, "q50": 0.5, "q75": 0.75}
    rows = rows if accuracy else rows.checkpoint()
    q = [F.percentile_approx("sec", p, accuracy).alias(name) for name, p in quartiles.items()] if accuracy else []
    out = rows.groupBy("category").agg(F.count("*").alias("n"), F.min("sec").alias("least"), F.max("sec").alias("most"), F.sum(F.col("sec").cast("decimal(20,2)")).alias("total"), *q)
    return out if accuracy else out.join(quantiles(rows, ["category"], "sec", quartiles), "category")


def stage_group(category: Column) -> Column:
    return F.coalesce(*[F.when(category.isin(names), F.lit(g)) for g, names in STAGES.items()])


def profile_bar(lines: DataFrame) -> DataFrame:
    """Hours per stage of the bar chart, with its group."""
    rows = categorised(lines).withColumn("stage_group", stage_group(F.col("category"))).where("stage_group IS NOT NULL")
    return rows.groupBy("stage_group", "category").agg((F.sum(F.col("sec").cast("decimal(20,2)")).cast("double") / 3600).alias("hours"))


def log_counts(lines: DataFrame) -> DataFrame:
    """Per file: tiles read, outputs saved, errors, failures, warnings and faults, where any."""
    has = lambda p: F.count(F.when(F.rlike("line", F.lit(p)), 1))
    counted = lines.groupBy("file").agg(
        has("reading input tile").alias("tiles_read"), has("(copying (from|to))|(saving output)").alias("outputs_saved"), has("ERROR").alias("errors"), has("might have failed").alias("failures"), has("WARNING").alias("warnings"), has("Segmentation fault").alias("faults")
    )
    return counted.where("tiles_read + outputs_saved + errors + failures + warnings + faults > 0")


def timing_rollup(lines: DataFrame) -> DataFrame:
    """Seconds summed per file and category."""
    return categorised(lines).groupBy("file", "category").agg(F.sum(F.col("sec").cast("decimal(20,2)")).alias("total"))


def with_unit(field: Column) -> Column:
    """Bytes of a size such as 12K; null for one that is missing."""
    power = F.element_at(F.create_map(*[F.lit(x) for pair in zip("BKMG", (1.0, 1e3, 1e6, 1e9), strict=True) for x in pair]), F.right(field, F.lit(1)))
    return F.when(field.isin("-", "--M"), None).otherwise(F.substring(field, F.lit(1), F.length(field) - 1).cast("double") * power)


def monitor_samples(lines: DataFrame) -> DataFrame:
    """Samples of lines(event_id, value) with exactly twelve fields."""
    f = lambda i: F.get("f", F.lit(i - 1))
    rows = lines.withColumn("f", F.filter(F.split("value", r"\s+"), lambda x: x != "")).where(F.size("f") == 12)
    sizes = {"mem_used": 4, "swap_used": 6, "scratch": 8, "rx": 9, "tx": 10}
    return rows.select("event_id", f(2).alias("node"), *[with_unit(f(i)).alias(n) for n, i in sizes.items()], f(11).cast("double").alias("load"), f(12).cast("double").alias("ntiles"))


def cluster_series(samples: DataFrame) -> DataFrame:
    """(seq, ntiles): the nodes' series added by position, shorter ones counting 0."""
    at = F.row_number().over(Window.partitionBy("node").orderBy("event_id"))
    return samples.withColumn("seq", at).groupBy("seq").agg(F.sum(F.col("ntiles").cast("long")).alias("ntiles"))


def node_rates(counters: DataFrame, interval: int = 600) -> DataFrame:
    """(node, seq, rx, mbps): counters summed over interfaces, and their rise in whole MB/s; null for the first sample."""
    total = counters.groupBy("node", "seq").agg(F.sum("rx").alias("rx"))
    rise = F.col("rx") - F.lag("rx").over(Window.partitionBy("node").orderBy("seq"))
    return total.withColumn("rise", rise).selectExpr("node", "seq", "rx", f"rise div {interval} div 1024 div 1024 AS mbps")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(file, line) of a folder of logs, or of a tar.gz of them, which the tasks unpack a member at a time."""
    if not path.endswith((".tar.gz", ".tgz")):
        return spark.read.text(path, recursiveFileLookup=True).select(F.regexp_extract(F.input_file_name(), "([^/]+)$", 1).alias("file"), F.col("value").alias("line"))
    import io
    import tarfile

    import pandas as pd

    def run(frames):
        for f in frames:
            for raw in f.content:
                with tarfile.open(fileobj=io.BytesIO(raw), mode="r:gz") as tar:
                    for m in tar:
                        if m.isfile():
                            text = tar.extractfile(m).read().decode(errors="replace").splitlines()
                            yield pd.DataFrame({"file": [m.name] * len(text), "line": text})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(run, "file string, line string")
