"""Exact quantiles of any number of groups in bounded memory: distributed selection by refined histograms.

A quantile lies between two order statistics. Each pass counts the rows of every still open interval in ``bins`` bins, for all groups
and statistics at once, by an aggregation with map-side sums; the bin that holds the statistic is the next interval, with the least and greatest value that
it really holds. When an interval is one value it is done; when it holds few rows it is finished by counting its values. So no buffer
holds a group's values, and no task sorts a group: per statistic there are at most ``bins`` counts, then ``few`` values.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def _spread(v: Column) -> Column:
    """A rising function under which values of all sizes lie in few bins' reach."""
    return F.signum(v) * F.log1p(F.abs(v))


def _upto(rows: DataFrame, key: list[str], order: str) -> DataFrame:
    """rows(key, n, ...) with the number of rows of earlier ones of the same key; a key has a bounded number."""
    window = Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("before", F.coalesce(F.sum("n").over(window), F.lit(0)))


def quantiles(rows: DataFrame, by: list[str], value: str, probabilities: dict[str, float], bins: int = 256, few: int = 4096, passes: int = 16) -> DataFrame:
    """(by, one column a name of ``probabilities``): linear between the two nearest values, as ``percentile`` gives them.

    Null values don't count; a group without others has no row. Rows are shuffled only where intervals are too many to be sent to all tasks.
    """
    data = rows.where(F.col(value).isNotNull()).select(*by, F.col(value).cast("double").alias("v"))
    whole = data.groupBy(*by).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).checkpoint()
    each = F.explode(F.array(*[F.struct(F.lit(name).alias("name"), F.lit(float(p)).alias("p")) for name, p in probabilities.items()]))
    asked = whole.select("*", each.alias("q")).select(*by, "n", "lo", "hi", "q.*").withColumn("at", (F.col("n") - 1) * F.col("p"))
    # the order statistics on either side; the same one is looked for once
    ranks = asked.select(*by, "n", "lo", "hi", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("rank")).distinct()
    open_ = ranks.select(*by, "rank", F.col("rank").alias("rest"), "n", "lo", "hi")
    done: list[DataFrame] = []
    for last in [False] * passes + [True]:
        found = open_.where("lo = hi").select(*by, "rank", F.col("lo").alias("v"))
        left = open_.where("lo < hi")
        short = left if last else left.where(F.col("n") <= few)
        if not short.isEmpty():
            # few rows, or few values: those of an interval are counted one by one
            counts = data.join(short.select(*by, "rank", "rest", "lo", "hi"), by).where("v >= lo AND v <= hi").groupBy(*by, "rank", "rest", "v").agg(F.count("*").alias("n"))
            hit = _upto(counts, [*by, "rank"], "v").where("before <= rest AND rest < before + n")
            found = found.unionByName(hit.select(*by, "rank", "v"))
        done.append(found.checkpoint())
        left = left.where(F.col("n") > few)
        if last or left.isEmpty():
            break
        share = (_spread(F.col("v")) - _spread(F.col("lo"))) / (_spread(F.col("hi")) - _spread(F.col("lo")))
        binned = data.join(left.select(*by, "rank", "rest", "lo", "hi"), by).where("v >= lo AND v <= hi")
        # values so close that they have the same spread lie in one bin
        binned = binned.withColumn("bin", F.coalesce(F.least(F.lit(bins - 1), F.floor(F.when(_spread(F.col("hi")) > _spread(F.col("lo")), share) * bins)), F.lit(0)))
        counts = binned.groupBy(*by, "rank", "rest", "bin").agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        hit = _upto(counts, [*by, "rank"], "bin").where("before <= rest AND rest < before + n")
        open_ = hit.select(*by, "rank", (F.col("rest") - F.col("before")).alias("rest"), "n", "lo", "hi").checkpoint()
    statistics = reduce(DataFrame.unionByName, done)
    pairs = asked.select(*by, "name", "at", F.explode(F.array_distinct(F.array(F.floor("at"), F.ceil("at")))).alias("rank"))
    weight = F.when(F.floor("at") == F.ceil("at"), F.lit(1.0)).when(F.col("rank") == F.floor("at"), F.ceil("at") - F.col("at")).otherwise(F.col("at") - F.floor("at"))
    values = pairs.join(statistics, [*by, "rank"]).groupBy(*by, "name").agg(F.sum(F.col("v") * weight).alias("value"))
    columns = [F.max(F.when(F.col("name") == name, F.col("value"))).alias(name) for name in probabilities]
    return values.groupBy(*by).agg(*columns)
