"""Quantiles by refined histograms against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxmill import queries
from voxmill.operators.quantiles import quantiles

ASKED = {"least": 0.0, "q25": 0.25, "half": 0.5, "p999": 0.999, "most": 1.0}


@pytest.mark.parametrize(("bins", "few"), [(4, 1), (16, 50), (256, 4096)])
def test_groups_of_all_kinds(spark, bins, few):
    queries.checkpoints(spark)
    rng = np.random.default_rng(bins)
    groups = {
        "one": [3.5], "two": [1.0, 2.0], "equal": [7.0] * 500, "negative": (-rng.exponential(1e5, 3000)).tolist(), "huge": (10.0 ** rng.uniform(-300, 300, 700)).tolist(),
        "close": (1 + rng.integers(0, 50, 800) * 2**-52).tolist(), "few values": rng.integers(0, 3, 4000).astype(float).tolist(), "even": rng.uniform(-1, 1, 2501).tolist(), "tiny": (rng.uniform(0, 1, 300) * 1e-300).tolist(),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs] + [("even", None), ("none", None)]
    found = {r.g: r for r in quantiles(spark.createDataFrame(rows, "g string, v double").repartition(5), ["g"], "v", ASKED, bins, few).collect()}
    assert set(found) == set(groups)
    for g, vs in groups.items():
        for name, p in ASKED.items():
            at, ordered = (len(vs) - 1) * p, sorted(vs)
            low, high = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
            want = low if low == high or at == int(at) else low * (np.ceil(at) - at) + high * (at - np.floor(at))
            assert found[g][name] == pytest.approx(want, rel=1e-12), (g, name)


def test_many_small_groups_and_no_rows(spark):
    queries.checkpoints(spark)
    rows = spark.range(20_000).select((F.col("id") % 3000).alias("g"), (F.col("id") * 7919 % 1000).alias("v"))
    got = {r.g: r.p for r in quantiles(rows, ["g"], "v", {"p": 0.3}).collect()}
    assert got == pytest.approx({r.g: r.p for r in rows.groupBy("g").agg(F.percentile("v", 0.3).alias("p")).collect()})
    assert quantiles(rows.limit(0), ["g"], "v", {"p": 0.3}).count() == 0


def test_no_group_is_gathered(spark):
    """A pass hands on counts of bins, not values: what the plan's windows see is bounded."""
    queries.checkpoints(spark)
    rows = spark.range(200_000).select(F.lit("all").alias("g"), F.rand(3).alias("v")).checkpoint()
    got = quantiles(rows, ["g"], "v", {"p": 0.999}, bins=64, few=500).first().p
    assert got == pytest.approx(np.quantile(rows.toPandas().v, 0.999))
