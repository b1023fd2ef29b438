"""Region scans over a space-filling order, incremental pyramids, and the stream of rates."""

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxmill import queries
from voxmill.functions.geometry import BOX
from voxmill.jobs import logs
from voxmill.operators import merge, regions, spatial
from voxmill.sources import derived
from voxmill.streaming import rates


def code(x, y, z, bits):
    return sum((x >> i & 1) << 3 * i | (y >> i & 1) << 3 * i + 1 | (z >> i & 1) << 3 * i + 2 for i in range(bits))


@pytest.mark.parametrize("most", [1, 8, 20, 1000])
def test_ranges_hold_the_box(most):
    rng = np.random.default_rng(4)
    for _ in range(20):
        low, high = np.sort(rng.integers(0, 16, (2, 3)), 0)
        ranges = regions.code_ranges(tuple(low), tuple(high), most, 4)
        assert len(ranges) <= max(most, 1) and all(a <= b for a, b in ranges) and all(p[1] + 1 < q[0] for p, q in itertools.pairwise(ranges))
        inside = {code(*map(int, at), 4) for at in itertools.product(*[range(a, b + 1) for a, b in zip(low, high, strict=True)])}
        held = {c for a, b in ranges for c in range(a, b + 1)}
        assert inside <= held and (most < 1000 or inside == held)


def rows_scanned(df):
    """Rows that the table's scan gave, after row groups were left out; the query runs."""
    df.collect()
    todo, found = [df._jdf.queryExecution().executedPlan()], []
    while todo:
        p = todo.pop()
        kids = p.children()
        todo += [kids.apply(i) for i in range(kids.size())]
        if p.nodeName().startswith("Scan parquet"):
            found.append(p.metrics().apply("numOutputRows").value())
        if p.nodeName() == "AdaptiveSparkPlan":
            todo.append(p.executedPlan())
    return sum(found)


def test_a_region_scan_reads_few_row_groups(spark, tmp_path):
    n = 60_000
    at = [(F.xxhash64(F.lit(k), "id") % 1_000_000).cast("long") for k in range(3)]
    tiles = spark.range(n).select("id", *[F.abs(a).alias(c) for a, c in zip(at, BOX, strict=False)], *[F.lit(500).cast("long").alias(c) for c in BOX[3:]])
    origin, shape = (0, 0, 0), (1_000_000,) * 3
    regions.write_ordered(tiles, str(tmp_path / "t"), origin, shape, 4, 32 << 10)
    for box in [(100_000, 600_000, 300_000, 60_000, 50_000, 90_000), (0, 0, 0, 1_000_000, 1_000_000, 1_000_000), (999_999, 0, 0, 1, 1_000_000, 1_000_000), (5, 5, 5, 0, 5, 5), (2_000_000, 0, 0, 9, 9, 9)]:
        found = regions.scan(spark, str(tmp_path / "t"), origin, shape, box)
        one = spark.createDataFrame([box], ", ".join(f"{c} long" for c in BOX))
        assert sorted(tuple(r) for r in found.collect()) == sorted(tuple(r) for r in spatial.in_box(tiles, one).collect())
    small = regions.scan(spark, str(tmp_path / "t"), origin, shape, (100_000, 600_000, 300_000, 60_000, 50_000, 90_000))
    plan = small._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(code" in plan
    assert rows_scanned(small) < n / 5


def test_a_refreshed_pyramid_is_a_new_one(spark, monkeypatch):
    queries.checkpoints(spark)
    rng = np.random.default_rng(6)
    rows = [(0, *map(int, rng.integers(0, 64, 3)), int(rng.integers(1, 65536))) for _ in range(20_000)]
    old, new = rows[:-300], [(0, *(a % 9 for a in r[1:4]), r[4]) for r in rows[-300:]]
    frame = lambda part: spark.createDataFrame(part, "c int, x int, y int, z int, v int")
    seen, plain = [], merge.downsample

    def watched(voxels, how):
        seen.append(voxels.count())
        return plain(voxels, how)

    for how in ("second", "first", "mean"):
        before = merge.pyramid(merge.max_merge(frame(old)), 6, how)
        whole = sorted(tuple(r) for r in merge.pyramid(merge.max_merge(frame(old + new)), 6, how).collect())
        with monkeypatch.context() as m:
            m.setattr(merge, "downsample", watched)
            seen.clear()
            assert sorted(tuple(r) for r in merge.refresh(before, 6, how, frame(new)).collect()) == whole
        # nothing but what lies under the 9^3 corner that changed is computed
        assert seen[0] > 0 and all(n <= most for n, most in zip(seen, [10**3, 6**3, 4**3, 8, 8, 8], strict=True))
        assert sorted(tuple(r) for r in merge.refresh(before, 6, how, frame(old[:50])).collect()) == sorted(tuple(r) for r in before.collect())


def test_nothing_is_computed_under_existing_nodes(spark, monkeypatch):
    queries.checkpoints(spark)
    voxels = spark.createDataFrame([(0, x, y, z, 5) for x in range(8) for y in range(8) for z in range(8)], "c int, x int, y int, z int, v int")
    own = spark.createDataFrame([(1, 2, 0, 0, 0, 0, 1, 1, 1, 77)], "level int, side int, nx int, ny int, nz int, c int, x int, y int, z int, v int")
    seen, plain = [], merge.downsample
    monkeypatch.setattr(merge, "downsample", lambda v, how: seen.append(v.count()) or plain(v, how))
    found = merge.pyramid(voxels, 2, "mean", own)
    assert seen == [512 - 64, 56 + 1]
    assert {r.v for r in found.where("level = 1 AND x < 2 AND y < 2 AND z < 2").collect()} == {77}


@pytest.mark.parametrize("cuts", [[], [400], [100, 101, 900]])
def test_the_stream_gives_the_batchs_rates(spark, tmp_path, cuts):
    counters = derived.counters(spark, "/root/testdata/sf0.001").where("node % 7 = 0")
    key = lambda r: tuple(-1 if v is None else v for v in r)
    want = sorted(map(key, logs.node_rates(counters).collect()))
    assert sorted(map(key, rates.replayed(counters, str(tmp_path), cuts).collect())) == want


def test_interfaces_may_come_apart_and_late(spark, tmp_path):
    """A sample's interfaces in different files, files in any order; what is later than the state reaches is sent on as late."""
    rows = [(1, s, i, 10**9 * (s + 1) * (i + 1)) for s in range(6) for i in range(2)]
    schema = "node long, seq long, interface int, rx long"
    for part in ([rows[3], rows[8]], [rows[0], rows[2], rows[9]], rows[4:8] + rows[10:], [rows[1]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
        rates.follow(stream, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    want = logs.node_rates(spark.createDataFrame(rows, schema))
    assert sorted(map(str, rates.rates(spark, str(tmp_path / "out")).collect())) == sorted(map(str, want.collect()))
    for part in ([rows[4], rows[6], rows[8]], [rows[0]]):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in2"))
        rates.follow(spark.readStream.schema(schema).parquet(str(tmp_path / "in2")), str(tmp_path / "out2"), str(tmp_path / "state2"), keep=2).awaitTermination()
    assert [(r.seq, r.rise) for r in spark.read.parquet(str(tmp_path / "out2")).where("late").collect()] == [(0, None)]
