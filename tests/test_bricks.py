"""Dense bricks against sparse voxels, and scan conversion against every point of a leaf."""

import time
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from voxmill import queries
from voxmill.operators import bricks, merge, resample

FOLDER = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def some_voxels(spark, n=4000, span=50):
    rng = np.random.default_rng(3)
    rows = [(int(c), *map(int, at), int(v)) for c, at, v in zip(rng.integers(0, 2, n), rng.integers(0, span, (n, 3)), rng.integers(0, 65536, n), strict=True)]
    return spark.createDataFrame(rows, "c int, x int, y int, z int, v int").repartition(5)


def test_bricks_hold_what_voxels_do(spark):
    v = some_voxels(spark)
    want = rows_of(merge.max_merge(v).where("v > 0"))
    assert rows_of(bricks.unpack(bricks.merged(bricks.pack(v)))) == want
    assert rows_of(bricks.unpack(bricks.pack(v.limit(0)))) == []
    table = bricks.Table(bricks._kinds(v, ("c",))[1])
    rows = v.toPandas()
    for at in range(0, len(rows), 600):
        part = rows.iloc[at : at + 600]
        table.add(part.c.to_numpy(), [(0,), (1,)], [part[a].to_numpy() for a in "xyz"], part.v.to_numpy().astype(np.uint16))
    out = table.taken()
    assert out.num_rows == len({(r.c, r.x // 16, r.y // 16, r.z // 16) for r in rows.itertuples()}) and not len(table)
    brick, at, value = bricks.lit(bricks.as_cells(out.column("data").slice(1)))
    place = [out.column(p).to_numpy()[1:][brick] * 16 + a for p, a in zip(bricks.PLACE, at, strict=True)]
    got = set(zip(out.column("c").to_numpy()[1:][brick].tolist(), *[p.tolist() for p in place], value.tolist(), strict=True))
    first = [out.column(p)[0].as_py() for p in ("c", *bricks.PLACE)]
    assert got == {r for r in want if [r[0], *(a // 16 for a in r[1:4])] != first}


def test_a_brick_is_shuffled_once_a_task(spark):
    """All voxels of a task that lie in one brick go out as one row."""
    v = spark.range(0, 60_000, 1, 4).select(F.lit(0).alias("c"), (F.col("id") % 16).cast("int").alias("x"), (F.col("id") % 7).cast("int").alias("y"), (F.col("id") % 5).cast("int").alias("z"), (F.col("id") % 65536).cast("int").alias("v"))
    assert bricks.pack(v).count() == 4
    assert bricks.merged(bricks.pack(v)).count() == 1


@pytest.mark.parametrize("how", ["first", "mean", "second", "nth_nonzero"])
def test_reducers_are_those_of_voxels(spark, how):
    v = some_voxels(spark, 9000, 40)
    merged = merge.max_merge(v)
    got = rows_of(bricks.unpack(bricks.merged(bricks.halved(bricks.merged(bricks.pack(v)), how))))
    assert got == rows_of(merge.downsample(merged, how).where("v > 0"))


def test_a_users_reducer_and_all_levels(spark):
    queries.checkpoints(spark)
    v = some_voxels(spark, 9000, 40)
    spread = lambda cubes: cubes.max(-1) - cubes.min(-1)
    levels = bricks.pyramid(bricks.merged(bricks.pack(v)), 3, spread)
    dense = np.zeros((2, 48, 48, 48), np.int64)
    for c, x, y, z, value in rows_of(merge.max_merge(v)):
        dense[c, x, y, z] = value
    for level in reversed(range(3)):
        n = dense.shape[1] // 2
        dense = dense.reshape(2, n, 2, n, 2, n, 2).transpose(0, 1, 3, 5, 2, 4, 6).reshape(2, n, n, n, 8)
        dense = dense.max(-1) - dense.min(-1)
        want = sorted((*map(int, at), int(dense[tuple(at)])) for at in np.argwhere(dense))
        assert rows_of(bricks.unpack(levels[level])) == want
    assert {r.level for r in bricks.at_level(levels).select("level").distinct().collect()} == {0, 1, 2, 3}


def test_nodes_go_up_into_their_octants(spark):
    """A node's side needs not divide by a brick's, nor its half be even."""
    side = (22, 6, 34)
    rng = np.random.default_rng(8)
    rows = [(f"{a}/{b}", *(int(rng.integers(0, s)) for s in side), int(rng.integers(1, 65536))) for a in (1, 8) for b in range(1, 9) for _ in range(300)]
    v = spark.createDataFrame(rows, "path string, x int, y int, z int, v int")
    up = bricks.unpack(bricks.merged(bricks.halved(bricks.merged(bricks.pack(v, ("path",)), ("path",)), "mean", ("path",), ("path", side)), ("path",)), ("path",))
    dense = {a: np.zeros((44, 12, 68), np.int64) for a in "18"}
    for path, x, y, z, value in rows:
        d = int(path[-1]) - 1
        at = (x + (d & 1) * 22, y + (d >> 1 & 1) * 6, z + (d >> 2 & 1) * 34)
        dense[path[0]][at] = max(dense[path[0]][at], value)
    want = []
    for a, whole in dense.items():
        small = whole.reshape(22, 2, 6, 2, 34, 2).sum((1, 3, 5)) >> 3
        want += [(a, *map(int, at), int(small[tuple(at)])) for at in np.argwhere(small)]
    assert rows_of(up) == sorted(want)


def test_solo_bricks_are_not_shuffled(spark):
    rows = [(0, x, 0, 0, 10 + s, s) for s in range(3) for x in range(40 * s, 40 * s + 60)]
    v = spark.createDataFrame(rows, "c int, x int, y int, z int, v int, src int")
    cut = v.withColumn("band", F.floor(F.col("x") / 16).cast("int"))
    sources = cut.groupBy("band").agg((F.count_distinct("src") > 1).alias("shared"))
    parts = bricks.pack(cut.join(sources, "band").coalesce(1), ("c", "shared", "src")).select("c", *bricks.PLACE, "data", "shared")
    seen = Observation("shuffled")
    counted = parts.where("shared").observe(seen, F.count("*").alias("n")).unionByName(parts.where("NOT shared"))
    got = rows_of(bricks.unpack(bricks.merged_but_solo(counted, "shared")))
    assert got == rows_of(merge.max_merge(v))
    shared = {x // 16 for _, x, *_, s in rows if {t for _, y, *_, t in rows if y // 16 == x // 16} - {s}}
    assert seen.get["n"] == 2 * len(shared) < parts.count()


def inside(corners, turn, point, eps=1e-6):
    """The unit position of a point, by the shares in each tetrahedron in turn; None outside of all."""
    for tet in resample.TETRAHEDRA[turn]:
        p = corners[list(tet)]
        edges = (p[1:] - p[0]).T
        if abs(np.linalg.det(edges)) < 1e-12:
            continue
        tail = np.linalg.solve(edges, point - p[0])
        share = np.append(1 - tail.sum(), tail)
        if (share >= -eps).all():
            return np.clip(share @ resample.CORNERS[list(tet)], 0, 1)
    return None


@pytest.mark.parametrize("mode", ["nearest", "linear"])
def test_scan_conversion_is_a_test_of_every_point(mode, monkeypatch):
    rng = np.random.default_rng(11)
    n, pixels = 12, (9, 7, 11)
    shape = rng.integers(1, 6, (n, 3))
    corners = resample.CORNERS * rng.uniform(2, 12, (n, 1, 3)) + rng.uniform(-4, 6, (n, 1, 3)) + rng.uniform(-0.7, 0.7, (n, 8, 3))
    corners[0, :, 2] = 3  # flat
    corners[1] = resample.CORNERS * np.array(pixels)
    turned = rng.integers(0, 2, n).astype(bool)
    data = rng.integers(0, 65536, int(shape.prod(1).sum())).astype(np.uint16)
    start = np.append(0, np.cumsum(shape.prod(1)))[:-1]
    want = np.zeros((n, *pixels), np.int64)
    for i in range(n):
        block = data[start[i] : start[i] + shape[i].prod()].reshape(shape[i][::-1]).transpose(2, 1, 0)
        for at in np.ndindex(pixels):
            t = inside(corners[i], 90 if turned[i] else 0, np.array(at, float))
            if t is None:
                continue
            if mode == "nearest":
                low, high = np.maximum(np.ceil(t * shape[i] - 1e-9) - 1, 0).astype(int), np.minimum(np.floor(t * shape[i] + 1e-9).astype(int), shape[i] - 1)
                want[i][at] = block[tuple(slice(a, b + 1) for a, b in zip(low, high, strict=True))].max()
            else:
                q = np.clip(t * shape[i] - 0.5, 0, shape[i] - 1)
                low = np.minimum(np.floor(q), np.maximum(shape[i] - 2, 0)).astype(int)
                value = 0.0
                for b in resample.CORNERS.astype(int):
                    value += np.where(b == 1, q - low, 1 - q + low).prod() * block[tuple(np.minimum(low + b, shape[i] - 1))]
                want[i][at] = int(np.floor(value + 0.5 + 1e-6))
    for piece in (7, 1 << 18):
        monkeypatch.setattr(resample, "ROWS", piece)
        monkeypatch.setattr(resample, "PIXELS", piece)
        got = np.zeros_like(want)
        for pair, at, v in resample.covered(corners, turned, data, start, shape, pixels, mode):
            np.maximum.at(got, (pair, *at), v)
        assert np.array_equal(got, want)


def test_a_large_leaf_needs_little_memory():
    """120 million pixels, one sub-tile: what is held is bounded by the pieces."""
    pixels = (600, 500, 400)
    corners = (resample.CORNERS * np.array(pixels) * 0.999 + 0.2)[None]
    corners[0, 0] += 1.5
    shape = np.array([[64, 64, 64]])
    data = np.arange(64**3, dtype=np.uint16) | np.uint16(1)
    tracemalloc.start()
    start, total = time.perf_counter(), 0
    for _, at, _ in resample.covered(corners, np.array([False]), data, np.array([0]), shape, pixels, "nearest"):
        total += len(at[0])
        if time.perf_counter() - start > 20:
            break
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total > 5_000_000 and peak < 1 << 29
