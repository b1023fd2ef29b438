"""Every query with SQL against DuckDB, and the parts against known results."""

import io
import os
import tarfile

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from voxmill import queries
from voxmill.functions import geometry as g
from voxmill.jobs import logs
from voxmill.operators import merge, octree, projection, spatial
from voxmill.oracles import ORACLES
from voxmill.sources import catalog, tiff
from voxmill.streaming import monitor

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in os.listdir(FOLDER):
        con.sql(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


def plain(v):
    if v is None or v != v:
        return ""
    return f"{v:.6g}" if isinstance(v, float) else str(v)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    got = queries.QUERIES[name](spark, FOLDER)
    want = duck.sql(ORACLES[name])
    names = sorted(got.columns)
    assert names == sorted(want.columns)
    rows = sorted(tuple(plain(r[c]) for c in names) for r in got.collect())
    at = [want.columns.index(c) for c in names]
    assert rows == sorted(tuple(plain(r[i]) for i in at) for r in want.fetchall())
    assert rows


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(ORACLES)))
def test_query_without_sql_has_rows(spark, name):
    assert queries.QUERIES[name](spark, FOLDER).count()


def eight_tiles(spark):
    """A cube of 2 x 2 x 2 tiles of 100 um a side."""
    rows = [(i + 1, *(10_000_000 + (i >> k & 1) * 100_000 for k in range(3)), *[100_000] * 3) for i in range(8)]
    return spark.createDataFrame(rows, "id long, ox long, oy long, oz long, sx long, sy long, sz long")


def test_plan_of_eight_tiles(spark):
    tiles = eight_tiles(spark)
    box = tiles.agg(*g.aabb_union())
    levels = box.select(g.nlevels(g.aabb_volume(), (1.0, 1.0, 1.0), 50**3).alias("n")).first().n
    assert levels == 2
    first = round(200 / 4 / 2) * 2
    shape = octree.leaf_shape(spark.createDataFrame([(1, first, first, first)], "g int, ix int, iy int, iz int"), 2).first()
    assert (shape.px, shape.py, shape.pz) == (48, 48, 48)
    nodes = octree.levels(box, levels)
    assert [n.count() for n in nodes] == [1, 8, 64]
    leaf = box.select(*[(F.col(f"s{a}") / 1000 / 4 / 48).alias(a) for a in "xyz"]).first()
    assert abs(leaf.x - 1.0416666) < 1e-6
    hits = spatial.spatial_join(tiles, nodes[-1].select(F.col("path").alias("id"), *g.BOX))
    assert hits.count() == 64 and hits.select("b_id").distinct().count() == 64
    queries.checkpoints(spark)
    assert [r.ntiles for r in spatial.kd_jobs(tiles, box, 500).collect()] == [8]
    assert sorted(r.ntiles for r in spatial.kd_jobs(tiles, box, 1).collect()) == [1] * 8


def test_joins_agree_and_touching_boxes_do_not_hit(spark):
    b = queries.derived.boxes(spark, FOLDER)
    a = {tuple(r) for r in spatial.broadcast_hits(b, b).collect()}
    assert a == {tuple(r) for r in spatial.bucketed_hits(b, b, [100, 60, 8]).collect()} == {tuple(r) for r in spatial.spatial_join(b, b, rows=1).collect()}
    odd = b.unionByName(spark.createDataFrame([(-1, -50, -50, -50, 5000, 7000, 9000), (-2, 3, 3, 3, 1, 4000, 1), (-3, 9, 9, 9, 0, 5, 5)], b.schema))
    assert {tuple(r) for r in spatial.broadcast_hits(odd, odd).collect()} == {tuple(r) for r in spatial.bucketed_hits(odd, odd).collect()}
    two = spark.createDataFrame([(1, 0, 0, 0, 5, 5, 5), (2, 5, 0, 0, 5, 5, 5)], "id long, ox long, oy long, oz long, sx long, sy long, sz long")
    assert {tuple(r) for r in spatial.broadcast_hits(two, two).collect()} == {(1, 1), (2, 2)}


def test_no_side_of_a_join_that_grows_goes_through_the_driver(spark, tmp_path):
    """Cells of boxes and nodes of grids are many times what Spark's estimates say, so neither is broadcast even where it seems small."""
    b = spark.createDataFrame([(i, 3 * i, 0, 0, 5, 5, 5) for i in range(20)], "id long, ox long, oy long, oz long, sx long, sy long, sz long")
    b.write.parquet(f"{tmp_path}/b")
    b = spark.read.parquet(f"{tmp_path}/b")
    hits = spatial.bucketed_hits(b, b)
    nodes = spark.createDataFrame([(t, i, j, k, 10 * t + i, j, k) for t in range(3) for i in (1, 2, 3) for j in (1, 2) for k in (1, 2 + t)], "id long, ix int, iy int, iz int, x long, y long, z long")
    nodes.write.parquet(f"{tmp_path}/nodes")
    nodes = spark.read.parquet(f"{tmp_path}/nodes")
    corners = catalog.corner_nodes(nodes)
    for df in (hits, corners):
        assert "Broadcast" not in df._jdf.queryExecution().executedPlan().toString()
    assert {tuple(r) for r in hits.collect()} == {(i, j) for i in range(20) for j in range(20) if abs(i - j) < 2}
    # grids of different heights, with pages between that have no nodes
    known = {tuple(r) for r in nodes.collect()}
    ends = {t: 2 + t for t in range(3)}
    want = {(t, x, y, z, b, *n[4:]) for n in known for t in [n[0]] for b in range(8) for x, y, z in [(n[1] - (b & 1), n[2] - (b >> 1 & 1), n[3] - (b >> 2))] if 1 <= x < 3 and 1 <= y < 2 and 1 <= z < ends[t]}
    assert len(want) > 40 and {tuple(r) for r in corners.collect()} == want


def test_kd_stops_at_one_origin(spark):
    queries.checkpoints(spark)
    same = spark.createDataFrame([(i, 3, 3, 3, 2, 2, 2) for i in range(9)], "id long, ox long, oy long, oz long, sx long, sy long, sz long")
    got = spatial.kd_jobs(same, same.agg(*g.aabb_union()), 4).collect()
    assert [(r.sx, r.sy, r.sz, r.ntiles) for r in got] == [(1, 1, 1, 9)]


def test_existing_nodes_are_kept(spark):
    queries.checkpoints(spark)
    leaves = spark.createDataFrame([(0, x, y, z, 8) for x in range(8) for y in range(8) for z in range(8)], "c int, x int, y int, z int, v int")
    kept = spark.createDataFrame([(1, 0, 1, 0, 0, 2, 2, 0, 0, 5)], "level int, c int, nx int, ny int, nz int, side int, x int, y int, z int, v int")
    out = {(r.level, r.x, r.y, r.z): r.v for r in merge.pyramid(leaves, 2, "mean", kept).collect()}
    assert out[1, 0, 0, 0] == 8 and out[1, 2, 0, 0] == 5 and (1, 3, 1, 1) not in out
    assert out[0, 1, 0, 0] == 5 // 8 and out[0, 0, 0, 0] == 8


def test_nth_falls_back_to_the_dimmest(spark):
    rows = [(0, 0, 0, 0, 9), (0, 1, 0, 0, 4), (0, 0, 1, 0, 0), (0, 2, 0, 0, 0)]
    v = spark.createDataFrame(rows, "c int, x int, y int, z int, v int")
    assert {r.x: r.v for r in merge.downsample(v, "nth_nonzero").collect()} == {0: 4, 1: 0}


@pytest.mark.parametrize("steps", [1, 2, 5, None])
def test_jobs_are_those_of_plain_halving(spark, steps):
    """However many halvings a round takes."""
    queries.checkpoints(spark)
    rng = np.random.default_rng(2)
    rows = [(i, *(int(rng.integers(0, m)) for m in (37, 500, 64)), 1, 1, 1) for i in range(400)] + [(900 + i, 3, 3, 3, 1, 1, 1) for i in range(30)]
    tiles = spark.createDataFrame(rows, "id long, ox long, oy long, oz long, sx long, sy long, sz long")

    def halve(box, inside):
        if len(inside) <= 20 or max(box[3:]) == 1:
            return [(*box, len(inside))] if inside else []
        a = int(np.argmax(box[3:]))
        low, cut = list(box), box[a] + box[3 + a] // 2
        high = list(box)
        low[3 + a], high[a], high[3 + a] = box[3 + a] // 2, cut, box[3 + a] - box[3 + a] // 2
        return halve(low, [t for t in inside if t[a] < cut]) + halve(high, [t for t in inside if t[a] >= cut])

    root = (0, 0, 0, 37, 500, 64)
    box = spark.createDataFrame([root], ", ".join(f"{c} long" for c in g.BOX))
    got = sorted(tuple(r[c] for c in (*g.BOX, "ntiles")) for r in spatial.kd_jobs(tiles, box, 20, steps=steps).collect())
    assert got == sorted(map(tuple, halve(list(root), [r[1:4] for r in rows])))


def test_tiff_round_trip():
    stack = np.arange(2 * 3 * 5, dtype=np.uint16).reshape(2, 3, 5) * 2000
    assert np.array_equal(tiff.decode(tiff.encode(stack)), stack)
    with pytest.raises(ValueError):
        tiff.decode(b"II\0\0" + bytes(20))


def test_blur_keeps_a_flat_image(spark):
    flat = spark.createDataFrame([(x, y, 700) for x in range(12) for y in range(9)], "x int, y int, p int")
    out = projection.pixels_of(projection.resized(projection.image_bricks(flat), 12, 9, 4, 3)).collect()
    assert len(out) == 12 and {r.p for r in out} == {700}


def weights(n, m):
    """[target, cell] by the definition: blur each cell with a bell cut at four sigmas and renormalised, then interpolate."""
    ratio, cells = n / m, np.arange(n)
    sigma = 0.75 * ratio
    blur = np.exp(-(((cells[:, None] - cells) / sigma) ** 2) / 2) * (abs(cells[:, None] - cells) <= int(4 * sigma + 0.5))
    blur /= blur.sum(1, keepdims=True)
    at = np.clip((np.arange(m) + 0.5) * ratio - 0.5, 0, n - 1)
    low = np.floor(at).astype(int)
    return (1 - at + low)[:, None] * blur[low] + (at - low)[:, None] * blur[np.minimum(low + 1, n - 1)]


@pytest.mark.parametrize(("width", "height", "new"), [(150, 90, (150, 90)), (150, 90, (50, 31)), (200, 70, (3, 2)), (65, 130, (80, 140)), (5, 200, (1, 9))])
def test_blur_by_bricks_is_a_blur_of_the_whole(spark, width, height, new):
    image = np.random.default_rng(width).integers(0, 65536, (width, height)) * (np.random.default_rng(1).random((width, height)) < 0.3)
    pixels = spark.createDataFrame([(int(x), int(y), int(image[x, y])) for x, y in np.argwhere(image)], "x int, y int, p int").repartition(4)
    got = np.zeros(new, int)
    for r in projection.pixels_of(projection.resized(projection.image_bricks(pixels), width, height, *new)).collect():
        got[r.x, r.y] = r.p
    want = weights(width, new[0]) @ image @ weights(height, new[1]).T
    assert abs(got - want).max() <= 0.5 + 1e-6


def test_a_wide_blur_sends_few_rows(spark):
    """What a brick sends on follows from the ratio of sizes, not from the blur's reach."""
    taps = projection.Taps(10_000, 50)
    assert taps.reach == 600 and all(len(taps.of(s, 64)[1]) <= 64 / taps.ratio + 8 for s in range(0, 10_000, 64))


def test_catalogue(spark, tmp_path):
    text = "path: /data\ntiles:\n" + "".join(
        f"- path: /00/0000{i}\n  aabb: {{ori: [{i}, 2, 3], shape: [10, 10, 10]}}\n  shape: {{type: u16, dims: [16, 32, 64, 1]}}\n"
        f"  grid: {{xlims: [0, 7, {14 if i == 1 else 13}], ylims: [0, 31], zlims: [0, {63 if i < 3 else 64}], coordinates: [1, 2, 3]}}\n"
        for i in (1, 2, 3)
    )
    (tmp_path / "c.yml").write_text(text)
    cache = str(tmp_path / "c.parquet")
    for _ in range(2):
        got = catalog.read_yaml(spark, str(tmp_path / "c.yml"), cache).select("id", "sx", catalog.violations().alias("bad")).orderBy("id").collect()
        assert [(r.id, r.sx, r.bad) for r in got] == [(1, 10, []), (2, 10, ["xlims_even"]), (3, 10, ["xlims_even", "zlims_inside"])]


def test_a_catalogue_is_parsed_in_parts(spark, tmp_path):
    """Ids follow the file's order, wherever it is split."""
    item = "- path: /t/{0}\n  aabb: {{ori: [{0}, 2, 3], shape: [10, 10, 10]}}\n  shape: {{type: u16, dims: [16, 32, 64, 1]}}\n  grid:\n    xlims:\n    - 0\n    - 7\n    ylims: [0, 31]\n    zlims: [0, 63]\n    coordinates: [1, 2, 3]\n"
    (tmp_path / "c.yml").write_text("path: /data\ntiles:\n" + "".join(item.format(i) for i in range(1, 801)))
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        for k, v in zip(before, ("10000", "1"), strict=True):
            spark.conf.set(k, v)
        tiles = catalog.read_yaml(spark, str(tmp_path / "c.yml"))
        got = tiles.orderBy("id").select("id", "ox", "path", "xlims").collect()
        assert spark.read.text(str(tmp_path / "c.yml")).rdd.getNumPartitions() > 8
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [(r.id, r.ox, r.path, r.xlims) for r in got] == [(i, i, f"/t/{i}", [0, 7]) for i in range(1, 801)]


def test_log_archive_and_stream(spark, tmp_path):
    lines = ["[ Info: PEON: merging multiple took 1.50 sec", "nothing", "[ WARNING: x"]
    with tarfile.open(tmp_path / "l.tar.gz", "w:gz") as tar:
        raw = "\n".join(lines).encode()
        info = tarfile.TarInfo("a.log")
        info.size = len(raw)
        tar.addfile(info, io.BytesIO(raw))
    profile = logs.stage_profile(logs.read_archive(spark, str(tmp_path / "l.tar.gz"))).collect()
    assert sorted((r.category, r.n, r.q50) for r in profile) == [("merging", 1, 1.5), ("merging multiple", 1, 1.5)]
    (tmp_path / "logs").mkdir()
    (tmp_path / "logs" / "b.log").write_text("\n".join(lines))
    assert logs.log_counts(logs.read_archive(spark, str(tmp_path / "logs"))).first().warnings == 1
    q = monitor.watch(spark, str(tmp_path / "logs"), "seen", 1)
    q.processAllAvailable()
    q.stop()
    assert [(r.file, r.warnings) for r in spark.table("seen").collect()] == [("b.log", 1)]


def test_human_readable(spark):
    got = spark.createDataFrame([(k,) for k in (5, 999, 1000, 65432, 1234567, 9876543210)], "k long").select(g.human_readable(F.col("k")).alias("h"))
    assert [r.h for r in got.collect()] == ["5B", "999B", "1M", "65M", "1G", "9T"]
