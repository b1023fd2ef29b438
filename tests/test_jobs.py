"""Whole jobs on a cube of eight tiles, whose results follow from arithmetic."""

import json
import os

import numpy as np
import pytest

from voxmill import queries
from voxmill.config import EngineConfig, ProjectionConfig
from voxmill.jobs import octrees, project
from voxmill.operators import bricks, projection
from voxmill.sources import catalog, stacks, tiff

DIMS = (16, 32, 64)


def cube_of_tiles(folder, channels=1):
    """2 x 2 x 2 tiles of 100 um a side; three planes of light in each, mirrored so that they form a hollow cube, half as bright in each further channel. Returns the catalogue's path."""
    one = np.zeros(DIMS, np.uint16)
    one[3, 3:, 3:] = one[3:, 3, 3:] = one[3:, 3:, 3] = 0xFFFF
    text = "path: x\ntiles:\n"
    for i in range(8):
        bits = [i >> k & 1 for k in range(3)]
        at = [10_000_000 + b * 100_000 for b in bits]
        block = one[tuple(slice(None, None, -1) if b else slice(None) for b in bits)]
        place = f"{folder}/tiles/00/0000{i + 1}"
        os.makedirs(place)
        for c in range(channels):
            with open(f"{place}/0000{i + 1}-cube.{c}.tif", "wb") as f:
                f.write(tiff.encode(block.transpose(2, 0, 1) >> c))
        corners = [at[k] + (b >> k & 1) * 100_000 for b in range(8) for k in range(3)]
        text += f"- path: /00/0000{i + 1}\n  aabb: {{ori: {at}, shape: [100000, 100000, 100000]}}\n  shape: {{type: u16, dims: [16, 32, 64, {channels}]}}\n"
        text += f"  grid: {{xlims: [0, 15], ylims: [0, 31], zlims: [0, 63], coordinates: {corners}}}\n"
    with open(f"{folder}/tiles.yml", "w") as f:
        f.write(text)
    return f"{folder}/tiles.yml"


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    """The octree of three channels, below a URI."""
    folder = str(tmp_path_factory.mktemp("cube"))
    queries.checkpoints(spark)
    path = cube_of_tiles(folder, 3)
    p = octrees.build(spark, EngineConfig(max_pixels_per_leaf=50**3, max_tilechannels_per_job=500, nchannels=3), path, f"file:{folder}/tiles", f"file:{folder}/out")
    return folder, p


def images(folder):
    return sorted(os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".tif"))


def image(path):
    return tiff.decode(open(path, "rb").read())


def test_every_node_is_written(built, spark):
    folder, _ = built
    found = images(f"{folder}/out")
    assert len(found) == 3 * (64 + 8 + 1)
    assert all(image(f).shape == (48, 48, 48) for f in found[:5])
    assert open(f"{folder}/out/transform.txt").read().endswith("nl: 3\n")
    assert [r.ntiles for r in spark.read.parquet(f"{folder}/out/jobs.parquet").collect()] == [8]
    assert spark.read.parquet(f"{folder}/out/tiles.parquet").count() == 8
    known = json.load(open(f"{folder}/out/calculated_parameters.json"))
    assert known["leaf_px"] == [48, 48, 48] and known["downsampling"] == "first" and known["version"]


def test_root_shows_the_cube(built):
    folder, _ = built
    for c in range(3):
        root = image(f"{folder}/out/default.{c}.tif").transpose(1, 2, 0)
        lit = [np.flatnonzero(root.any(axis=tuple({0, 1, 2} - {k}))) + 1 for k in range(3)]
        assert [(v.min(), v.max()) for v in lit] == [(6, 44), (4, 46), (3, 47)]
        assert set(np.unique(root)) == {0, 0xFFFF >> c}


def test_linear_interpolation_has_shades(spark, tmp_path):
    path = cube_of_tiles(str(tmp_path))
    octrees.build(spark, EngineConfig(max_pixels_per_leaf=50**3, max_tilechannels_per_job=500, interpolation="linear"), path, f"{tmp_path}/tiles", f"{tmp_path}/out")
    found = images(f"{tmp_path}/out")
    assert len(found) == 73 and max(len(np.unique(image(f))) for f in found) > 2


def test_upper_levels_from_leaf_images(built, spark):
    folder, p = built
    listed = tiff.listing(spark, f"{folder}/out")
    assert {r.level: r["count"] for r in listed.groupBy("level").count().collect()} == {0: 3, 1: 24, 2: 192}
    assert tiff.listing(spark, f"{folder}/out", 1).select("path").distinct().count() == 8
    names = [f"{folder}/out/default.0.tif", f"{folder}/out/5/default.2.tif"]
    before = [open(n, "rb").read() for n in names]
    for n in names:
        os.remove(n)
    octrees.rebuild_upper(spark, EngineConfig(nchannels=3), p, f"{folder}/out")
    assert [open(n, "rb").read() for n in names] == before


def test_coronal_projection_at_four_sizes(built, spark):
    folder, p = built
    config = ProjectionConfig(signal_channel=0, reference_channel=1, output_pixel_sizes_um=(1, 3, 10, 30))
    names = project.project(spark, f"{folder}/out", p, config, f"file://{folder}/coronal")
    assert names == ["tiles/projection-192x192", "projection-200x200-1um", "projection-67x67-3um", "projection-20x20-10um", "projection-7x7-30um"]
    assert len(images(f"{folder}/coronal")) == 5
    found = image(f"{folder}/coronal/tiles/projection-192x192.0.tif")[0]
    for axis, (first, last) in ((1, (10, 184)), (0, (19, 175))):  # rows are y, columns x
        lit = np.zeros(192, int)
        lit[first - 1 : last] = 0x8000
        assert found.max(axis).tolist() == lit.tolist()
    assert image(f"{folder}/coronal/projection-20x20-10um.0.tif").any()


@pytest.mark.parametrize("axis", [1, 2, 3])
@pytest.mark.parametrize("function", ["max", "p999", "median_max", "second", "mean of mine"])
def test_projections_of_sparse_leaves(spark, axis, function):
    """Along each axis, by each function: missing leaves close up, a leading gap shifts the crop, and the crop begins at the origin."""
    queries.checkpoints(spark)
    side, rng = (6, 10, 18), np.random.default_rng(axis)
    names = ["11", "15", "12", "28", "44", "88", "84", "51"]
    rows, dense = [], {n: np.zeros((2, *side), int) for n in names}
    for n in names[:-1]:  # the last is dark
        for c, x, y, z in zip(rng.integers(0, 2, 300), *(rng.integers(0, s, 300) for s in side), strict=True):
            v = int(rng.integers(1, 65536))
            rows.append(("/".join(n), int(c), int(x), int(y), int(z), v))
            dense[n][c, x, y, z] = max(v, dense[n][c, x, y, z])
    leaves = bricks.merged(bricks.pack(spark.createDataFrame(rows, "path string, c int, x int, y int, z int, v int"), octrees.NODE), octrees.NODE)
    there = spark.createDataFrame([("/".join(n),) for n in names], "path string")
    p = octrees.Plan((5000, 6000, 7000), (1, 1, 1), 2, side, (0.5, 0.25, 2.0))
    a = axis - 1
    lo_um, hi_um = p.origin[a] / 1000 + 2 * p.voxel_um[a], p.origin[a] / 1000 + 3.2 * side[a] * p.voxel_um[a]
    own = lambda d, crop: d[:, crop].mean(1)
    config = ProjectionConfig(axis=axis, function=own if " " in function else function, crop_um=(lo_um, hi_um), signal_levels=(100.0, 60000.0), reference_levels=(5.0, 65000.0))
    got = {(r.x, r.y): r.p for r in projection.pixels_of(project.project_leaves(leaves, there, p, config)).collect()}

    bit = lambda n, k: sum((int(d) - 1 >> k & 1) << (1 - i) for i, d in enumerate(n))
    across = [k for k in range(3) if k != a]
    want = {}
    for u in range(4):
        for v in range(4):
            face = sorted((bit(n, a), n) for n in names if (bit(n, across[0]), bit(n, across[1])) == (u, v))
            if not face:
                continue
            gap = face[0][0]
            low, high = max(1, round(2.0) - gap * side[a]), min(len(face) * side[a], round(3.2 * side[a]) - gap * side[a])
            if low > high:
                continue
            lines = np.concatenate([dense[n].transpose(0, *[k + 1 for k in across], a + 1) for _, n in face], -1).reshape(2, -1, len(face) * side[a])
            s, r = (np.float32(65535) * np.clip((lines[c].astype(np.float32) - np.float32(b)) / np.float32(w - b), 0, 1) for c, (b, w) in enumerate((config.signal_levels, config.reference_levels)))
            d, crop = s - r, slice(low - 1, high)
            padded = np.pad(d, ((0, 0), (2, 2)), "edge")
            value = {
                "max": lambda: d[:, crop].max(1), "p999": lambda: np.quantile(d[:, crop].astype(float), 0.999, axis=1), "mean of mine": lambda: own(d, crop),
                "median_max": lambda: np.stack([padded[:, k : k + d.shape[1]] for k in range(5)]),
                "second": lambda: np.array([sorted([*x[crop], 0, 0])[-2] for x in d]),
            }[function]()
            value = np.median(value, axis=0)[:, crop].max(1) if function == "median_max" else value
            for k, one in enumerate(np.clip(value, 0, 65535)):
                want[u * side[across[0]] + k // side[across[1]], v * side[across[1]] + k % side[across[1]]] = one
    assert set(got) <= set(want)
    assert max(abs(got.get(k, 0) - w) for k, w in want.items()) <= 0.51 and any(got.values())


def test_tiles_with_nested_paths_keep_their_own_stacks(spark, tmp_path):
    """One tile's path may end in another's."""
    tiles = spark.createDataFrame([(1, "/1", [0, 1], [0, 1], [0, 1]), (2, "/2/1", [0, 1], [0, 1], [0, 1])], "id long, path string, xlims array<int>, ylims array<int>, zlims array<int>")
    for path, v in (("1", 7), ("2/1", 9)):
        os.makedirs(tmp_path / path, exist_ok=True)
        (tmp_path / path / "x.0.tif").write_bytes(tiff.encode(np.full((2, 2, 2), v, np.uint16)))
    found = octrees.blocks(octrees.pieces(stacks.load(spark, str(tmp_path), 30), tiles))
    assert {r.id: set(np.frombuffer(r.block, "<u2").tolist()) for r in found.collect()} == {1: {7}, 2: {9}}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan
    os.remove(tmp_path / "2/1/x.0.tif")
    (tmp_path / "2/1/x.0.tif").write_bytes(tiff.encode(np.full((1, 2, 2), 3, np.uint16)))
    with pytest.raises(Exception, match="1 of its 2 pages"):
        octrees.blocks(octrees.pieces(stacks.load(spark, str(tmp_path)), tiles)).count()


def test_the_leaf_shape_search_begins_at_an_even_shape(spark):
    """Whatever the sides must divide by."""
    tiles = spark.createDataFrame([(1, 0, 0, 0, 90_000, 70_000, 50_000)], "id long, ox long, oy long, oz long, sx long, sy long, sz long")
    p = octrees.plan(tiles, EngineConfig(leaf_dim_divisible_by=8, max_pixels_per_leaf=10**9))
    shapes = [(x, y, z) for x in range(8, 200, 8) for y in range(8, 200, 8) for z in range(8, 200, 8) if x * y * z % 4096 == 0]
    cost = lambda s: (abs(s[0] - 90) + abs(s[1] - 70) + abs(s[2] - 50), s)
    assert p.leaf_px == min(shapes, key=cost)


@pytest.mark.parametrize("function", ["max", "median_max"])
def test_lines_are_no_longer_than_the_crop(spark, monkeypatch, function):
    """A stack of 300 leaves of which 20 pixels are in the crop: known functions see these and what they look at beyond, not 4,800."""
    plain, reach = projection.PROJECTIONS[function], projection.REACH[function]

    def checked(d, crop):
        assert d.shape[1] <= 20 + 2 * reach
        return plain(d, crop)

    monkeypatch.setitem(projection.PROJECTIONS, function, checked)
    rows = [("%03d" % n, 0, 3, 4, z, 1000 + n) for n in range(300) for z in range(16)]
    leaves = bricks.pack(spark.createDataFrame(rows, "path string, c int, x int, y int, z int, v int").repartition(1), octrees.NODE)
    stack = spark.createDataFrame([("%03d" % n, 0, 0, n, 300, 1601, 1620) for n in range(300)], "path string, u int, v int, nth int, n int, low int, high int")
    config = ProjectionConfig(axis=3, function=function, signal_levels=(0.0, 65535.0), reference_levels=(0.0, 65535.0))
    got = projection.pixels_of(projection.project_bricks(bricks.merged(leaves, octrees.NODE), stack, config, (16, 16, 16))).collect()
    assert [tuple(r) for r in got] == [(3, 4, 1101)]


def test_a_large_image_is_written_in_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(project, "PART", 64)
    pixels = spark.createDataFrame([(x, y, 300 * x + y + 1) for x in range(100) for y in range(0, 130, 3)], "x int, y int, p int")
    names = project.save_image(projection.image_bricks(pixels), 100, 130, str(tmp_path), "i")
    assert len(names) == 6
    whole = np.zeros((192, 128), int)
    for n in names:
        i, j = map(int, n.split("-")[1:])
        whole[64 * i : 64 * i + 64, 64 * j : 64 * j + 64] = image(f"{tmp_path}/{n}.0.tif")[0]
    assert all(whole[y, x] == 300 * x + y + 1 for x in range(100) for y in range(0, 130, 3)) and np.count_nonzero(whole) == 100 * 44


def test_a_catalogue_that_breaks_rules_is_refused(spark, tmp_path):
    path = cube_of_tiles(str(tmp_path))
    text = open(path).read()
    open(path, "w").write(text.replace("xlims: [0, 15]", "xlims: [0, 14]", 1))
    assert [r.rule for r in catalog.shared_violations(catalog.read_yaml(spark, path)).where("broken").collect()] == ["same_xlims"]
    with pytest.raises(ValueError, match="same_xlims"):
        octrees.build(spark, EngineConfig(), path, f"{tmp_path}/tiles", f"{tmp_path}/out")


# A volume's box, and the boxes and depth limits of the four tiles that begin in its fifth octant.
VOLUME = ((70551120, 15797574, 27758350), (907936, 1284087, 495350))
INSIDE = {
    13: ((70551120, 15798190, 28025700), (355789, 470072, 228000), (15, 25, 235, 245)),
    14: ((70833960, 15797574, 28071150), (349352, 462059, 165550), (61, 66, 189, 228)),
    16: ((70551120, 16204933, 28025700), (355142, 470028, 227500), (15, 25, 235, 245)),
    17: ((70833400, 16205684, 28073650), (350847, 461036, 164550), (63, 68, 189, 230)),
}


def test_half_filled_tiles_are_planned_as_known(spark, tmp_path):
    """155 nodes: leaves, leaf and tile pairs, and leaves of one tile of a region of overlapping tiles, whose x and y run backwards."""
    queries.checkpoints(spark)
    xlims, ylims = [0, 255, 510, 765, 1020], [0, 383, 766, 1149, 1532]
    text = "path: x\ntiles:\n"
    for n, (ori, shape, z) in {1: (*VOLUME, (15, 25, 235, 245)), **INSIDE}.items():
        coordinates = [(ori[0] + shape[0] - shape[0] * i // 4, ori[1] + shape[1] - shape[1] * j // 4, ori[2] + shape[2] * (k - z[0]) // (z[3] - z[0])) for k in z for j in range(5) for i in range(5)]
        text += f"- path: /00/{n:05d}\n  aabb:\n    ori: {list(ori)}\n    shape: {list(shape)}\n  shape:\n    type: u16\n    dims: [1024, 1536, 251, 1]\n  homography: []\n"
        text += f"  grid:\n    xlims: {xlims}\n    ylims: {ylims}\n    zlims: {list(z)}\n    coordinates: {[v for c in coordinates for v in c]}\n"
    (tmp_path / "tiles.yml").write_text(text)
    tiles = catalog.read_yaml(spark, str(tmp_path / "tiles.yml"))
    config = EngineConfig(voxelsize_um=(0.25, 0.25, 1.0), roi_origin=(0.0, 0.0, 0.5), roi_size=(0.5, 0.5, 0.5))
    p = octrees.plan(tiles, config)
    assert (p.nlevels, p.leaf_px, p.origin) == (3, (454, 640, 64), VOLUME[0])
    own = octrees.assigned(tiles, config)
    assert sorted(r.path for r in own.collect()) == [f"/00/{n:05d}" for n in INSIDE]
    box = spark.createDataFrame([(*p.origin, *p.shape)], ", ".join(f"{c} long" for c in octrees.BOX))
    nodes = octrees.nodes_of(own, box, p.nlevels).checkpoint()
    assert catalog.subtiles(catalog.grid_nodes(own)).count() == 192 and nodes.select("path").distinct().count() == 155
    per_leaf = nodes.where("level = 3").groupBy("path").count()
    assert (per_leaf.count(), per_leaf.agg({"count": "sum"}).first()[0], per_leaf.where("count = 1").count()) == (132, 196, 80)


def test_users_readers_and_writers(spark, tmp_path):
    """Stacks may come from, and go to, whatever a user's functions read and write."""
    queries.checkpoints(spark)
    path = cube_of_tiles(str(tmp_path))
    stacks.load(spark, f"{tmp_path}/tiles").write.parquet(f"{tmp_path}/pages")
    p = octrees.build(
        spark, EngineConfig(max_pixels_per_leaf=50**3, read_stacks=lambda s, folder: s.read.parquet(folder), write_stacks=lambda pages, folder: pages.write.parquet(f"{folder}/nodes")),
        path, f"{tmp_path}/pages", f"{tmp_path}/out",
    )
    found = spark.read.parquet(f"{tmp_path}/out/nodes")
    assert p.nlevels == 2 and found.select("path", "c").distinct().count() == 73 and not images(f"{tmp_path}/out")
    lit = stacks.voxels(found.where("path = 'default'")).collect()
    assert [(min(c), max(c)) for c in ([r.x + 1 for r in lit], [r.y + 1 for r in lit], [r.z + 1 for r in lit])] == [(6, 44), (4, 46), (3, 47)]
