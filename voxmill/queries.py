"""One query per operator of the volume engine, each over relations derived from whole tables."""

from __future__ import annotations

import re
import tempfile
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxmill.config import ProjectionConfig
from voxmill.functions import geometry as g
from voxmill.functions.geometry import AXES, BOX
from voxmill.jobs import logs, octrees, project
from voxmill.operators import bricks, merge, octree, projection, quantiles, regions, resample, spatial
from voxmill.sources import catalog, derived, stacks, tiff
from voxmill.streaming import rates

VOXEL_UM = (0.002, 0.002, 0.002)
MAX_PIXELS = 20_000
DEPTH = 2
CROP = (2, 13)
LEVELS = ((1000.0, 50000.0), (2000.0, 60000.0))
JOB_TILES = 120


def checkpoints(spark: SparkSession) -> None:
    """Loops checkpoint to the folder of spark.checkpoint.dir; only in one process, and where that is unset, is one made here."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(folder or f"file://{tempfile.mkdtemp(prefix='voxmill-')}")


def _bbox(spark, d):
    return derived.boxes(spark, d).agg(*g.aabb_union())


def _leaves(spark, d):
    return octree.levels(_bbox(spark, d), DEPTH)[-1]


def _pairs(spark, d):
    """Leaf and tile overlaps; the 8^DEPTH leaves are the checked side."""
    leaves = _leaves(spark, d)
    hits = spatial.spatial_join(derived.boxes(spark, d), leaves.select(F.col("morton").alias("id"), *BOX))
    return hits.select(F.col("a_id").alias("id"), F.col("b_id").alias("morton"))


def tile_catalog(spark, d):
    t = derived.tiles(spark, d)
    return t.select("id", "path", *BOX, F.concat_ws(",", "dims").alias("dims"), F.concat_ws(",", "zlims").alias("zlims"))


def shared_place(spark: SparkSession, name: str) -> str:
    """A new folder in the shared one, deleted when the application ends."""
    checkpoints(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(place)
    return path


def stack_range(spark, d):
    """Stacks of 16 x 16 x 16 voxels, one for each channel and 16,384 orders, written by the sink and read again for a range of pages of one channel."""
    folder = shared_place(spark, "stacks")
    v = derived.voxels(spark, d).withColumn("path", F.concat(F.lit("t/"), F.shiftright("x", 4))).withColumn("x", F.col("x") % 16)
    stacks.save_voxels(v, folder, (16, 16, 16))
    return stacks.voxels(stacks.load(spark, folder).where("c = 1 AND z >= 3 AND z < 9"))


def roi_scan(spark, d):
    """Tiles that begin in a box, from a table in space-filling order of which only the row groups near the box are read."""
    b = derived.boxes(spark, d)
    whole = _bbox(spark, d).first()
    box = _bbox(spark, d).select(*g.roi_box((0.25, 0.125, 0.25), (0.25, 0.5, 0.5))).first()
    folder = shared_place(spark, "ordered")
    regions.write_ordered(b, folder, tuple(whole[:3]), tuple(whole[3:]), max(1, b.count() // 100_000))
    return regions.scan(spark, folder, tuple(whole[:3]), tuple(whole[3:]), tuple(box)).select("id", *BOX)


def load_tiles(spark, d):
    """The tiles of each source written as TIFF stacks and read again; a stack is made of the greatest values of at most 16^3 places."""
    v = derived.voxels(spark, d).withColumn("path", F.concat_ws("-", F.lit("tile"), "src", F.shiftright("x", 4))).withColumn("x", F.col("x") % 16)
    return tiff.decoded(tiff.encoded(v.groupBy("path", "c", "x", "y", "z").agg(F.max("v").alias("v")), (16, 16, 16)))


def tile_count(spark, d):
    return derived.tiles(spark, d).groupBy(F.substring("path", 1, 3).alias("folder")).agg(F.count("*").alias("n"), F.min("id").alias("first_id"))


def tile_attrs(spark, d):
    return derived.tiles(spark, d).select("id", "path", F.get("dims", F.lit(3)).alias("nchannels"), F.concat_ws(",", "ox", "oy", "oz").alias("ori"))


def grid_validate(spark, d):
    return _odd_tiles(spark, d).select("id", F.concat_ws(",", catalog.violations()).alias("broken"))


def _odd_tiles(spark, d):
    """Tiles of which some have uneven, unordered or too large limits."""
    t = derived.tiles(spark, d)
    uneven = F.when(F.col("id") % 7 == 0, F.array(F.lit(0), F.lit(7), F.lit(13))).otherwise(F.col("xlims"))
    last = F.when(F.col("id") % 10 == 0, 64).otherwise(60)
    z = F.when(F.col("id") % 11 == 0, F.array(F.lit(3), F.lit(3), last)).when(F.col("id") % 13 == 0, F.array(F.lit(3), last)).otherwise(F.array(F.lit(3), (F.col("id") % 20 + 10).cast("int"), last))
    return t.withColumn("xlims", uneven).withColumn("zlims", z)


def grid_validate_shared(spark, d):
    return catalog.shared_violations(_odd_tiles(spark, d))


def aabb_hit(spark, d):
    b = derived.boxes(spark, d)
    return spatial.bucketed_hits(b, b).groupBy(F.col("a_id").alias("id")).agg(F.count("*").alias("hits"))


def aabb_set(spark, d):
    b = derived.boxes(spark, d)
    return b.select("id", *g.aabb_set({"x": F.when(F.col("id") % 2 == 0, F.col("ox") + 5)}, {"z": F.lit(7).cast("long")}))


def aabb_volume(spark, d):
    return derived.boxes(spark, d).select("id", g.aabb_volume().alias("volume"))


def aabb_union_pair(spark, d):
    b = derived.boxes(spark, d)
    a, c = b.alias("a"), b.withColumn("id", F.col("id") - 1).alias("b")
    return a.join(c, F.expr("a.id = b.id")).select(F.col("a.id").alias("id"), *g.aabb_union_pair("a", "b"))


def aabb_union(spark, d):
    b = derived.boxes(spark, d)
    return b.groupBy((F.col("id") % 25).alias("part")).agg(*g.aabb_union())


def octree_subdivide(spark, d):
    each = derived.boxes(spark, d).select("*", F.explode(F.sequence(F.lit(1), F.lit(8))).alias("digit"))
    box = g.octant(F.col("digit"))
    return each.select("id", "digit", *[box[c].alias(c) for c in BOX])


def kd_halve(spark, d):
    each = derived.boxes(spark, d).select("*", F.explode(F.array(F.lit(False), F.lit(True))).alias("upper"))
    half = g.halved(F.col("upper"))
    return each.select("id", "upper", *[half[c].cast("long").alias(c) for c in BOX])


def is_leaf(spark, d):
    return derived.boxes(spark, d).select("id", g.is_leaf(VOXEL_UM, 50_000.0).alias("leaf"))


def plan_nlevels(spark, d):
    return derived.boxes(spark, d).select("id", g.nlevels(g.aabb_volume() * 1000, VOXEL_UM, MAX_PIXELS).cast("int").alias("nlevels"))


def leaf_shape_search(spark, d):
    b = derived.boxes(spark, d).groupBy((F.col("id") % 5).alias("g")).agg(*g.aabb_union())
    shapes = b.select("g", *[(F.col(f"s{a}") - F.col(f"s{a}") % 2).alias(f"i{a}") for a in AXES])
    return octree.leaf_shape(shapes, 2).select("g", *[F.col(c).cast("long").alias(c) for c in ("px", "py", "pz", "dx", "dy", "dz", "cost")])


def transform_params(spark, d):
    b = derived.boxes(spark, d).groupBy((F.col("id") % 5).alias("g")).agg(*g.aabb_union())
    return b.select("g", "ox", "oy", "oz", *[(F.col(f"s{a}") / 1000 / 2**DEPTH / 64).alias(f"voxel_um_{a}") for a in AXES], F.lit(DEPTH + 1).alias("nl"))


def roi_box(spark, d):
    return derived.boxes(spark, d).select("id", *g.roi_box((0.0, 0.25, 0.5), (1.0, 0.5, 0.5)))


def roi_from_morton(spark, d):
    p = derived.node_paths(spark, d)
    return p.select("k", *[g.fraction_of_path(F.col("path"), i).alias(f"f{a}") for i, a in enumerate(AXES)], F.pow(F.lit(0.5), F.size(F.split("path", "/"))).alias("size"))


def tiles_in_roi(spark, d):
    roi = _bbox(spark, d).select(*g.roi_box((0.0, 0.0, 0.5), (0.5, 0.5, 0.5)))
    return spatial.in_box(derived.boxes(spark, d), roi).select("id", *BOX)


def subtile_corners(spark, d):
    cells = catalog.subtiles(derived.grid_nodes(derived.tiles(spark, d)))
    return cells.select("id", "ix", "iy", "iz", "orientation", *[c.cast("int") for c in catalog.corner_indices(3, 2)])


def subtile_aabb(spark, d):
    return catalog.subtiles(derived.grid_nodes(derived.tiles(spark, d))).drop("orientation")


def leaf_transform(spark, d):
    corners = catalog.corner_nodes(derived.grid_nodes(derived.tiles(spark, d))).alias("c")
    box = F.broadcast(_bbox(spark, d).alias("r"))
    px = [F.round((F.col(f"c.{a}") - F.col(f"r.o{a}")) / (F.col(f"r.s{a}") / 64), 6).alias(f"p{a}") for a in AXES]
    return corners.join(box).select("c.id", "c.ix", "c.iy", "c.iz", "c.b", *px)


def subtile_slice(spark, d):
    v = derived.voxels(spark, d)
    cell = F.explode(F.array(*[F.struct(F.lit(i).alias("cell"), F.lit(a).alias("low"), F.lit(b).alias("high")) for i, (a, b) in enumerate(((0, 7), (7, 15)))])).alias("s")
    return v.select("*", cell).where("z BETWEEN s.low AND s.high").groupBy("src", F.col("s.cell").alias("cell")).agg(F.count("*").alias("n"), F.sum(F.col("v").cast("long")).alias("total"))


def morton_decode(spark, d):
    k = derived.node_paths(spark, d).select("k")
    at = [g.morton_axis(F.col("k") % 4096, i, 4).alias(a) for i, a in enumerate(AXES)]
    back = k.select("k", *at)
    return back.select("k", *AXES, g.morton(*[F.col(a) for a in AXES], bits=4).alias("again"))


def face_paths(spark, d):
    k = derived.node_paths(spark, d)
    return k.select("k", *[g.face_path(F.col("k") % 64, 3, a).alias(f"face{a}") for a in (1, 2, 3)])


def quadtree_to_xy(spark, d):
    k = derived.node_paths(spark, d).select("k", g.face_path(F.col("k") % 64, 3, 1).alias("face"))
    q = k.withColumn("quad", g.quadtree_path(F.col("face"), 1))
    return q.select("k", "quad", g.cell_of_path(F.col("quad"), 0).alias("u"), g.cell_of_path(F.col("quad"), 1).alias("v"))


def _leaf_paths(spark, d):
    """Leaves that have an image: those whose last order is lit."""
    by_leaf = derived.node_paths(spark, d).groupBy(F.replace(F.col("path"), F.lit("/"), F.lit("")).alias("leaf")).agg(F.max_by("lit", "k").alias("lit"))
    return by_leaf.where("lit").select("leaf")


def face_leaf_stack(spark, d):
    faces = spark.range(64).select(g.face_path(F.col("id"), 3, 3).alias("face"))
    stack = faces.select("face", F.explode(F.sequence(F.lit(0), F.lit(7))).alias("i")).withColumn("leaf", g.stack_path(F.col("face"), F.col("i"), 3, 3))
    there = stack.join(_leaf_paths(spark, d), "leaf", "left_semi")
    gap = F.min("i").over(Window.partitionBy("face")).alias("skipped")
    nth = (F.row_number().over(Window.partitionBy("face").orderBy("i")) - 1).alias("position")
    return there.select("face", "i", "leaf", gap, nth)


def face_stack_voxels(spark, d):
    stack = face_leaf_stack(spark, d).select("face", "leaf", "position")
    v = derived.node_paths(spark, d).select(F.replace(F.col("path"), F.lit("/"), F.lit("")).alias("leaf"), (F.col("k") % 4).alias("z"), (F.col("k") % 65536).alias("v"))
    return v.join(stack, "leaf").groupBy("face", (F.col("position") * 4 + F.col("z")).alias("depth")).agg(F.max("v").alias("v"))


def crop_range(spark, d):
    b = derived.boxes(spark, d)
    c = lambda um, lower: g.crop_pixels(um, F.col("oz") * 1000, F.lit(0.5), F.col("id") % 2, 16, F.lit(8).cast("long"), lower)
    low = F.when(F.col("id") % 5 == 0, F.lit(None).cast("double")).otherwise(F.col("oz") + F.col("sx") / 4.0)
    high = F.when(F.col("id") % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("oz") + F.col("sx") / 2.0)
    return b.select("id", c(low, True).alias("crop_from"), c(high, False).alias("crop_to"))


def scale_clamp(spark, d):
    v = derived.voxels(spark, d)
    return v.groupBy("src").agg(F.round(F.sum(F.rint(g.scale_clamp(F.col("v"), *LEVELS[0]))), 0).cast("long").alias("total"))


def path_ops(spark, d):
    p = derived.node_paths(spark, d)
    last = F.right("path", F.lit(1)).cast("int")
    return p.select("k", F.concat_ws("-", "k", "job", "path").alias("prefix"), last.alias("last"), *[(F.shiftright(last - 1, i).bitwiseAND(1) * 24).alias(f"at_{a}") for i, a in enumerate(AXES)])


def octal_digits(spark, d):
    return derived.node_paths(spark, d).select("k", *[c.cast("int") for c in _aliased(g.octal_digits(F.col("job")), ["d0", "d1", "d2"])])


def _aliased(cols, names):
    return [c.alias(n) for c, n in zip(cols, names, strict=True)]


def human_readable(spark, d):
    kb = (F.col("o_orderkey") * F.col("o_orderkey") * 37).alias("kb")
    return derived.read(spark, d, "orders", "o_orderkey").select("o_orderkey", kb).select("o_orderkey", g.human_readable(F.col("kb")).alias("size"))


def string_scalars(spark, d):
    lines = derived.log_lines(spark, d)
    return lines.select(
        "event_id", F.replace(F.col("line"), F.lit("took"), F.lit("used")).alias("replaced"), F.startswith("line", F.lit("[ Info")).alias("is_info"), F.endswith("line", F.lit("sec")).alias("is_timed"),
        F.size(F.split("line", " ")).alias("words"), F.regexp_extract("line", r"([A-Z]+): ", 1).alias("role"), F.rlike("line", F.lit("octree|merging")).alias("is_tree"),
    )


def math_scalars(spark, d):
    b = derived.boxes(spark, d)
    return b.select(
        "id", F.ceil(F.col("sx") / 7).alias("up"), F.floor(F.col("sx") / 7).alias("down"), F.rint(F.col("sx") / 8).cast("long").alias("even"), F.round(F.log2(F.col("sy").cast("double")), 9).alias("lg"),
        F.abs(F.col("ox") - F.col("oy")).alias("gap"), F.greatest("ox", "oy", "oz").alias("most"), F.least("ox", "oy", "oz").alias("least"), F.pmod(F.col("ox") - 500, F.lit(7)).alias("left"),
        F.shiftright("ox", 2).alias("quarter"), F.shiftleft("sz", 1).alias("twice"), F.col("ox").bitwiseAND(F.col("oy")).alias("both"), g.longest_axis().alias("longest"),
    )


def array_scalars(spark, d):
    v = derived.read(spark, d, "embeddings", "vec_id", "embedding", "label")
    lims = F.array(*[(F.col("vec_id") * m % 11).cast("int") for m in (1, 3, 5, 7)])
    return v.select(
        "vec_id", F.concat_ws(",", F.sort_array(F.array_distinct(lims))).alias("ordered"), F.concat_ws(",", F.reverse(lims)).alias("backwards"), F.concat_ws(",", F.array_except(lims, F.array(F.col("label")))).alias("without"),
        F.size(F.filter("embedding", lambda x: x > 0)).alias("positive"), F.concat_ws(",", F.array_repeat(F.col("label"), 2)).alias("repeated"), F.array_position(lims, F.get(lims, F.lit(3))).cast("long").alias("found"),
    )


def leaf_tile_overlap(spark, d):
    leaves = _leaves(spark, d).select("morton", "path")
    return _pairs(spark, d).join(leaves, "morton").select("path", "id")


def leaf_tile_count(spark, d):
    return _pairs(spark, d).groupBy("morton").agg(F.count_distinct("id").alias("ntiles"))


def solo_leaves(spark, d):
    """Leaves of level 5 with a single contributor."""
    pairs = octree.descend(derived.boxes(spark, d), _bbox(spark, d), 5, leaves_only=True)
    return pairs.groupBy("path").agg(F.count("*").alias("n"), F.min("id").alias("id")).where("n = 1").drop("n")


def octree_descend(spark, d):
    checkpoints(spark)
    return octree.descend(derived.boxes(spark, d), _bbox(spark, d), DEPTH).groupBy("path", "level").agg(F.count("*").alias("ntiles"))


def subtiles_per_leaf(spark, d):
    cells = catalog.subtiles(derived.grid_nodes(derived.tiles(spark, d)))
    named = cells.select(F.struct("id", "ix", "iy", "iz").alias("id"), *BOX)
    leaves = _leaves(spark, d).select(F.col("path").alias("id"), *BOX)
    hits = spatial.spatial_join(named, leaves)
    return hits.groupBy(F.col("b_id").alias("path"), F.col("a_id.id").alias("id")).agg(F.count("*").alias("expected"))


def tiles_per_box(spark, d):
    nodes = octree.levels(_bbox(spark, d), 1)[-1].select(F.col("path").alias("id"), *BOX)
    return spatial.spatial_join(derived.boxes(spark, d), nodes).groupBy(F.col("b_id").alias("path")).agg(F.count("*").alias("ntiles"))


def kd_jobs(spark, d):
    checkpoints(spark)
    jobs = spatial.in_descending_order(spatial.kd_jobs(derived.boxes(spark, d), _bbox(spark, d), JOB_TILES))
    return jobs.select("job", *[F.col(c).cast("long").alias(c) for c in BOX], "ntiles")


def tile_locality_order(spark, d):
    return octree.locality(_pairs(spark, d))


def max_merge(spark, d):
    return merge.max_merge(derived.voxels(spark, d))


def max_merge_bricks(spark, d):
    """The same by dense bricks, which are combined inside each task and then once a brick; voxels over 0."""
    return bricks.unpack(bricks.merged(bricks.pack(derived.voxels(spark, d))))


def merge_octrees(spark, d):
    v = derived.voxels(spark, d)
    return merge.max_merge(*[v.where(F.col("src") == k) for k in range(4)])


def exclude_nodes(spark, d):
    v = derived.voxels(spark, d)
    bad = v.where("v > 65000").select("x", "y", "z").distinct()
    return v.join(bad, ["x", "y", "z"], "left_anti").groupBy("x", "y").agg(F.count("*").alias("n"))


def downsample_first(spark, d):
    return merge.downsample(max_merge(spark, d), "first")


def downsample_mean(spark, d):
    return merge.downsample(max_merge(spark, d), "mean")


def downsample_second(spark, d):
    return merge.downsample(max_merge(spark, d), "second")


def downsample_nth_nonzero(spark, d):
    return merge.downsample(max_merge(spark, d), "nth_nonzero")


def octree_pyramid(spark, d):
    checkpoints(spark)
    return merge.pyramid(max_merge(spark, d), 3, "second")


def pyramid_refresh(spark, d):
    """The pyramid of all voxels, from that of those without a corner of the fourth source, after these have come."""
    checkpoints(spark)
    v = derived.voxels(spark, d)
    late = "src = 3 AND x % 16 < 4 AND y < 8"
    old = merge.pyramid(merge.max_merge(v.where(f"NOT ({late})")), 3, "second")
    return merge.refresh(old, 3, "second", v.where(late))


def custom_udaf(spark, d):
    """A user's own reducer: the spread of a cube, as a grouped pandas UDF."""

    @F.pandas_udf("int")
    def spread(v: pd.Series) -> int:
        return int(v.max() - v.min())

    return merge.downsample(max_merge(spark, d), spread("v"))


def channel_subtract(spark, d):
    diff = projection.channel_difference(max_merge(spark, d), 0, 1, *LEVELS)
    return diff.select("x", "y", "z", g.to_u16(F.col("d")).alias("p"))


def _lit(spark, d):
    return max_merge(spark, d).where("c = 0").select("x", "y", "z", F.col("v").cast("double").alias("d"))


def project_max(spark, d):
    return projection.project(_lit(spark, d), CROP, F.max("d"))


def project_p999(spark, d):
    checkpoints(spark)
    inside = _lit(spark, d).where(F.col("z").between(*CROP)).checkpoint()
    return quantiles.quantiles(inside, ["x", "y"], "d", {"p": 0.999}).withColumn("p", F.round("p", 4))


def project_median_max(spark, d):
    return projection.project(projection.running_median(_lit(spark, d), 16), CROP, F.max("d"))


def project_second(spark, d):
    return projection.second_brightest_of(_lit(spark, d), CROP)


def projection_image(spark, d):
    """One channel less another along x, over leaves of 16 x 16 x 16 and cropped from the origin on, written as an image and read again."""
    folder, v = shared_place(spark, "image"), derived.voxels(spark, d)
    tile = F.shiftright("x", 4)
    levels = max(1, int(v.agg(F.coalesce(F.max(tile), F.lit(0))).first()[0]).bit_length())
    path = F.concat_ws("/", *[(F.shiftright(tile, k).bitwiseAND(1) + 1).cast("string") for k in reversed(range(levels))])
    leaves = bricks.merged(bricks.pack(v.select(path.alias("path"), "c", (F.col("x") % 16).alias("x"), "y", "z", "v"), octrees.NODE), octrees.NODE)
    plan = octrees.Plan((0, 0, 0), (16 << levels,) * 3, levels, (16, 16, 16), (1.0, 1.0, 1.0))
    config = ProjectionConfig(axis=1, crop_um=(3.0, 40.0), signal_levels=(0.0, 65535.0), reference_levels=(0.0, 65535.0))
    # tiles lie along x alone, so all that can be lit is one leaf's face; the rest of the root's would grow with the square of their number
    project.save_image(project.project_leaves(leaves, leaves.select("path").distinct(), plan, config), 16, 16, folder, "projection")
    # a square image's rows are its second axis
    return stacks.voxels(stacks.load(spark, folder)).select(F.col("y").alias("x"), F.col("x").alias("y"), F.col("v").alias("p"))


def mosaic(spark, d):
    """Face tiles of 4 x 4 pixels placed by their quadtree paths."""
    k = derived.node_paths(spark, d).select("k", g.quadtree_path(g.face_path(F.col("k") % 64, 3, 2), 2).alias("quad"))
    u, v = (g.cell_of_path(F.col("quad"), i) * 4 + F.shiftright("k", 6 + 2 * i) % 4 for i in (0, 1))
    return k.select(u.cast("long").alias("u"), v.cast("long").alias("v"), (F.col("k") * 7919 % 65536).alias("p")).groupBy("u", "v").agg(F.max("p").alias("p"))


def gaussian_downsample(spark, d):
    image = projection.as_pixels(project_max(spark, d))
    width = 16 * (image.agg(F.coalesce(F.max(F.shiftright("x", 4)), F.lit(0))).first()[0] + 1)
    return projection.pixels_of(projection.resized(projection.image_bricks(image), width, 16, width * 6 // 16, 5))


def octree_listing(spark, d):
    p = derived.node_paths(spark, d)
    name = F.concat(F.col("path"), F.lit("/default."), (F.col("k") % 3).cast("string"), F.lit(".tif"))
    return p.select(F.regexp_extract(name, r"^(.*)\.[^.]*\.[^.]*$", 1).alias("base"), F.regexp_extract(name, r"\.([0-9])\.tif$", 1).cast("int").alias("c")).distinct()


def leaf_only_scan(spark, d):
    p = derived.node_paths(spark, d)
    level = F.size(F.split("path", "/"))
    nodes = p.select("path").unionByName(p.select(F.substring("path", 1, 3).alias("path")).where("path LIKE '%/%'"))
    return nodes.withColumn("level", level).where("level = 3").groupBy("path", "level").agg(F.count("*").alias("files"))


def face_listing(spark, d):
    p = derived.node_paths(spark, d)
    name = F.concat(F.when(F.col("k") % 4 == 0, F.lit("x")).otherwise(F.lit("")), g.face_path(F.col("k") % 64, 3, 3), F.when(F.col("k") % 5 == 0, F.lit(".h5")).otherwise(F.lit(".tif")))
    return p.select(name.alias("name")).where(F.rlike("name", F.lit(r"^[1-8].*\.tif"))).select(F.get(F.split("name", r"\."), F.lit(0)).alias("face")).distinct()


def log_scan(spark, d):
    return logs.timed(derived.log_lines(spark, d)).select("event_id", "file", "sec")


def stage_profile(spark, d):
    checkpoints(spark)
    out = logs.stage_profile(derived.log_lines(spark, d))
    return out.select("category", "n", "least", "most", F.col("total").cast("double").alias("total"), *[F.round(q, 6).alias(q) for q in ("q25", "q50", "q75")])


def profile_bar(spark, d):
    return logs.profile_bar(derived.log_lines(spark, d)).withColumn("hours", F.round("hours", 9))


def log_counts(spark, d):
    return logs.log_counts(derived.log_lines(spark, d))


def timing_rollup(spark, d):
    return logs.timing_rollup(derived.log_lines(spark, d)).withColumn("total", F.col("total").cast("double"))


def monitor_scan(spark, d):
    return logs.monitor_samples(derived.monitor_lines(spark, d))


def cluster_series_sum(spark, d):
    return logs.cluster_series(logs.monitor_samples(derived.monitor_lines(spark, d))).select("seq", "ntiles")


def node_rates(spark, d):
    return logs.node_rates(derived.counters(spark, d))


def node_rates_stream(spark, d):
    """The same from a stream with keyed state, which is stopped and goes on from its checkpoint when half the samples have come."""
    counters = derived.counters(spark, d)
    half = counters.agg(F.floor((F.min("seq") + F.max("seq")) / 2)).first()[0]
    return rates.replayed(counters, shared_place(spark, "stream"), [half] if half is not None else [])


def incomplete_outputs(spark, d):
    v = derived.voxels(spark, d)
    seen = v.groupBy("x", "y", "z").agg(F.count_distinct("src").alias("ready"), F.max(F.col("v") % 5).cast("long").alias("expected"))
    return seen.where("expected > 1 AND expected <> ready")


def _resample(spark, d, mode):
    t = derived.tiles(spark, d)
    cells = catalog.subtiles(derived.grid_nodes(t), corners=True)
    tile = F.struct("id", "ix", "iy", "iz", "corners", "orientation")
    hits = spatial.spatial_join(cells.select(tile.alias("id"), *BOX), _leaves(spark, d).select(F.struct("path", *BOX).alias("id"), *BOX))
    pairs = hits.select("a_id.*", F.col("b_id.path").alias("path"), *[F.col(f"b_id.{c}").alias(c) for c in BOX])
    # a tile's voxels are the lines of its part: 4 x 4 x 4 places, greatest price first
    lines = derived.read(spark, d, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice")
    voxels = lines.selectExpr("l_partkey AS id", "CAST((l_suppkey & 3) + 4 * (l_orderkey & 3) + 16 * (l_linenumber & 3) AS INT) AS at", "CAST(floor(l_extendedprice) AS BIGINT) & 65535 AS v")
    voxels = voxels.groupBy("id", "at").agg(F.max("v").alias("v"))
    tiles = voxels.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("at", "v"))).alias("lit"))  # at most 64 entries
    word = lambda i: F.lpad(F.hex(F.coalesce(F.try_element_at("lit", i), F.lit(0))), 4, "0")
    little = lambda w: F.concat(F.substring(w, 3, 2), F.substring(w, 1, 2))
    block = F.unhex(F.array_join(F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: little(word(i))), ""))
    one = pairs.join(tiles.select("id", block.alias("block")), "id").select("path", *BOX, "corners", "orientation", "block", *[F.lit(4).alias(f"n{a}") for a in AXES])
    return bricks.unpack(bricks.merged(resample.resample(one, mode), ("path",)), ("path",))


def resample_nearest(spark, d):
    return _resample(spark, d, "nearest")


def resample_linear(spark, d):
    return _resample(spark, d, "linear")


FLAGSHIP = "leaf_tile_count"
QUERIES = {
    f.__name__: f
    for f in (
        leaf_tile_count, tile_catalog, load_tiles, stack_range, tile_count, tile_attrs, grid_validate, grid_validate_shared, aabb_hit, aabb_set, aabb_volume, aabb_union_pair, aabb_union, octree_subdivide, kd_halve, is_leaf, plan_nlevels,
        leaf_shape_search, transform_params, roi_box, roi_from_morton, tiles_in_roi, roi_scan, subtile_corners, subtile_aabb, leaf_transform, subtile_slice, morton_decode, face_paths, quadtree_to_xy,
        face_leaf_stack, face_stack_voxels, crop_range, scale_clamp, path_ops, octal_digits, human_readable, string_scalars, math_scalars, array_scalars, leaf_tile_overlap, solo_leaves,
        octree_descend, subtiles_per_leaf, tiles_per_box, kd_jobs, tile_locality_order, max_merge, max_merge_bricks, merge_octrees, exclude_nodes, downsample_first, downsample_mean, downsample_second,
        downsample_nth_nonzero, octree_pyramid, pyramid_refresh, custom_udaf, channel_subtract, project_max, project_p999, project_median_max, project_second, projection_image, mosaic, gaussian_downsample, octree_listing,
        leaf_only_scan, face_listing, log_scan, stage_profile, profile_bar, log_counts, timing_rollup, monitor_scan, cluster_series_sum, node_rates, node_rates_stream, incomplete_outputs, resample_nearest, resample_linear,
    )
}
