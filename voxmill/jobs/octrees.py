"""From a tile catalogue and its TIFF stacks to an octree of TIFF stacks: plan, overlap, resample, merge, downsample, write.

Voxels are bricks all along. Pages are cut to sub-tiles as they are read; a sub-tile's pieces stream into one block; blocks are
resampled into bricks of their leaves; leaves that a single sub-tile touches skip the merge.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import voxmill
from voxmill.config import EngineConfig
from voxmill.functions import geometry as g
from voxmill.functions.geometry import AXES, BOX
from voxmill.operators import bricks, octree, resample, spatial
from voxmill.sources import catalog, stacks

NODE = ("path", "c")
CELL = ["id", "c", "ix", "iy", "iz"]
PIECES = "id long, c int, ix int, iy int, iz int, z int, nx int, ny int, nz int, piece binary"
BLOCKS = "id long, c int, ix int, iy int, iz int, nx int, ny int, nz int, block binary"


@dataclass(frozen=True)
class Plan:
    """Origin and shape of the volume in nm, levels below the root, a leaf's pixels, and the voxel in um that follows."""

    origin: tuple[int, int, int]
    shape: tuple[int, int, int]
    nlevels: int
    leaf_px: tuple[int, int, int]
    voxel_um: tuple[float, float, float]


def plan(tiles: DataFrame, config: EngineConfig) -> Plan:
    """One aggregate over the tiles' boxes, then arithmetic on its row."""
    box = tiles.agg(*g.aabb_union())
    row = box.select(*BOX, g.nlevels(g.aabb_volume(), config.voxelsize_um, config.max_pixels_per_leaf).alias("n")).first()
    origin, shape, n = tuple(row[:3]), tuple(row[3:6]), row.n
    first = [round(s / 1000 / 2**n / v / 2) * 2 for s, v in zip(shape, config.voxelsize_um, strict=True)]
    best = octree.leaf_shape(tiles.sparkSession.createDataFrame([(1, *first)], "g int, ix int, iy int, iz int"), config.leaf_dim_divisible_by).first()
    if best is None:
        raise ValueError(f"no leaf shape near {first}")
    leaf = (best.px, best.py, best.pz)
    return Plan(origin, shape, n, leaf, tuple(s / 1000 / 2**n / p for s, p in zip(shape, leaf, strict=True)))


def transform_text(p: Plan) -> str:
    """The volume's place and scale as viewers read it."""
    scale = [v * 1000 * 2**p.nlevels for v in p.voxel_um]
    lines = [f"o{a}: {o}" for a, o in zip(AXES, p.origin, strict=True)] + [f"s{a}: {s}" for a, s in zip(AXES, scale, strict=True)]
    return "\n".join([*lines, f"nl: {p.nlevels + 1}"]) + "\n"


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file of the driver's, in any file system that Spark writes."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    out = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(place, True)
    try:
        out.write(text.encode())
    finally:
        out.close()


def assigned(tiles: DataFrame, config: EngineConfig) -> DataFrame:
    """The tiles of the region of interest: those that hit it and, as a rule, begin in it."""
    roi = tiles.agg(*g.aabb_union()).select(*g.roi_box(config.roi_origin, config.roi_size))
    return spatial.in_box(tiles, roi, config.include_origins_outside_roi)


def nodes_of(tiles: DataFrame, box: DataFrame, depth: int) -> DataFrame:
    """(path, level, id) of all nodes that tiles of the catalogue overlap, each sub-tile counted once a tile."""
    cells = catalog.subtiles(catalog.grid_nodes(tiles)).select("id", *BOX)
    return octree.descend(cells, box, depth).select("path", "level", "id").distinct()


def pieces(pages: DataFrame, tiles: DataFrame) -> DataFrame:
    """PIECES: each page of the tiles' stacks, cut by their limits, both in; a page between two sub-tiles belongs to both.

    A stack belongs to the tile whose path is its folder. The tiles are the small side of that join by equal keys.
    """
    folder = F.concat(F.lit("/"), F.regexp_extract("path", "^(.*)/[^/]*$", 1))
    known = tiles.select("id", F.col("path").alias("folder"), "xlims", "ylims", "zlims")
    named = pages.withColumn("folder", folder).join(known, "folder")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in PIECES.split(", ")]
        types = [pa.int64(), *[pa.int32()] * 8, pa.binary()]
        for b in batches:
            own = b.select(["id", "c", "z", "height", "width", "xlims", "ylims", "zlims"]).to_pylist()
            for r, cell in zip(own, b.column("data"), strict=True):
                data = np.frombuffer(cell.as_buffer(), "<u2").reshape(r["height"], r["width"]).T
                x, y, z = ([*zip(r[f"{a}lims"], r[f"{a}lims"][1:], strict=False)] for a in AXES)
                cut = [
                    (r["id"], r["c"], ix, iy, iz, r["z"], x1 - x0 + 1, y1 - y0 + 1, z1 - z0 + 1, data[y0 : y1 + 1, x0 : x1 + 1].tobytes())
                    for iz, (z0, z1) in enumerate(z, 1)
                    if z0 <= r["z"] <= z1
                    for iy, (y0, y1) in enumerate(y, 1)
                    for ix, (x0, x1) in enumerate(x, 1)
                ]
                if cut:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*cut, strict=True), types, strict=True)], names)

    return named.select("id", "c", "z", "height", "width", "data", "xlims", "ylims", "zlims").mapInArrow(run, PIECES)


def blocks(cut: DataFrame) -> DataFrame:
    """BLOCKS: the pieces of each sub-tile one after the other. A task holds one block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in BLOCKS.split(", ")]
        types = [pa.int64(), *[pa.int32()] * 7, pa.binary()]
        now, parts = None, []

        def sent() -> pa.RecordBatch:
            if sum(map(len, parts)) != 2 * now[5] * now[6] * now[7]:
                raise ValueError(f"sub-tile {now[:5]} has {len(parts)} of its {now[7]} pages, or some of another size")
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip((*now, b"".join(parts)), types, strict=True)], names)

        for b in batches:
            keys = zip(*(b.column(c).to_pylist() for c in [*CELL, "nx", "ny", "nz"]), strict=True)
            for key, cell in zip(keys, b.column("piece"), strict=True):
                if key != now:
                    if now:
                        yield sent()
                    now, parts = key, []
                parts.append(cell.as_buffer().to_pybytes())
        if now:
            yield sent()

    return cut.repartition(*CELL).sortWithinPartitions(*CELL, "z").mapInArrow(run, BLOCKS)


def leaf_bricks(tiles: DataFrame, cut: DataFrame, box: DataFrame, p: Plan, config: EngineConfig) -> DataFrame:
    """(path, c, i, j, k, data) of all leaves: resampled, and merged by their greatest value where several sub-tiles meet in a leaf."""
    cells = catalog.subtiles(catalog.grid_nodes(tiles), corners=True)
    tile = F.struct("id", "ix", "iy", "iz", "corners", "orientation")
    hits = octree.descend(cells.select(tile.alias("id"), *BOX), box, p.nlevels, leaves_only=True).checkpoint()
    shared = hits.groupBy("path").agg((F.count("*") > 1).alias("shared"))
    pairs = hits.join(shared, "path").select("id.*", "path", "shared", *BOX).join(cut, ["id", "ix", "iy", "iz"])
    parts = resample.resample(pairs, config.interpolation, p.leaf_px, keep=(*NODE, "shared")).checkpoint()
    return bricks.merged_but_solo(parts, "shared", NODE)


def save_nodes(dense: DataFrame, nodes: DataFrame, p: Plan, config: EngineConfig, out: str) -> None:
    """One stack per node and channel, those without a lit voxel as well."""
    first = [F.lit(0).alias(a) for a in bricks.PLACE]
    dark = nodes.select("path").distinct().select("path", F.explode(F.sequence(F.lit(0), F.lit(config.nchannels - 1))).alias("c"), *first, F.lit(bytes(2 * bricks.CELLS)).alias("data"))
    name = F.concat_ws("/", F.when(F.col("path") != "", F.col("path")), F.lit("default"))
    # a dark first brick for each node comes before its own
    both = dense.select("path", "c", *bricks.PLACE, "data").unionByName(dark).select(name.alias("path"), "c", *bricks.PLACE, "data")
    config.write_stacks(stacks.slabs(both, p.leaf_px), out)


def rebuild_upper(spark: SparkSession, config: EngineConfig, p: Plan, out: str) -> None:
    """Write the levels above the leaves of an octree anew from its leaf images; files of other levels aren't read."""
    node = "/".join(["[1-8]"] * p.nlevels)
    pages = stacks.load(spark, out, pattern=f"{node}/default" if node else "default")
    named = pages.withColumn("path", F.regexp_replace("path", "/?default$", ""))
    leaves = bricks.merged(stacks.as_bricks(named), NODE).checkpoint()
    there = named.select("path").distinct()
    levels = F.explode(F.sequence(F.lit(0), F.lit(p.nlevels - 1)))
    above = there.select("path", levels.alias("level")).select(F.array_join(F.slice(F.split("path", "/"), F.lit(1), F.col("level")), "/").alias("path"))
    if p.nlevels:
        upper = bricks.pyramid(leaves, p.nlevels, config.downsampling, NODE, ("path", p.leaf_px))[:-1]
        save_nodes(bricks.at_level(upper), above, p, config, out)


def build(spark: SparkSession, config: EngineConfig, catalogue: str, tiles_folder: str, out: str) -> Plan:
    """Write the octree of a catalogue below ``out``, with its plan, jobs, transform, and the catalogue as it was read.

    Node images are at ``<digit>/<digit>/default.<channel>.tif``. Tiles that break a rule of the grid stop the job.
    """
    tiles = catalog.read_yaml(spark, catalogue, f"{out}/tiles.parquet")
    broken = tiles.select("path", catalog.violations().alias("broken")).where(F.size("broken") > 0).limit(5).collect()
    broken += catalog.shared_violations(tiles).where("broken").collect()  # a row per rule
    if broken:
        raise ValueError(f"the catalogue breaks rules: {broken}")
    p = plan(tiles, config)
    box = spark.createDataFrame([(*p.origin, *p.shape)], ", ".join(f"{c} long" for c in BOX))
    own = assigned(tiles, config)
    spatial.in_descending_order(spatial.kd_jobs(own, box, config.max_tilechannels_per_job // config.nchannels)).write.mode("overwrite").parquet(f"{out}/jobs.parquet")
    nodes = nodes_of(own, box, p.nlevels).checkpoint()
    cut = blocks(pieces(config.read_stacks(spark, tiles_folder), own))
    leaves = leaf_bricks(own, cut, box, p, config).checkpoint()
    levels = bricks.pyramid(leaves, p.nlevels, config.downsampling, NODE, ("path", p.leaf_px))
    save_nodes(bricks.at_level(levels), nodes, p, config, out)
    known = {k: v if isinstance(v, (str, int, float, tuple, bool)) else getattr(v, "__name__", str(v)) for k, v in asdict(config).items()}
    write_text(spark, f"{out}/calculated_parameters.json", json.dumps(known | asdict(p) | {"version": voxmill.__version__}, indent=1))
    write_text(spark, f"{out}/transform.txt", transform_text(p))
    return p
