"""A projection of an octree's leaves to images: channels subtracted, cropped, reduced along an axis, written whole and at each pixel size."""

from __future__ import annotations

import posixpath

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxmill.config import ProjectionConfig
from voxmill.jobs.octrees import NODE, Plan
from voxmill.operators import bricks, projection
from voxmill.sources import stacks

#: An image larger than this on a side is written in parts, so that a task holds a bounded one.
PART = 8192


def save_image(image: DataFrame, width: int, height: int, folder: str, name: str) -> list[str]:
    """Write image bricks as TIFF, transposed where the image is wider than high, and return the names of its parts."""
    wide = width > height
    single = width <= PART and height <= PART
    grid = [PART // side for side in bricks.IMAGE[:2]]
    number = [F.floor(F.col(p) / n).cast("int") for p, n in zip("ij", grid, strict=True)]
    path = F.lit(name) if single else F.concat_ws("-", F.lit(name), *(number if wide else reversed(number)))
    own = ["i", "j"] if single else [F.expr(f"{p} % {n}").alias(p) for p, n in zip("ij", grid, strict=True)]
    parts = image.select(path.alias("path"), F.lit(0).alias("c"), *own, "k", "data")
    counts = [1, 1] if single else [-(-n // PART) for n in (width, height)]
    names = [name] if single else [f"{name}-{r}-{q}" for r in range(counts[0 if wide else 1]) for q in range(counts[1 if wide else 0])]
    dark = image.sparkSession.createDataFrame([(n, 0, 0, 0, 0, bytes(2 * bricks.CELLS)) for n in names], parts.schema)  # so that each part has its file
    stacks.save(stacks.slabs(parts.unionByName(dark), (min(width, PART), min(height, PART), 1), bricks.IMAGE, turned=not wide), folder)
    return names


def project_leaves(leaves: DataFrame, there: DataFrame, p: Plan, config: ProjectionConfig) -> DataFrame:
    """Image bricks of the whole projection of leaves(path, c, i, j, k, data), of the nodes there(path)."""
    a = config.axis - 1
    stack = projection.stacked(there, config.axis, p.nlevels, config.crop_um, p.origin[a] / 1000, p.voxel_um[a], p.leaf_px[a])
    return projection.project_bricks(leaves, stack, config, p.leaf_px)


def project(spark: SparkSession, octree: str, p: Plan, config: ProjectionConfig, folder: str) -> list[str]:
    """Write the projection of the octree below a folder, and its resized images; the names of the files.

    Images are ``tiles/projection-<width>x<height>`` and ``projection-<width>x<height>-<pixel size>um``.
    """
    node = "/".join(["[1-8]"] * p.nlevels)
    pages = stacks.load(spark, octree, pattern=f"{node}/default" if node else "default")
    pages = pages.withColumn("path", F.regexp_replace("path", "/?default$", ""))
    there = pages.where("z = 0").select("path").distinct().checkpoint()
    used = pages.where(F.col("c").isin(config.signal_channel, config.reference_channel))
    image = project_leaves(bricks.merged(stacks.as_bricks(used), NODE), there, p, config).checkpoint()
    across = [i for i in range(3) if i != config.axis - 1]
    size = [p.leaf_px[i] * 2**p.nlevels for i in across]
    names = [posixpath.join("tiles", n) for n in save_image(image, *size, posixpath.join(folder, "tiles"), f"projection-{size[0]}x{size[1]}")]
    for um in config.output_pixel_sizes_um:
        new = [max(1, round(n * p.voxel_um[i] / um)) for n, i in zip(size, across, strict=True)]
        names += save_image(projection.resized(image, *size, *new), *new, folder, f"projection-{new[0]}x{new[1]}-{um:g}um")
    return names
