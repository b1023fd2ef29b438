"""Baseline grey TIFF stacks of 16 bits, read and written without an imaging library."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# TIFF tags.
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, OFFSETS, ROWS, COUNTS = 256, 257, 258, 259, 262, 273, 278, 279


def encode(stack: np.ndarray) -> bytes:
    """stack[z, y, x] of u16 as little-endian pages of one strip each."""
    depth, height, width = stack.shape
    out, size = bytearray(b"II*\0" + struct.pack("<I", 8)), 2 + 8 * 12 + 4
    for z in range(depth):
        start = len(out)
        data_at = start + size
        raw = stack[z].astype("<u2").tobytes()
        tags = [(WIDTH, 4, width), (LENGTH, 4, height), (BITS, 3, 16), (COMPRESSION, 3, 1), (PHOTOMETRIC, 3, 1), (OFFSETS, 4, data_at), (ROWS, 4, height), (COUNTS, 4, len(raw))]
        following = data_at + len(raw) if z + 1 < depth else 0
        out += struct.pack("<H", 8) + b"".join(struct.pack("<HHII", t, kind, 1, v) for t, kind, v in tags) + struct.pack("<I", following) + raw
    return bytes(out)


def decode(raw: bytes) -> np.ndarray:
    """The [z, y, x] stack of an uncompressed grey u16 TIFF, either byte order."""
    order = {b"II": "<", b"MM": ">"}[raw[:2]]
    magic, at = struct.unpack(order + "HI", raw[2:8])
    if magic != 42:
        raise ValueError("not a TIFF")
    pages = []
    while at:
        (n,) = struct.unpack_from(order + "H", raw, at)
        tags = {}
        for i in range(n):
            tag, kind, count = struct.unpack_from(order + "HHI", raw, at + 2 + 12 * i)
            code = {1: "B", 3: "H", 4: "I"}.get(kind)
            if code:
                where = at + 2 + 12 * i + 8
                if struct.calcsize(code) * count > 4:
                    (where,) = struct.unpack_from(order + "I", raw, where)
                tags[tag] = struct.unpack_from(f"{order}{count}{code}", raw, where)
        if tags.get(COMPRESSION, (1,))[0] != 1 or tags[BITS][0] != 16:
            raise ValueError("only uncompressed stacks of 16 bits are read")
        data = b"".join(raw[o : o + c] for o, c in zip(tags[OFFSETS], tags[COUNTS], strict=True))
        pages.append(np.frombuffer(data, order + "u2").reshape(tags[LENGTH][0], tags[WIDTH][0]))
        (at,) = struct.unpack_from(order + "I", raw, at + 2 + 12 * n)
    return np.stack(pages)


VOXELS = "path string, c int, x int, y int, z int, v int"


def decoded(files: DataFrame) -> DataFrame:
    """VOXELS over 0 of files(path, c, content), one task at a time holding one stack; a file's x and y are swapped."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            for r in f.itertuples():
                stack = decode(r.content)
                z, x, y = np.nonzero(stack)
                yield pd.DataFrame({"path": r.path, "c": r.c, "x": x, "y": y, "z": z, "v": stack[z, x, y].astype(int)})

    return files.select("path", "c", "content").mapInPandas(run, VOXELS)


def encoded(voxels: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """(path, c, content): voxels(path, c, x, y, z, v) as one stack per path and channel; a group is one tile of that shape."""

    def stack_of(f: pd.DataFrame) -> pd.DataFrame:
        stack = np.zeros((shape[2], shape[0], shape[1]), np.uint16)
        np.maximum.at(stack, (f.z, f.x, f.y), f.v.astype(np.uint16))
        return pd.DataFrame({"path": [f.path.iloc[0]], "c": [f.c.iloc[0]], "content": [encode(stack)]})

    return voxels.groupBy("path", "c").applyInPandas(stack_of, "path string, c int, content binary")


def listing(spark: SparkSession, folder: str, level: int | None = None) -> DataFrame:
    """(path, level, c) of the images of an octree below a folder, of one level if it is given: names alone, no content is read.

    A node's path is its digits, joined by slashes; its images are ``default.<channel>.tif`` in the folder of that path.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "default.[0-9].tif")
    files = files.option("recursiveFileLookup", "true").load(folder) if level is None else files.load("/".join([folder, *["[1-8]"] * level, "default.[0-9].tif"]))
    node = F.regexp_extract("path", r"((?:/[1-8])*)/default\.[0-9]\.tif$", 1)
    named = files.select(F.regexp_replace(node, "^/", "").alias("path"), F.regexp_extract("path", r"\.([0-9])\.tif$", 1).cast("int").alias("c"))
    return named.select("path", F.when(F.col("path") == "", 0).otherwise(F.size(F.split("path", "/"))).alias("level"), "c")
