"""Folders of u16 TIFF stacks as a data source: pages are read in ranges, and whole stacks are written with a commit.

A stack is the file ``<path>.<channel>.tif`` below a folder; ``path`` is its place there without the ending. Rows are pages
(``PAGES``): ``z`` is a page's number, ``depth`` the pages of the stack, ``height`` and ``width`` a page's rows and columns, ``data`` its little-endian bytes.

Reading: a file is read in parts of about ``partbytes``, and small files are read several by a task; each part walks the chain of page headers, a few dozen bytes each, and
reads only its own pages. Filters on ``path`` and ``c`` leave files out, filters on ``z`` pages, whatever else Spark then applies.

Writing: a row may hold several pages in order; the rows of one stack come to one task in order of ``z`` and pages between them
are dark. A task streams its files to a staging folder beside the target; the commit moves them to their places and an abort
deletes them, so a task that is killed or runs twice leaves nothing. Places are given as plain paths or URIs, for any file system that Arrow opens.
"""

from __future__ import annotations

import posixpath
import re
import struct
import uuid
from collections.abc import Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual, WriterCommitMessage
from pyspark.sql.types import StructType

from voxmill.operators import bricks
from voxmill.sources.tiff import BITS, COMPRESSION, COUNTS, LENGTH, OFFSETS, PHOTOMETRIC, ROWS, WIDTH

FORMAT = "u16stacks"
PAGES = "path string, c int, z int, depth int, height int, width int, data binary"
_NAMES = [x.split()[0] for x in PAGES.split(", ")]
_TYPES = [pa.string(), *[pa.int32()] * 5, pa.binary()]
_FILE = re.compile(r"(.*)\.([0-9])\.tif")
#: Bytes of pages in a batch that a task sends on.
SEND = 16 << 20
#: What opening a file weighs, in bytes, when small ones are read by one task.
OPENING = 4 << 20


def opened(place: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a plain path or URI, and the path in it."""
    if re.match(r"[a-z][a-z0-9+.-]*:", place):
        return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", place))
    return pafs.LocalFileSystem(), place


def _tags(file: pa.NativeFile, at: int, order: str) -> tuple[dict[int, tuple[str, int, bytes]], int]:
    """(tags as type code, count, bytes of the value or its place; the next page's place) of the page header at ``at``."""
    file.seek(at)
    (n,) = struct.unpack(f"{order}H", file.read(2))
    raw = file.read(12 * n + 4)
    found = {}
    for i in range(n):
        tag, kind, count = struct.unpack_from(f"{order}HHI", raw, 12 * i)
        if kind in (1, 3, 4):
            found[tag] = ({1: "B", 3: "H", 4: "I"}[kind], count, raw[12 * i + 8 : 12 * i + 12])
    return found, struct.unpack_from(f"{order}I", raw, 12 * n)[0]


def _values(file: pa.NativeFile, tag: tuple[str, int, bytes], order: str) -> tuple[int, ...]:
    code, count, raw = tag
    size = struct.calcsize(code) * count
    if size > 4:
        file.seek(struct.unpack(f"{order}I", raw)[0])
        raw = file.read(size)
    return struct.unpack_from(f"{order}{count}{code}", raw)


def headers(file: pa.NativeFile) -> tuple[str, list[dict]]:
    """(byte order, the tags of each page), along the chain of headers; no pixel is read."""
    start = file.read(8)
    order = {b"II": "<", b"MM": ">"}.get(start[:2])
    if order is None or struct.unpack(f"{order}H", start[2:4])[0] != 42:
        raise ValueError("not a TIFF")
    (at,) = struct.unpack(f"{order}I", start[4:])
    found = []
    while at:
        tags, at = _tags(file, at, order)
        found.append(tags)
    return order, found


def page(file: pa.NativeFile, tags: dict, order: str) -> tuple[int, int, bytes]:
    """(height, width, little-endian bytes) of one page."""
    one = {t: _values(file, tags[t], order) for t in (WIDTH, LENGTH, BITS, OFFSETS, COUNTS)}
    if one[BITS][0] != 16 or COMPRESSION in tags and _values(file, tags[COMPRESSION], order)[0] != 1:
        raise ValueError("only uncompressed stacks of 16 bits are read")
    strips = []
    for o, n in zip(one[OFFSETS], one[COUNTS], strict=True):
        file.seek(o)
        strips.append(file.read(n))
    raw = b"".join(strips)
    return one[LENGTH][0], one[WIDTH][0], raw if order == "<" else np.frombuffer(raw, ">u2").astype("<u2").tobytes()


@dataclass
class Part:
    """Part ``part`` of ``parts`` of a file's pages."""

    file: str
    path: str
    c: int
    part: int
    parts: int


@dataclass
class Parts(InputPartition):
    """What one task reads."""

    parts: list[Part]


class StackReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.place, self.part_bytes = options["path"], int(options.get("partbytes", 64 << 20))
        self.pattern = re.compile(options.get("pattern", ".*"))
        self.filters: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = getattr(f, "attribute", None)
            if name == ("z",) and isinstance(f, (EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual)) or name in (("c",), ("path",)) and isinstance(f, (EqualTo, In)):
                self.filters.append(f)
            else:
                yield f

    def wanted(self, name: str, value: object) -> bool:
        """Whether the pushed filters on a column let this value through."""
        tests = {
            EqualTo: lambda v, w: v == w, In: lambda v, w: v in w, GreaterThan: lambda v, w: v > w,
            GreaterThanOrEqual: lambda v, w: v >= w, LessThan: lambda v, w: v < w, LessThanOrEqual: lambda v, w: v <= w,
        }
        return all(tests[type(f)](value, f.value) for f in self.filters if f.attribute == (name,))

    def partitions(self) -> list[Parts]:
        fs, base = opened(self.place)
        found, weight = [], 0
        for info in sorted(fs.get_file_info(pafs.FileSelector(base, recursive=True)), key=lambda info: info.path):
            m = _FILE.fullmatch(posixpath.relpath(info.path, base))
            if info.type == pafs.FileType.File and m and not m[1].startswith("_") and self.pattern.fullmatch(m[1]) and self.wanted("path", m[1]) and self.wanted("c", int(m[2])):
                n = max(1, -(-info.size // self.part_bytes))
                for i in range(n):
                    own = info.size // n + OPENING
                    if not found or weight + own > self.part_bytes:
                        found.append(Parts([]))
                        weight = 0
                    found[-1].parts.append(Part(info.path, m[1], int(m[2]), i, n))
                    weight += own
        return found

    def read(self, partition: Parts) -> Iterator[pa.RecordBatch]:
        fs, _ = opened(self.place)
        held, size = [], 0
        for part in partition.parts:
            with fs.open_input_file(part.file) as file:
                order, pages = headers(file)
                n = len(pages)
                for z in range(n * part.part // part.parts, n * (part.part + 1) // part.parts):
                    if self.wanted("z", z):
                        height, width, data = page(file, pages[z], order)
                        held.append((part.path, part.c, z, n, height, width, data))
                        size += len(data)
                        if size > SEND:
                            yield _batch(held)
                            held, size = [], 0
        if held:
            yield _batch(held)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


class StackFile:
    """One stack as it is written, page after page: the places of headers and pixels follow from the page's size."""

    def __init__(self, out: pa.NativeFile, depth: int, height: int, width: int):
        self.out, self.depth, self.height, self.width, self.z = out, depth, height, width, 0
        self.size, self.header = 2 * height * width, 2 + 8 * 12 + 4
        if 8 + depth * (self.header + self.size) >= 1 << 32:
            raise ValueError("a stack of 4 GiB or more is no TIFF")
        out.write(b"II*\0" + struct.pack("<I", 8))

    def write(self, z: int, data: bytes | memoryview) -> None:
        """Pages from z on; dark ones come before them."""
        if z < self.z or len(data) % self.size or z + len(data) // self.size > self.depth:
            raise ValueError(f"page {z} is out of order or of another size")
        for _ in range(self.z, z):
            self._page(bytes(self.size))
        for at in range(0, len(data), self.size):
            self._page(memoryview(data)[at : at + self.size])

    def _page(self, raw: bytes | memoryview) -> None:
        start = 8 + self.z * (self.header + self.size)
        self.z += 1
        tags = [(WIDTH, 4, self.width), (LENGTH, 4, self.height), (BITS, 3, 16), (COMPRESSION, 3, 1), (PHOTOMETRIC, 3, 1), (OFFSETS, 4, start + self.header), (ROWS, 4, self.height), (COUNTS, 4, self.size)]
        self.out.write(struct.pack("<H", 8) + b"".join(struct.pack("<HHII", t, kind, 1, v) for t, kind, v in tags) + struct.pack("<I", start + self.header + self.size if self.z < self.depth else 0))
        self.out.write(raw)

    def close(self) -> None:
        self.write(self.depth, b"")
        self.out.close()


@dataclass
class Written(WriterCommitMessage):
    """(staged, final) places of a task's files."""

    files: list[tuple[str, str]]


class StackWriter(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str]):
        self.place = options["path"]
        self.staging = posixpath.join(opened(self.place)[1].rstrip("/"), f"_staging-{uuid.uuid4().hex}")

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        fs, base = opened(self.place)
        own = posixpath.join(self.staging, uuid.uuid4().hex)  # another one for each attempt
        now, file, files = None, None, []
        for batch in iterator:
            for i in range(batch.num_rows):
                path, c, z, depth, height, width = (batch.column(n)[i].as_py() for n in _NAMES[:-1])
                if now != (path, c):
                    if file:
                        file.close()
                    name = posixpath.normpath(f"{path}.{c}.tif")
                    if name.startswith(("../", "/")):
                        raise ValueError(f"a stack outside its folder: {path}")
                    staged = posixpath.join(own, name)
                    fs.create_dir(posixpath.dirname(staged), recursive=True)
                    file, now = StackFile(fs.open_output_stream(staged), depth, height, width), (path, c)
                    files.append((staged, posixpath.join(base, name)))
                file.write(z, memoryview(batch.column("data")[i].as_buffer()))
        if file:
            file.close()
        return Written(files)

    def commit(self, messages: list[Written | None]) -> None:
        fs, _ = opened(self.place)
        files = [f for m in messages if m for f in m.files]
        for folder in {posixpath.dirname(final) for _, final in files}:
            fs.create_dir(folder, recursive=True)
        with ThreadPoolExecutor(16) as pool:
            list(pool.map(lambda f: fs.move(*f), files))
        self.abort(messages)

    def abort(self, messages: list[Written | None]) -> None:
        fs, _ = opened(self.place)
        if fs.get_file_info(self.staging).type == pafs.FileType.Directory:
            fs.delete_dir(self.staging)


class StackSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return PAGES

    def reader(self, schema: StructType) -> StackReader:
        return StackReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> StackWriter:
        return StackWriter(self.options)


def load(spark: SparkSession, folder: str, part_bytes: int = 64 << 20, pattern: str = ".*") -> DataFrame:
    """PAGES of all stacks below a folder whose paths match a regular expression. Spark's switch for filters on such sources is put on in the session."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(StackSource)
    return spark.read.format(FORMAT).option("partbytes", part_bytes).option("pattern", pattern).load(folder)


def save(pages: DataFrame, folder: str) -> None:
    """Write PAGES as stacks below a folder, over those of the same name: each stack by one task, which holds a row at a time."""
    spark = pages.sparkSession
    spark.dataSource.register(StackSource)
    pages.select(*_NAMES).repartition("path", "c").sortWithinPartitions("path", "c", "z").write.format(FORMAT).mode("append").save(folder)


def slabs(dense: DataFrame, shape: tuple[int, int, int], sides: tuple[int, int, int] = bricks.VOLUME, turned: bool = False) -> DataFrame:
    """PAGES of bricks(path, c, i, j, k, data) of nodes of ``shape``: a row of as many pages as a brick is high. A page's rows are x and its columns y, or the other way if ``turned``.

    Bricks are shuffled to their stack and stream by in order of k, so a task holds one slab of a node. Several of one key give their greatest values.
    """
    sx, sy, sz = sides

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, slab = None, np.zeros((sz, -(-shape[0] // sx) * sx, -(-shape[1] // sy) * sy), np.uint16)

        def sent() -> pa.RecordBatch:
            z = now[2] * sz
            pages = slab[: min(sz, shape[2] - z), : shape[0], : shape[1]]
            pages = pages.transpose(0, 2, 1) if turned else pages
            return _batch([(*now[:2], z, shape[2], *pages.shape[1:], pages.astype("<u2", copy=False).tobytes())])

        for b in batches:
            cells = bricks.as_cells(b.column("data")).reshape(-1, sz, sy, sx)
            for n, (path, c, i, j, k) in enumerate(zip(*(b.column(x).to_pylist() for x in ("path", "c", *bricks.PLACE)), strict=True)):
                if now != (path, c, k):
                    if now:
                        yield sent()
                    now = (path, c, k)
                    slab[:] = 0
                place = slab[:, i * sx : (i + 1) * sx, j * sy : (j + 1) * sy]
                np.maximum(place, cells[n].transpose(0, 2, 1), out=place)
        if now:
            yield sent()

    key = ("path", "c", "k")
    return dense.select("path", "c", *bricks.PLACE, "data").repartition("path", "c").sortWithinPartitions(*key).mapInArrow(run, PAGES)


def as_bricks(pages: DataFrame) -> DataFrame:
    """Partial bricks(path, c, i, j, k, data) of pages; a page's rows are x, its columns y."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = bricks.Table(pa.schema([("path", pa.string()), ("c", pa.int32()), *((p, pa.int32()) for p in bricks.PLACE), ("data", pa.binary())]))
        for b in batches:
            for path, c, z, height, width, cell in zip(*(b.column(n).to_pylist() for n in ("path", "c", "z", "height", "width")), b.column("data"), strict=True):
                data = np.frombuffer(cell.as_buffer(), "<u2").reshape(-1, height, width)
                page, x, y = np.nonzero(data)
                table.add(np.zeros(len(x), np.int64), [(path, c)], [x, y, page + z], data[page, x, y])
                if len(table) > bricks.HELD:
                    yield table.taken()
        yield table.taken()

    return pages.select(*_NAMES).mapInArrow(run, "path string, c int, i int, j int, k int, data binary")


def save_voxels(found: DataFrame, folder: str, shape: tuple[int, int, int]) -> None:
    """Write voxels(path, c, x, y, z, v) as one stack of ``shape`` per path and channel."""
    save(slabs(bricks.merged(bricks.pack(found, ("path", "c")), ("path", "c")), shape), folder)


def voxels(pages: DataFrame) -> DataFrame:
    """(path, c, x, y, z, v) of the pixels over 0; a page's rows are x, its columns y."""
    names = ["path", "c", "x", "y", "z", "v"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for n in range(b.num_rows):
                height, width, z = (b.column(c)[n].as_py() for c in ("height", "width", "z"))
                data = np.frombuffer(b.column("data")[n].as_buffer(), "<u2").reshape(-1, height, width)
                page, x, y = np.nonzero(data)
                own = b.select(["path", "c"]).take(pa.array(np.full(len(x), n)))
                yield pa.RecordBatch.from_arrays([*own.columns, *(pa.array(a.astype(np.int32)) for a in (x, y, page + z, data[page, x, y]))], names)

    return pages.mapInArrow(run, "path string, c int, x int, y int, z int, v int")
