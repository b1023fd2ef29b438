"""The stack source and sink: pages read in parts, files committed whole."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from voxmill.operators import bricks
from voxmill.sources import stacks, tiff


def files_below(folder):
    return sorted(os.path.relpath(os.path.join(d, f), folder) for d, _, names in os.walk(folder) for f in names)


def some_bricks(spark, shape, nodes=("1/2/default", "default")):
    rng = np.random.default_rng(2)
    rows = [(p, c, *(int(rng.integers(0, s)) for s in shape), int(rng.integers(1, 65536))) for p in nodes for c in (0, 2) for _ in range(500)]
    v = spark.createDataFrame(rows, "path string, c int, x int, y int, z int, v int").groupBy("path", "c", "x", "y", "z").agg(F.max("v").alias("v"))
    return v, bricks.merged(bricks.pack(v, ("path", "c")), ("path", "c"))


@pytest.mark.parametrize("scheme", ["", "file:", "file://"])
def test_a_uri_and_a_plain_path_are_the_same_place(spark, tmp_path, scheme):
    v, dense = some_bricks(spark, (20, 35, 40))
    target = tmp_path / "out"
    stacks.save(stacks.slabs(dense, (20, 35, 40)), f"{scheme}{target}")
    assert files_below(target) == ["1/2/default.0.tif", "1/2/default.2.tif", "default.0.tif", "default.2.tif"]
    want = sorted(tuple(r) for r in v.collect())
    for place in (str(target), f"file://{target}"):
        got = stacks.voxels(stacks.load(spark, place, 5000))
        assert sorted(tuple(r) for r in got.collect()) == want
    whole = tiff.decode((target / "default.0.tif").read_bytes())
    assert whole.shape == (40, 20, 35)


def test_only_the_pages_of_a_range_are_read(spark, tmp_path, monkeypatch):
    v, dense = some_bricks(spark, (20, 35, 40))
    stacks.save(stacks.slabs(dense, (20, 35, 40)), str(tmp_path))
    found = stacks.load(spark, str(tmp_path), 20_000).where("c = 2 AND z >= 7 AND z < 12 AND path = 'default'")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert ">= 7" not in plan and "= default" not in plan and ">= 7" in found._jdf.queryExecution().analyzed().toString(), plan
    want = sorted(tuple(r) for r in v.where("c = 2 AND z >= 7 AND z < 12 AND path = 'default'").collect())
    assert sorted(tuple(r) for r in stacks.voxels(found).collect()) == want
    # the same reader here, where its page reads can be counted
    reader = stacks.StackReader({"path": str(tmp_path), "partbytes": "20000"})
    left = list(reader.pushFilters([stacks.EqualTo(("c",), 2), stacks.GreaterThanOrEqual(("z",), 7), stacks.LessThan(("z",), 12), stacks.EqualTo(("height",), 20)]))
    assert [f.attribute for f in left] == [("height",)]
    read, plain = [], stacks.page
    monkeypatch.setattr(stacks, "page", lambda *a: read.append(1) or plain(*a))
    parts = reader.partitions()
    assert {f.c for p in parts for f in p.parts} == {2} and len(parts) == 2 * 4
    assert [len(p.parts) for p in stacks.StackReader({"path": str(tmp_path)}).partitions()] == [4]
    rows = [r for p in parts for b in reader.read(p) for r in b.to_pylist()]
    assert len(read) == len(rows) == 2 * 5 and {r["z"] for r in rows} == set(range(7, 12))


def test_what_other_writers_write(spark, tmp_path):
    """Big-endian pages in several strips."""
    import struct

    page = np.arange(12, dtype=">u2").reshape(3, 4)
    strips = [page[:2].tobytes(), page[2:].tobytes()]
    raw = b"MM\0*" + struct.pack(">I", 8)
    data_at = 8 + 2 + 12 * 6 + 4 + 16
    offsets = struct.pack(">II", data_at, data_at + len(strips[0]))
    counts = struct.pack(">II", *map(len, strips))
    tags = [(256, 3, 1, struct.pack(">HH", 4, 0)), (257, 3, 1, struct.pack(">HH", 3, 0)), (258, 3, 1, struct.pack(">HH", 16, 0)), (259, 3, 1, struct.pack(">HH", 1, 0)),
            (273, 4, 2, struct.pack(">I", data_at - 16)), (279, 4, 2, struct.pack(">I", data_at - 8))]
    raw += struct.pack(">H", 6) + b"".join(struct.pack(">HHI", t, k, n) + v for t, k, n, v in tags) + struct.pack(">I", 0) + offsets + counts + b"".join(strips)
    (tmp_path / "m.1.tif").write_bytes(raw)
    row = stacks.load(spark, str(tmp_path)).first()
    assert (row.path, row.c, row.z, row.depth, row.height, row.width) == ("m", 1, 0, 1, 3, 4)
    assert np.array_equal(np.frombuffer(row.data, "<u2").reshape(3, 4), page)
    (tmp_path / "bad.0.tif").write_bytes(b"nothing of the kind")
    with pytest.raises(Exception, match="not a TIFF"):
        stacks.load(spark, str(tmp_path)).count()


def test_a_failed_write_leaves_no_file(spark, tmp_path):
    one = [("a", 0, 0, 2, 2, 2, bytes(16)), ("b/c", 0, 0, 1, 2, 2, bytes(8))]
    stacks.save(spark.createDataFrame(one, stacks.PAGES), str(tmp_path))
    before = files_below(tmp_path)
    assert before == ["a.0.tif", "b/c.0.tif"]
    for bad in [("d", 0, 1, 1, 2, 2, bytes(8)), ("../d", 0, 0, 1, 2, 2, bytes(8)), ("d", 0, 0, 1, 2, 2, bytes(7))]:
        with pytest.raises(Exception, match="page|outside"):
            stacks.save(spark.createDataFrame([("a0", 0, 0, 1, 2, 2, bytes(8)), ("a1", 0, 0, 1, 2, 2, bytes(8)), bad], stacks.PAGES).coalesce(1), str(tmp_path))
        assert files_below(tmp_path) == before
    # a killed attempt's staged files go with the staging folder
    writer = stacks.StackWriter({"path": str(tmp_path)})
    rows = stacks._batch([("k", 0, 0, 1, 2, 2, bytes(8))])
    writer.write(iter([rows]))
    done = writer.write(iter([rows]))
    writer.commit([done, None])
    assert files_below(tmp_path) == [*before, "k.0.tif"]


def test_pages_without_rows_are_dark(spark, tmp_path):
    stacks.save(spark.createDataFrame([("a", 0, 2, 5, 1, 2, b"\1\0\2\0")], stacks.PAGES), str(tmp_path))
    assert tiff.decode((tmp_path / "a.0.tif").read_bytes()).tolist() == [[[0, 0]], [[0, 0]], [[1, 2]], [[0, 0]], [[0, 0]]]
