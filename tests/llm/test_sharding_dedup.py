import hashlib
import re
import zlib
from collections import defaultdict

import pytest

from voxmill.llm import exact_dedup, sharding

SPACE = re.compile(r"[\x20\x09-\x0D]")


def check(rows, texts, shards):
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(i) for i, _ in texts)
    known = defaultdict(set)
    for i, t in texts:
        known[i].add(t)
    slots, load = defaultdict(list), defaultdict(int)
    for r in rows:
        assert (r.size, r.text_crc32) in {(len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for t in known[r.doc_id]}
        assert 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        load[r.shard] += r.size
    for s in slots.values():
        assert sorted(s) == list(range(len(s)))
    return load, max((r.size for r in rows), default=0)


@pytest.mark.parametrize("ranges", [4, 64, 1024])
def test_shards_are_equal_to_within_a_record(spark, ranges):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = sharding.shard_documents(docs, 16, ranges).collect()
    load, most = check(rows, [tuple(r) for r in docs.select("doc_id", "text").collect()], 16)
    share = sum(load.values()) / 16
    assert len(load) == 16 and all(abs(x - share) <= most for x in load.values())


def test_a_hot_text_is_cut_and_others_stay_together(spark):
    texts = [(i, "hot " * 50) for i in range(600)] + [(600 + i, f"text {i // 2}" * 40) for i in range(1200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    rows = sharding.shard_documents(docs, 16, 64).collect()
    load, most = check(rows, texts, 16)
    assert max(load.values()) - min(load.values()) <= 2 * most
    where = defaultdict(set)
    for r in rows:
        where[r.text_crc32].add(r.shard)
    assert sum(len(s) > 1 for s in where.values()) <= 16
    bounds, filled = sharding.splitters(docs.select(sharding.record_key(docs.text, docs.doc_id).alias("key"), (docs.doc_id * 0 + 200).alias("size")), 64)
    assert max(b for _, b, _ in filled) <= 2 * 1800 * 200 / 64 and bounds == sorted(set(bounds))


def test_rows_law_and_edges(spark):
    texts = [(None, None), (None, None), (1, ""), (1, ""), (2, "x" * 100_000), (3, "é")]
    docs = spark.createDataFrame([(i, t, 1, 2, 3) for i, t in texts], "doc_id long, text string, key int, size int, shard int")
    check(sharding.shard_documents(docs, 4, 8).collect(), texts, 4)
    rows = sharding.shard_documents(docs, 4, 8, law="rows").collect()
    counts = defaultdict(int)
    for r in rows:
        counts[r.shard] += 1
    assert max(counts.values()) - min(counts.values()) <= 1 and len(counts) == 4
    assert sharding.shard_documents(docs.limit(0), 4).count() == 0
    with pytest.raises(ValueError):
        sharding.shard(docs, 4, law="none")


def test_written_shards_hold_all_rows(spark, tmp_path):
    rows = [(i // 2, f"text {i} " * (i % 40), i) for i in range(300)] + [(None, None, 1)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, shard int")
    sharding.write_shards(docs, f"{tmp_path}/out", 4, 16)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert sorted(map(str, back.drop("_shard").collect())) == sorted(map(str, docs.collect()))
    sizes = [r[0] for r in back.groupBy("_shard").agg({"text": "count"}).select("count(text)").collect()]
    assert len(sizes) == 4


def test_dedup_edges(spark):
    texts = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r"), (4, "a b"), (5, "ab"), (6, "a  b"), (7, "a  b"), (8, "A b"), (9, "é " * 70 + "x"), (10, "é " * 70 + "y"), (11, "a b"), (None, "q"), (None, "q"), (12, "q")]
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in texts], "doc_id long, text string, slot int, normal string")
    groups = defaultdict(list)
    for i, t in texts:
        groups[SPACE.sub("", t or "")].append((-len(t or ""), i is None, i or 0))
    got = exact_dedup.exact_dedup(docs, digests=True, slots=4).collect()
    assert len(got) == len(texts)
    for r, t in ((r, t) for r in got for i, t in texts if i == r.doc_id):
        g = groups[SPACE.sub("", t or "")]
        keep = min(g)
        assert (r.group_size, r.keep_id) == (len(g), None if keep[1] else keep[2])
        assert r.kept == (r.doc_id == r.keep_id)
        assert r.text_sha256 == hashlib.sha256(SPACE.sub("", t or "").encode()).hexdigest()
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0
    kept = exact_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({min(g)[2] for g in groups.values()})


def test_rows_that_share_an_id_are_kept_by_text(spark):
    rows = [(None, "a"), (None, "b"), (None, "c c"), (None, "c c"), (1, "a"), (2, "x"), (2, "y"), (3, "x "), (4, "z"), (4, "z"), (5, None), (5, ""), (6, "u"), (6, "v")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, _row int")
    kept = exact_dedup.kept_documents(docs)
    assert kept.columns == docs.columns
    want = [(None, "b"), (None, "c c"), (1, "a"), (2, "y"), (3, "x "), (4, "z"), (5, ""), (6, "u"), (6, "v")]
    assert sorted((str(r.doc_id), r.text or "") for r in kept.collect()) == sorted((str(i), t) for i, t in want)
