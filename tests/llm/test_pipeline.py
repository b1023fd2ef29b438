"""Each stage of the pipeline against a plain version over the rows it was given."""

import re

from tests.llm.test_decontamination import brute as leaks
from tests.llm.test_jaccard_join import brute as families

SPACE = re.compile(r"[\x20\x09-\x0D]")


def test_stages(spark, tmp_path):
    import corpus_pipeline as p
    from voxmill.llm import toxicity

    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    held = {}
    for name, stage in p.STAGES:
        out = f"{tmp_path}/{name}"
        stage(spark, docs, folder).write.parquet(out)
        held[name] = (docs, spark.read.parquet(out))
        docs = held[name][1]
    for name, (before, after) in list(held.items())[:-1]:
        assert after.columns == before.columns, name
        assert after.exceptAll(before).count() == 0, name
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    rows = lambda df: [tuple(r) for r in df.select("doc_id", "text").collect()]

    before, after = held["toxicity"]
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert ids(after) == {r.doc_id for r in toxicity.score_documents(before, labels).where("predicted = 0").collect()}

    before, after = held["exact_dedup"]
    best = {}
    for i, t in rows(before):
        best[SPACE.sub("", t or "")] = min(best.get(SPACE.sub("", t or ""), (0, 1 << 62)), (-len(t or ""), i))
    assert ids(after) == {i for _, i in best.values()}

    before, after = held["jaccard_join"]
    assert ids(after) == {c for _, c in families(rows(before), 5, 80).values()}

    before, after = held["decontamination"]
    bench = rows(spark.read.parquet(f"{folder}/benchmark.parquet").withColumnRenamed("item_id", "doc_id"))
    assert ids(after) == ids(before) - {d for d, _ in leaks(rows(before), bench)}

    before, after = held["packing"]
    assert ids(after) == ids(before)
    assert after.groupBy("sequence_id").sum("length").where("`sum(length)` > 2048").count() == 0


def test_clashing_columns_and_nulls(spark, tmp_path):
    import corpus_pipeline as p

    rows = [(1, None, "x", 1, 1), (2, "", "x", 1, 1), (None, "a b", None, 2, 2), (3, "same text here", "y", 3, 3), (4, "same text  here", "y", 4, 4)]
    schema = "doc_id long, text string, score string, n long, id int"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = spark.createDataFrame(rows, schema)
    empty = docs.limit(0)
    for _, stage in p.STAGES[:-1]:
        kept = stage(spark, docs, str(tmp_path))
        assert kept.columns == docs.columns
        assert stage(spark, empty, str(tmp_path)).count() == 0
        docs = kept
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "4", "None"]
    assert p.STAGES[-1][1](spark, docs, str(tmp_path)).count() == 3


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    import pytest

    from voxmill.llm.common import shared_folder

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default: default)))
