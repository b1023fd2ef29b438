import random
import zlib

from voxmill.llm import toxicity as tox

RUDE = ["blockhead", "numbskull", "dimwit"]


def made(n, seed=1):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        words = [f"w{rng.randrange(300)}x" for _ in range(rng.randrange(5, 80))]
        toxic = rng.random() < 0.3
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(RUDE))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_held_out_rows_are_told_apart(spark):
    rows = made(1500)
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in rows], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in tox.score_documents(docs, labels).collect()}
    assert len(got) == len(rows)
    for i, _, _ in rows:
        assert got[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= got[i].score <= 1 and got[i].predicted == int(got[i].score >= 0.5)
    held = [(got[i].predicted, y) for i, _, y in rows if got[i].held_out]
    assert sum(p == y for p, y in held) >= 0.97 * len(held)


def test_held_out_labels_are_never_read(spark):
    rows = made(600)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    wrong = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, _, y in rows]
    a, b = ({r.doc_id: r.score for r in tox.score_documents(docs, spark.createDataFrame(ls, "doc_id long, toxic int")).collect()} for ls in ([(i, y) for i, _, y in rows], wrong))
    assert a == b


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "a"), (4, "b " * 50_000), (4, "b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [round(r.score, 3) for r in tox.score_documents(docs, none).collect()] == [0.1] * 5
    one = spark.createDataFrame([(1, 1), (2, 1), (4, None)], "doc_id long, toxic int")
    assert tox.score_documents(docs, one).count() == 5
    assert tox.score_documents(docs.limit(0), none).count() == 0


def test_features_of_words():
    lexicon = {"dimwit": 2.0, "block~": 1.0}
    assert tox.features_of("", lexicon) == tox.features_of(" \n", lexicon) == [0.0] * tox.FEATURES
    f = tox.features_of("You d1mw1t, Blockheads!! x y", lexicon)
    assert f[0] == 2 / 5 and f[3] == 2.0 and f[5] == 2 / 5 and f[12] == 1 / 5
