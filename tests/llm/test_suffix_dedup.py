import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from voxmill.llm import suffix_dedup as sd


def brute(texts, length):
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i : i + length] for r in raws for i in range(len(r) - length + 1))
    out = []
    for r in raws:
        gone = np.zeros(len(r) + 1, np.int8)
        for i in range(len(r) - length + 1):
            if seen[r[i : i + length]] > 1:
                gone[i] += 0
                gone[i : i + length] = 1
        spans = int((np.diff(np.concatenate(([0], gone[: len(r)], [0]))) == 1).sum())
        kept = bytes(b for b, g in zip(r, gone, strict=False) if not g)
        out.append((len(r), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(df, rows, length, **how):
    want = {}
    for (i, _), w in zip(rows, brute([t for _, t in rows], length), strict=True):
        want.setdefault(i, []).append(w)
    got = {}
    for r in sd.remove_repeats(df, length, **how).collect():
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256))
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    return want


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_whole_table_equals_brute_force(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").select("doc_id", "text")
    check(docs, [tuple(r) for r in docs.collect()], 200, **({"bucket": 20, "crowd": 20} if size == "sf0.001" else {}))


@pytest.mark.parametrize("bucket", [1, 3, 4096])
def test_shared_passages_at_the_bound(spark, bucket):
    rng, rows = random.Random(bucket), []
    word = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    passages = [word(n) for n in (38, 39, 40, 41, 60, 150)]
    for i in range(80):
        parts = [word(rng.randrange(60)), rng.choice(passages), word(rng.randrange(60)), rng.choice([*passages, ""])]
        rows.append((i, "".join(parts)))
    rows += [(100, "z" * 39), (101, "z" * 40), (102, "z" * 41), (103, "yx" * 60), (104, None), (105, ""), (None, passages[4]), (None, passages[4]), (106, word(30) * 9)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, rk string, lo int")
    want = check(docs, rows, 40, k=16, bucket=bucket, crowd=bucket, slots=16)
    assert sum(w[1] > 0 for v in want.values() for w in v) > 40
    assert sd.remove_repeats(docs.limit(0)).count() == 0


@pytest.mark.parametrize("crowd", [1, 4096])
def test_classes_whose_hashes_agree_by_accident_are_split(spark, crowd):
    # without a single bit of hash every anchor is one class; each passage stands in two rows, so its anchors have two runs
    rng, rows = random.Random(11), []
    word = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    for i in range(40):
        passage = word(rng.choice([39, 40, 44, 70]))
        rows += [(2 * i, word(30) + passage + word(30)), (2 * i + 1, word(20) + passage + word(rng.randrange(30)))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = check(docs, rows, 40, k=16, bucket=3, crowd=crowd, bits=0)
    assert 30 < sum(w[1] > 0 for v in want.values() for w in v) < 80


def test_suffix_sort():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 4000).astype(np.uint8)
    s = sd.Suffixes(data, 25)
    starts = np.arange(3900)
    cell = np.sort(rng.integers(0, 40, len(starts)))
    got = s.sort(starts, cell)
    key = lambda i: data[i : i + 25].tobytes()
    for c in np.unique(cell):
        own = starts[cell == c].tolist()
        assert [key(i) for i in got[cell == c]] == sorted(map(key, own))
        assert sorted(got[cell == c].tolist()) == own
    p, q = rng.integers(0, 3900, 500), rng.integers(0, 3900, 500)
    plain = [next((n for n in range(25) if data[a + n] != data[b + n]), 25) for a, b in zip(p, q, strict=True)]
    assert s.common(p, q).tolist() == plain
