import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from voxmill.llm import packing, token_counts, tokens

ODD = [None, "", " ", "\n\n a", "é😀 <|endoftext|> x", "a" * 5000, "word " * 3000, "x  \t\n  y\r\n", "1234567890 " * 300]


@pytest.fixture(scope="module")
def reference_ids():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda texts: [e.ids for e in t.encode_batch_fast([x or "" for x in texts], add_special_tokens=False)]


def check(pieces, texts, reference_ids, window):
    want = {i: np.array([*ids, 1], "<u4") for i, ids in zip(texts, reference_ids(list(texts.values())), strict=True)}
    by_doc, by_seq = {}, {}
    for p in pieces:
        by_doc.setdefault(p.doc_id, []).append(p)
        by_seq.setdefault(p.sequence_id, []).append(p)
    assert set(by_doc) == set(want)
    for i, ps in by_doc.items():
        at = 0
        for p in sorted(ps, key=lambda p: p.start):
            assert p.start == at and p.length > 0 and p.doc_tokens == len(want[i])
            assert p.ids_crc32 == zlib.crc32(want[i][at : at + p.length].tobytes())
            at += p.length
        assert at == len(want[i])
    short = 0
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= window
        short += at < window
    return short, len(by_seq)


def test_every_id_lies_in_one_piece(spark, reference_ids):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    short, all_ = check(packing.pack(docs, shard_tokens=1 << 17).collect(), texts, reference_ids, 2048)
    assert short <= all_ * 0.05


def test_odd_texts(spark, reference_ids):
    rows = [(i, t, 1) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start int")
    check(packing.pack(docs, window=64).collect(), dict(enumerate(ODD)), reference_ids, 64)
    assert packing.pack(docs.limit(0)).count() == 0
    assert packing.pack(spark.createDataFrame([(None, "a"), (None, "a")], "doc_id long, text string")).count() == 2


def test_neighbours_share_a_window():
    a, b = np.arange(100, 140, dtype="<u2"), np.arange(200, 240, dtype="<u2")
    pieces = packing.pack_shard([a, b, b.copy(), a.copy()], np.ones(300), 40.0, 80)
    where = {}
    for d, _, _, seq, _ in pieces:
        where.setdefault(seq, set()).add(d)
    assert sorted(map(sorted, where.values())) == [[0, 3], [1, 2]]


def bm25(docs, idf, mean, query, i):
    """The score of document i for the distinct terms of a query, term by term."""
    total = 0.0
    for t in set(query.tolist()):
        tf = int((docs[i] == t).sum())
        total += idf[t] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(docs[i]) / mean)) if tf else 0.0
    return total


def test_scores_and_order_equal_plain_bm25():
    rng = np.random.default_rng(2)
    docs = [np.minimum(rng.zipf(1.3, rng.integers(5, 90)), 399).astype("<u2") for _ in range(120)]
    idf, mean = rng.random(400).astype(np.float32) + 0.1, float(np.mean([len(d) for d in docs]))
    members = np.flatnonzero(rng.random(120) < 0.7)
    index = packing.Index([packing.counted(d) for d in docs], np.array([len(d) for d in docs]), idf, mean, members)
    for seed in range(0, 120, 7):
        plain = np.array([bm25(docs, idf, mean, docs[seed], i) for i in members])
        score = index.scores(packing.counted(docs[seed])[0])
        assert np.allclose(score, plain, rtol=1e-4)
        order = list(packing.in_order(score))
        assert sorted(order) == list(range(len(members))) and (np.diff(score[order]) <= 0).all()


def test_a_window_takes_its_seed_s_best_neighbours_whatever_their_number():
    rng = np.random.default_rng(3)
    topics = [np.arange(50 * k, 50 * k + 50) for k in range(4)]
    docs = [rng.choice(topics[i % 4], 20).astype("<u2") for i in range(400)]
    pieces = packing.pack_shard(docs, np.ones(300), 20.0, 2000)
    topic_of = {}
    for d, _, _, seq, _ in pieces:
        topic_of.setdefault(seq, []).append(d % 4)
    # a hundred documents a window, all of its seed's topic
    assert sorted(len(v) for v in topic_of.values()) == [100] * 4 and all(len(set(v)) == 1 for v in topic_of.values())


def test_copies_share_a_key_more_often_than_others():
    rng = np.random.default_rng(4)
    costs = packing.sketch_costs(rng.random(5000) + 0.5)
    base = [rng.integers(0, 5000, 200).astype("<u2") for _ in range(300)]
    near = [np.where(rng.random(200) < 0.05, rng.integers(0, 5000, 200), b).astype("<u2") for b in base]
    same = np.mean([packing.sketch_key(a, costs) == packing.sketch_key(b, costs) for a, b in zip(base, near, strict=True)])
    assert same > 0.8


def test_a_heavy_token_is_spread():
    first, spread = packing.shard_plan(np.array([0, 5, 5, 95, 5]), 10)
    assert spread.tolist() == [1, 1, 1, 10, 1]
    assert first[4] >= first[3] + 10


def brute(text, starts, rule, enc):
    raw = text.encode()
    at = [len(text[:s].encode()) for s in starts] + [len(raw)]
    owner = [next(k for k in range(len(starts)) if at[k] <= i < at[k + 1]) for i in range(len(raw))]
    counts, pos = [0] * len(starts), 0
    for t in enc.encode(text):
        span = owner[pos : pos + int(enc.n_bytes[t])]
        pos += len(span)
        counts[{"first": span[0], "last": span[-1], "most": max(sorted(set(span)), key=span.count)}[rule]] += 1
    return counts


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_counts_equal_byte_by_byte_attribution(spark, rule):
    enc = tokens.encoder()
    texts = [*ODD, "ab\ncd\n", "\n\n\n", "one\n\ntwo  \nthree é\n😀😀"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, section string")
    got = {}
    for r in token_counts.count_tokens(docs, rule=rule).collect():
        got.setdefault(r.doc_id, []).append(r)
    for i, t in enumerate(texts):
        rows = sorted(got[i], key=lambda r: r.section)
        starts = [r.start for r in rows]
        assert starts == token_counts.line_starts(t or "").tolist()
        assert [r.n_tokens for r in rows] == (brute(t, starts, rule, enc) if t else [0])
        assert sum(r.n_tokens for r in rows) == rows[0].doc_tokens


def test_given_sections(spark):
    rows = [(1, "alpha beta", [3, 3, 99, -1]), (2, "alpha", None), (3, None, [1])]
    got = token_counts.count_tokens(spark.createDataFrame(rows, "doc_id long, text string, at array<int>"), "at", "first").collect()
    assert sorted((r.doc_id, r.start, r.end) for r in got) == [(1, 0, 3), (1, 3, 10), (2, 0, 5), (3, 0, 0)]
    assert token_counts.count_tokens(spark.createDataFrame([], "doc_id long, text string")).count() == 0
