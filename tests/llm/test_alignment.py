import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from voxmill.llm import alignment, tokens

ODD = [None, "", " ", "a", "\n\n a", "é😀 <|endoftext|> <s> </s> <0x41> x", "▁ under", "a" * 5000, "word " * 3000, "x  \t\n  y\r\n", "1234567890 " * 300, "日本語のテキスト", "\u0000 nul", "é ﬁ ²", "word " * 3000]


@pytest.fixture(scope="module")
def encoders():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def letters():
    """The byte of each letter of a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def brute_force(rows, encoders):
    """The contract, token by token."""
    a, b = encoders
    byte_of, entry = letters(), {i: t for t, i in a.get_vocab().items()}
    docs, counts = [], Counter()
    for doc_id, text in rows:
        ids_a, ids_b = [], []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        raw_a = [bytes(byte_of[c] for c in entry[i]) for i in ids_a]
        raw_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        want = f" {text or ''}".encode()
        if not text or b"".join(raw_a) != want or b"".join(raw_b) != want:
            docs.append((doc_id, [], [], [], ""))
            continue
        spans = []
        for ids, raw in ((ids_a, raw_a), (ids_b, raw_b)):
            ends = np.cumsum([len(x) for x in raw]).tolist()
            spans.append([(i, e - len(x), e) for i, x, e in zip(ids, raw, ends, strict=True)])
        links, j = [], 0
        for i, s, e in spans[0]:
            while spans[1][j][2] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][1] < e:
                links.append((i, spans[1][k][0]))
                k += 1
        cuts = sorted({e for *_, e in spans[0]} & {e for *_, e in spans[1]})
        groups = []
        at = [0, 0]
        for c in cuts:
            sides = []
            for k in (0, 1):
                side = []
                while at[k] < len(spans[k]) and spans[k][at[k]][2] <= c:
                    side.append(str(spans[k][at[k]][0]))
                    at[k] += 1
                sides.append(",".join(side))
            groups.append("|".join(sides))
        counts.update(links)
        docs.append((doc_id, ids_a, ids_b, links, hashlib.sha256(";".join(groups).encode()).hexdigest(), len(groups)))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return sorted(
        (d[0], len(d[1]), len(d[2]), d[5] if len(d) > 5 else 0, len(d[3]), sum(counts[x] == best[x[1]] for x in d[3]), sum(counts[x] for x in d[3]), d[4])
        for d in docs
    )


def rows_of(found):
    assert found.columns == alignment.RESULT
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("table", [0, 100, 1 << 19])
def test_as_token_by_token(spark, encoders, table):
    """Whatever the table of common pairs holds."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = brute_force([(r.doc_id, r.text) for r in docs.collect()], encoders)
    assert rows_of(alignment.align(docs.repartition(3), table=table)) == want


def test_odd_texts(spark, encoders):
    rows = list(enumerate(ODD))
    docs = spark.createDataFrame([(i, t, 1, "x", 2) for i, t in rows], "doc_id int, text string, pairs int, rk string, n_a int")
    want = brute_force(rows, encoders)
    assert rows_of(alignment.align(docs)) == want
    assert [x for x in want if x[0] in (0, 1, 6)] == [(i, 0, 0, 0, 0, 0, 0, "") for i in (0, 1, 6)]
    assert alignment.align(docs.limit(0)).count() == 0
    twice = alignment.align(spark.createDataFrame([(None, "a b"), (None, "a b"), (None, None)], "doc_id long, text string")).collect()
    assert sorted(r.n_a for r in twice) == [0, 2, 2] and {r.count_sum for r in twice if r.n_a} == {4}


def test_lanes_of_any_length(monkeypatch, encoders):
    rng = np.random.default_rng(5)
    ends = [np.sort(rng.choice(np.arange(1, 3000), 900, replace=False)) for _ in range(2)]
    ends = [np.append(e[e < 3000], 3000) for e in ends]
    firsts = np.array([0, 0, len(ends[0]), len(ends[0])])
    seen = []
    for lane in (1, 7, 128, 10_000):
        monkeypatch.setattr(alignment, "LANE", lane)
        a, b, cut_a, cut_b = alignment.lockstep(*ends, firsts)
        assert (ends[0][cut_a] == ends[1][cut_b]).all()
        seen.append((sorted(zip(a.tolist(), b.tolist(), strict=True)), np.flatnonzero(cut_a).tolist()))
    assert all(x == seen[0] for x in seen)


@pytest.mark.parametrize("text", [" " * 2_000_000 + "x", "\n" * 2_000_000, "a" * 1_000_000, "7" * 1_000_000, "ab " * 700_000])
def test_very_long_texts_have_the_librarys_ids(text, encoders):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = library.encode(text, add_special_tokens=False).ids
    assert tokens.encoder().encode(text).tolist() == want
    assert tokens.encoder(plain=True).encode(text).tolist() == want
