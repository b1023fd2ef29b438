import math
import re

import numpy as np

from voxmill.llm import decontamination as de
from voxmill.llm import shingles as sh

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def brute(docs, items, k=5, threshold=0.8):
    """Best window by weighted Jaccard over every start, with the weights of the docstring."""
    sets = {}
    for i, t in items:
        w = words(t)
        if w:
            n = min(k, len(w))
            sets[i] = (len(w), {tuple(w[j : j + n]) for j in range(len(w) - n + 1)})
    known = {x for _, s in sets.values() for x in s}
    df = dict.fromkeys(known, 0)
    sizes = {len(x) for x in known}
    held = []
    for d, t in docs:
        w = words(t)
        has = {tuple(w[j : j + n]) for n in sizes for j in range(len(w) - n + 1)} & known
        for x in has:
            df[x] += 1
        held.append((d, w, has))
    weight = {x: math.log1p(len(docs) / max(c, 1)) for x, c in df.items()}
    out = {}
    for d, w, has in held:
        for i, (size, own) in sets.items():
            if not own & has:
                continue
            n, span = min(k, size), min(size, len(w))
            mean = sum(weight[x] for x in own) / len(own)
            best = 0
            for s in range(len(w) - span + 1):
                win = {tuple(w[j : j + n]) for j in range(s, s + span - n + 1)}
                both = sum(weight[x] for x in own & win)
                union = sum(weight[x] for x in own) + sum(weight.get(x, mean) for x in win - own)
                best = max(best, both / union)
            if best >= threshold:
                out[d, i] = best
    return out


def test_hits_equal_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    docs, bench = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/benchmark.parquet")
    got = {(r.doc_id, r.item_id): r.similarity for r in de.contaminated(docs, bench).collect()}
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [tuple(r) for r in bench.select("item_id", "text").collect()])
    assert got.keys() == want.keys() and got
    assert all(abs(got[k] - want[k]) < 1e-9 for k in got)


def test_blocks_of_items_change_nothing(spark):
    """Items share passages, so what a window holds of the benchmark is not only its block's."""
    rng = np.random.default_rng(12)
    word = lambda: f"w{rng.integers(10**6)}"
    common = [[word() for _ in range(30)] for _ in range(4)]
    items = [(i, " ".join([*(word() for _ in range(40)), *common[i % 4][: rng.integers(8, 20)]])) for i in range(24)]
    docs = []
    for i, (_, text) in enumerate(items):
        own = text.split()
        for cut in (0, 5, 7, 9):
            # the item, with its last words replaced by those of a passage that others hold
            docs.append((len(docs), " ".join([word() for _ in range(9)] + own[: len(own) - cut] + common[(i + 1) % 4][:cut] + [word() for _ in range(9)])))
    docs += [(len(docs) + k, f"{' '.join(c)} and more of {word()}") for k in range(30) for c in (common[k % 4],)]
    frame, bench = spark.createDataFrame(docs + docs[:5], "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = brute(docs + docs[:5], items)
    seen = []
    for size in (1, 7, 1000):
        rows = sorted(tuple(r) for r in de.contaminated(frame, bench, block_items=size).collect())
        assert {(d, i) for d, i, *_ in rows} == want.keys() and all(abs(v - want[d, i]) < 1e-9 for d, i, v, *_ in rows)
        seen.append(rows)
    assert seen[0] == seen[1] == seen[2] and len(seen[0]) > len({r[:2] for r in seen[0]}) > 24


def test_edges(spark):
    item = " ".join(f"w{i}" for i in range(40))
    changed = item.replace("w1 ", "x ")
    far = " ".join(f"v{i}" for i in range(40))
    items = [(1, item), (2, None), (3, ""), (4, "Two Words"), (5, item)]
    texts = {1: f"before {item.upper()}\tafter", 2: changed, 3: far, 4: None, 5: "", 6: "we say two\nwords here", 7: "two", 8: far * 2000 + " " + item, None: item}
    docs = spark.createDataFrame([(i, t, 5) for i, t in texts.items()] + [(3, far, 5)], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, doc_id string")
    got = {(r.doc_id, r.item_id) for r in de.contaminated(docs, bench).collect()}
    assert got == {(1, 1), (1, 5), (2, 1), (2, 5), (6, 4), (8, 1), (8, 5), (None, 1), (None, 5)}
    blocks = {(r.doc_id, r.item_id) for r in de.contaminated(docs, bench, block_items=1).collect()}
    assert blocks == got
    assert de.contaminated(docs.limit(0), bench).count() == 0
    assert de.contaminated(docs, bench.limit(0)).count() == 0
    assert sorted((r.doc_id or 0) for r in de.clean_documents(docs, bench).collect()) == [3, 3, 4, 5, 7]


def test_blocks_find_every_fingerprint_within_the_radius():
    rng = np.random.default_rng(3)
    items = de.Items([(i, " ".join(map(str, rng.integers(0, 10**6, 30)))) for i in range(200)], 5)
    items.weigh(np.ones(len(items.known), int), 10, 22)
    prints = items.by_size[30][0]
    probes = np.concatenate([prints, rng.integers(0, 1 << 63, 300, dtype=np.uint64)])
    for p in range(200):
        for bit in rng.choice(64, rng.integers(0, 23), replace=False):
            probes[p] ^= np.uint64(1) << np.uint64(bit)
    window, item, distance = items.candidates(30, probes)
    got = set(zip(window.tolist(), item.tolist(), distance.tolist(), strict=True))
    d = np.bitwise_count(probes[:, None] ^ prints[None, :])
    assert got == {(int(a), int(b), int(d[a, b])) for a, b in zip(*np.nonzero(d <= 22), strict=True)}


def test_word_hashes_follow_the_words():
    texts = ["a B  c", "", "b\tA c\n", " x", "éa É", "c b a " * 50]
    raw = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raw), np.uint8)
    h, starts = sh.words(data, np.append(0, np.cumsum([len(r) for r in raw])))
    seen = {}
    for i, t in enumerate(texts):
        w = words(t)
        assert starts[i + 1] - starts[i] == len(w)
        for x, y in zip(w, h[starts[i] : starts[i + 1]], strict=True):
            assert seen.setdefault(x, y) == y
    assert len(set(seen.values())) == len(seen)
    g, begins = sh.gram_batch(h, starts, 3)
    for i, t in enumerate(texts):
        assert np.array_equal(g[begins[i] : begins[i + 1]], sh.grams(h[starts[i] : starts[i + 1]], 3))


def test_copies_of_an_item_in_a_third_of_the_documents_are_found():
    rng = np.random.default_rng(5)
    word = lambda: f"w{rng.integers(10**6)}"
    texts = [[word() for _ in range(39)] for _ in range(200)]
    items = de.Items([(i, " ".join(t)) for i, t in enumerate(texts)], 5)
    df = np.ones(len(items.known), int)
    common = range(20)
    for i in common:
        df[np.searchsorted(items.known, items.sets[i])] = 160_000 // 3
    items.weigh(df, 160_000, de.RADIUS)
    weight = de.weights_of(df, 160_000)
    pairs = 0
    for i in [*common, *range(100, 120)]:
        for changed in range(4):
            for front in (False, True):
                copy = list(texts[i])
                for j in range(changed):
                    copy[j if front else -1 - j] = word()
                g = sh.grams(de._words(text := " ".join([word() for _ in range(20)] + copy + [word() for _ in range(20)]))[0], 5)
                best = max(items.similarity(np.unique(g[s : s + 35]), i, items.known, weight) for s in range(len(g) - 34))
                got = {m[0]: m[1] for m in de.matches(text, items, 0.8, items.known, weight)}
                assert best >= 0.8 and abs(got.get(i, 0) - best) < 1e-9, (i, changed, front)
                pairs += 1
    assert pairs == 320


def test_a_window_votes_once_per_distinct_shingle():
    rng = np.random.default_rng(6)
    for size in (1, 3, 50, 1000):
        h = rng.integers(0, size, 200).astype(np.uint64)
        rows = rng.integers(-1000, 1000, (size, 7)).astype(float)[h.astype(int)]
        for n in (1, 2, 17, 200):
            starts = np.arange(0, 200 - n + 1, 2)
            want = [sum({int(x): rows[s + k] for k, x in enumerate(h[s : s + n])}.values()) for s in starts]
            assert np.array_equal(de.window_sums(rows, h, n, starts), np.array(want))


def test_clean_rows_stay_whatever_their_ids(spark):
    item = " ".join(f"w{i}" for i in range(40))
    rows = [(None, item), (None, "clean a"), (None, None), (1, "clean b"), (1, f"x {item}"), (1, "clean b")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, _row int")
    kept = de.clean_documents(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == [("1", "clean b"), ("1", "clean b"), ("None", "None"), ("None", "clean a")]
