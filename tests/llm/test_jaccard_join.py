import random
import re
from collections import defaultdict

import pytest

from voxmill.llm import jaccard_join as jj
from voxmill.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(t, k):
    w = WORD.findall((t or "").translate(LOWER))
    n = min(k, len(w))
    return {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if w else set()


def brute(rows, k, percent):
    """Every pair that shares a shingle."""
    sets = {i: shingles(t, k) for i, t in rows}
    up = {i: i for i in sets}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        met = defaultdict(int)
        for x in s:
            for j in holders[x]:
                if j < i:
                    met[j] += 1
        for j, o in met.items():
            if 100 * o >= percent * (len(s) + len(sets[j]) - o):
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


@pytest.mark.parametrize(("size", "k", "percent"), [("sf0.001", 5, 80), ("sf0.1", 4, 85)])
def test_components_equal_brute_force(spark, size, k, percent):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], k, percent)
    assert got(jj.jaccard_components(docs, k=k, percent=percent)) == want


def edited(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
    return " ".join(words)


def test_families_around_the_threshold_in_small_groups(spark):
    rng = random.Random(5)
    rows = []
    for family in range(6):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([12, 60, 150]))]
        rows += [(len(rows) + i, edited(base, rng.choice([0, 0, 1, 1, 2, 3]), rng)) for i in range(60)]
    shared = " ".join(f"c{i}" for i in range(30))
    rows += [(len(rows) + i, shared + " " + " ".join(f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(40)))) for i in range(100)]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, n string")
    want = brute(rows, 4, 85)
    assert len({c for _, c in want.values()}) < len(rows)
    assert got(jj.jaccard_components(docs, k=4, percent=85, bundle=4, group_size=7, task_queries=5, slots=1 << 12)) == want


def test_edges(spark):
    rows = [(1, None), (2, ""), (3, " \t"), (4, "a b"), (5, "A  B"), (6, "a b c d"), (9, "a b c d"), (9, "a b c d"), (None, "a b"), (None, "a b")]
    docs = spark.createDataFrame([(i, t, "x", "y") for i, t in rows], "doc_id long, text string, rep string, component string")
    out = sorted(((r.doc_id or 0, r.n_shingles, r.component_id) for r in jj.jaccard_components(docs, k=4, percent=85).collect()), key=str)
    assert out == sorted([(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 1, 6), (9, 1, 6), (9, 1, 6), (0, 1, None), (0, 1, None)], key=str)
    assert jj.jaccard_components(docs.limit(0)).count() == 0
    assert sorted(str(r.doc_id) for r in jj.one_of_each(docs).collect()) == sorted(["1", "2", "3", "4", "6"])


def test_rows_are_told_apart_whatever_their_ids(spark):
    base, other, third = (" ".join(f"{c}{i}" for i in range(40)) for c in "abc")
    rows = [(6, base), (7, base), (7, other), (None, third), (None, other + " x"), (None, "alone here"), (8, third), (9, None), (9, None)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, component_id string, size int")
    kept = jj.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(6, base), (7, other), (8, third), (None, "alone here"), (9, None), (9, None)], key=str)


def test_a_large_family_is_joined_before_groups_are_opened(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = [(i, edited(base, i % 3, rng)) for i in range(400)]
    whole = spark.createDataFrame(rows, "doc_id long, text string")
    sets = jj.prefixes(whole, 4, 85, jj.gram_counts(whole, 4, 1 << 12))
    shared = jj.shared_prefixes(sets)
    members, pivots = jj.grouped(shared, 85, 16, 50)
    inside = members.select("id", "own").unionByName(pivots).distinct().selectExpr("id", "own AS g", "true AS query", "true AS member")
    parts = components(jj.verified(whole, inside, 4, 85))
    sizes = sorted((r["count"] for r in parts.groupBy("component").count().collect()), reverse=True)
    assert sizes[0] > 350
    # what the family's own members would open without contraction, and what is left to open
    alone = jj.opened_groups(shared, members, parts.limit(0), 85).count()
    assert jj.opened_groups(shared, members, parts, 85).count() < alone / 5
    assert got(jj.jaccard_components(whole, k=4, percent=85, bundle=16, group_size=50, task_queries=60)) == brute(rows, 4, 85)


def test_rows_with_a_common_phrase_alone_are_probed_with_nothing(spark):
    rng = random.Random(9)
    word = lambda: f"u{rng.randrange(10**9)}"
    phrase = "all rights reserved by us"
    rows = [(i, f"{phrase} {word()} {word()}" if i % 2 else f"{word()} {phrase} {word()}") for i in range(2000)]
    rows += [(3000, "all rights reserved by us in every land"), (3001, "all rights reserved by us in every land now")]
    whole = spark.createDataFrame(rows, "doc_id long, text string")
    sets = jj.prefixes(whole, 4, 85, jj.gram_counts(whole, 4, 1 << 12))
    shared = jj.shared_prefixes(sets, 85)
    assert {r.id for r in shared.collect()} <= {3000, 3001}
    assert got(jj.jaccard_components(whole, k=4, percent=85)) == brute(rows, 4, 85)


@pytest.mark.parametrize("percent", [50, 80, 85, 100])
def test_short_sets_of_all_sizes_and_overlaps(spark, percent):
    # sets of 1 to 12 shingles that share a beginning: every size meets every other
    rows = [(100 * n + own, " ".join([f"w{i}" for i in range(n)] + [f"own{n}x{own}x{i}" for i in range(own)])) for n in range(1, 13) for own in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(jj.jaccard_components(docs, k=2, percent=percent, bundle=3, group_size=5, task_queries=3, slots=1 << 12)) == brute(rows, 2, percent)


def test_a_long_chain_of_links(spark):
    pairs = [(i, i + 1) for i in range(1, 300)] + [(400, 500), (500, 450)]
    found = dict(tuple(r) for r in components(spark.createDataFrame(pairs, "a long, b long")).collect())
    assert found == {**dict.fromkeys(range(1, 301), 1), 400: 400, 450: 400, 500: 400}
