import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest

from voxmill.llm import prefix_trie
from voxmill.llm.queries import ORACLES, op12_prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "conv_id long, turn long, role string, text string, n_convs int, path string"


def brute_force(rows, every=20):
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            turns[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(t)] for c, t in turns.items()}
    whole = {}
    for c, t in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - c % every, [])[:h] + t[h:] if every else t
    nodes = defaultdict(list)
    for c, t in whole.items():
        for d in range(len(t) + 1):
            nodes[tuple(t[:d])].append(c)
    below = {}
    for p in sorted(nodes, key=len, reverse=True):
        kids = [q for q in nodes if len(q) == len(p) + 1 and q[: len(p)] == p] if len(nodes) < 3000 else []
        leaves = sum(below[q][1] for q in kids) or 1
        words = len(WORD.findall(p[-1][1])) if p else 0
        below[p] = (len(kids), leaves, sum(below[q][2] for q in kids) + (len(nodes[p]) - 1) * words)
    out = []
    for p, members in nodes.items():
        ends = sorted(c for c in members if len(whole[c]) == len(p))
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else -1, len(members), *below[p], digest))
    return sorted(out)


def rows_of(found):
    return sorted(tuple(-1 if v is None else v for v in r) for r in found.collect())


def planted(n, seed):
    """Conversations that share turns in many ways: copies, prefixes of others, long chains."""
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        kind = rng.random()
        length = 0 if kind < 0.05 else 30 if kind < 0.1 else rng.randrange(1, 6)
        for t in range(length):
            rows.append((c, t, rng.choice(["user", "assistant"]) if t > 1 else "user", f"w{rng.randrange(2)} x" if t < 4 else "same words here", 1, "x"))
    return rows


@pytest.mark.parametrize(("turns", "every"), [(1, 20), (7, 20), (8192, 20), (3, None)])
def test_as_prefix_by_prefix(spark, turns, every):
    """Whatever the ranges are cut into."""
    rows = planted(150, turns)
    assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(4), every, turns)) == brute_force(rows, every)


def test_odd_rows(spark):
    rows = [
        (None, 0, "user", "lost", 1, "x"), (0, None, None, None, 1, "x"), (0, 0, "user", "a  b", 1, "x"), (0, 0, "user", "a  b", 1, "x"), (1, 5, "user", "", 1, "x"),
        (21, 1, "user", "stem is not there", 1, "x"), (40, 0, "user", "\x0b c  d", 1, "x"), (41, 7, "u", "t", 1, "x"), (3, None, "", "", 1, "x"), (10**15, 0, "user", "z" * 100_000, 1, "x"),
    ]
    for turns in (1, 100):
        assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), turns=turns)) == brute_force(rows)
    assert prefix_trie.prefix_trie(spark.createDataFrame([], SCHEMA)).count() == 0
    assert prefix_trie.prefix_trie(spark.createDataFrame(rows[:1], SCHEMA)).count() == 0


def test_role_and_text_do_not_run_together(spark):
    rows = [(0, 0, "ab", "", 1, "x"), (1, 0, "a", "b", 1, "x"), (2, 0, "", "ab", 1, "x")]
    assert rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), None)) == brute_force(rows, None)


def test_one_hot_conversation(spark):
    rows = [(c, t, "user", f"turn {t}", 1, "x") for c in range(9000) for t in range(2)]
    found = rows_of(prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), None))
    ends = hashlib.sha256(",".join(map(str, range(9000))).encode()).hexdigest()
    assert [r[:7] for r in found] == [(0, 0, -1, 9000, 1, 1, 4 * 8999), (0, 1, 0, 9000, 1, 1, 4 * 8999), (0, 2, 0, 9000, 0, 1, 2 * 8999)] and found[2][7] == ends


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_the_query_and_its_sql(spark, sf):
    import duckdb

    rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    found = rows_of(op12_prefix_trie(spark, f"/root/testdata/{sf}"))
    assert found == brute_force(rows)
    with duckdb.connect() as db:
        db.sql(f"CREATE VIEW conversations AS SELECT * FROM '/root/testdata/{sf}/conversations.parquet'")
        assert sorted(tuple(-1 if v is None else v for v in r) for r in db.sql(ORACLES["op12_prefix_trie"]).fetchall()) == found
