import hashlib
import random

import pytest

from voxmill.llm import line_dedup as ld


def distance(a, b, most):
    """The edit distance if it is at most ``most``, else more than that."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def within(a, b, most):
    """Whether two lines are within ``most`` edits; what they share at either end is cut off first."""
    n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[n:], b[n:]
    n = next((i for i, (x, y) in enumerate(zip(reversed(a), reversed(b), strict=False)) if x != y), min(len(a), len(b)))
    a, b = a[: len(a) - n], b[: len(b) - n]
    return max(len(a), len(b)) <= most or (most > 1 and distance(a, b, most) <= most)


def brute(rows, edits=1, per_edit=16):
    """Every pair of distinct lines of near length."""
    order = sorted(((i is None, i or 0, t or "") for i, t in rows))
    first, out = {}, {}
    for late, i, t in order:
        for n, line in enumerate(t.split("\n")):
            x = line.strip(ld.SPACE)
            if x:
                first.setdefault(x, (late, i, n, t))
    by_size = {}
    for x in first:
        by_size.setdefault(len(x), []).append(x)
    near = set()
    for x, f in first.items():
        for size in range(len(x) - edits, len(x) + edits + 1):
            most = min(edits, min(size, len(x)) // per_edit)
            if abs(size - len(x)) <= most and any(first[y] < f and y != x and within(x, y, most) for y in by_size.get(size, ())):
                near.add(x)
    for late, i, t in order:
        kept, again, close = [], 0, 0
        for n, line in enumerate(t.split("\n")):
            x = line.strip(ld.SPACE)
            if x and first[x][:3] != (late, i, n):
                again += 1
            elif x in near:
                close += 1
            else:
                kept.append(line)
        out[i if not late else None] = (len(t.split("\n")), again, close, hashlib.sha256("\n".join(kept).encode()).hexdigest())
    return out


def got(df):
    return {r.doc_id: (r.n_lines, r.n_repeated, r.n_near, r.kept_sha256) for r in df.collect()}


def test_whole_table_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert got(ld.dedup_lines(docs)) == brute([tuple(r) for r in docs.select("doc_id", "text").collect()])


@pytest.mark.parametrize("edits", [0, 1, 2])
@pytest.mark.parametrize("alphabet", ["ab", "abcé 😀"])
def test_edits_of_all_kinds(spark, alphabet, edits):
    rng, rows = random.Random(len(alphabet)), []
    for i in range(60):
        lines = []
        for _ in range(rng.randrange(8)):
            base = list(rng.choice(["abababababab", "aaaaaaaaaaaa", "abcabcabcabcabcabc", "é😀" * 8, "ab" * 3]))
            for _ in range(rng.randrange(4)):
                p = rng.randrange(len(base))
                base[p : p + rng.randrange(2)] = rng.choice(["", *alphabet])
            lines.append(rng.choice(["", " ", "\t"]) + "".join(base) + rng.choice(["", "\r"]))
        rows.append((i, "\n".join(lines)))
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, line int")
    want = brute(rows, edits, 4)
    assert sum(w[2] for w in want.values()) > 10 or not edits
    assert got(ld.dedup_lines(docs, edits=edits, per_edit=4, slots=8)) == want


def test_lines_that_share_a_key_are_within_the_bound():
    rng = random.Random(9)
    lines = ["".join(rng.choice("abc") for _ in range(rng.randrange(5, 9))) for _ in range(60)]
    for b in (1, 2, 3):
        keys = {x: {(s, e): set(ld.variant_keys(x, s, e).tolist()) for s in range(b + 1) for e in range(b + 1 - s) if s + e <= len(x)} for x in lines}
        for x in lines:
            for y in lines:
                assert ld.within(x, y, b) == (distance(x, y, b) <= b), (x, y, b)
                shared = any(kx & ky for (s, e), kx in keys[x].items() for (z, f), ky in keys[y].items() if s == z and s + e + f <= b)
                assert shared == (distance(x, y, b) <= b), (x, y, b)


def test_very_long_lines(spark):
    rng = random.Random(2)
    base = "".join(rng.choice("abcdefgh ") for _ in range(1_000_000)).strip()
    half = len(base) // 2
    rows = [(1, base), (2, base[:half] + "X" + base[half + 1 :]), (3, base[:half] + base[half + 1 :]), (4, base[:7] + "XY" + base[9:]), (5, "short line of its own")]
    got_ = got(ld.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")))
    assert {i: (g[1], g[2]) for i, g in got_.items()} == {1: (0, 0), 2: (0, 1), 3: (0, 1), 4: (0, 0), 5: (0, 0)}


def test_edges(spark):
    long = "a line of more than sixteen"
    rows = [(1, None), (2, ""), (3, "\n\n"), (4, f"{long}\n{long}s\nof"), (5, f"{long}x\nor\n{long}"), (None, long), (6, "y" * 3000), (7, "y" * 3001)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, th string")
    assert got(ld.dedup_lines(docs)) == brute(rows)
    assert ld.dedup_lines(docs.unionAll(docs)).count() == 2 * len(rows)
    assert got(ld.dedup_lines(docs.unionAll(docs))) == brute(rows)
    assert ld.dedup_lines(docs.limit(0)).count() == 0
