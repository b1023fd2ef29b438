"""N-gram Jaccard join with a token-group matrix.

Each document is a set of word shingles; sets that are equal count once from the start. Shingles have one global
order, rare ones first (by counts over all documents in hashed counters), and a set's prefix is
its least ones: two sets at the threshold share at least ``EXTRA + 1`` of their prefixes. Shingles
that only one prefix has are dropped, and so are sets that are left with fewer than they would have to share: rows with a
common phrase and nothing else in common cost no more than their own shingles.

Groups hold documents of like size whose commonest prefix shingle is the same. A large group is a family of copies as
a rule, so families are joined first: groups are cut by hash to ``bundle`` members, each cut also gets the
group's pivots (members whose prefixes are the most common, as those of what others were copied from), and every cut
is joined in itself. Links found so far are contracted to components.

The matrix has, per shingle and group (cut to ``group_size``), how many members' prefixes hold it: the
union of the group's tokens. A query's overlap with that union bounds its overlap with any member, so
a group is opened only if the bound reaches what the threshold asks of sets at least as large as
the query. Only links between components are still asked for: a shingle whose holders are all of one component can't
give one and leaves the matrix, a set that is left with too few shingles leaves it too, and a group of which a query meets its own component alone is not opened. So a family of N
copies that its pivots have joined costs N rows here and not N times its groups. An opened group meets its queries
in one task with whole sets, which an inverted index of the members intersects; the task returns a spanning forest
of the links it finds, never all pairs.

Sets are recomputed from the texts when groups are opened, so what is stored of each document is its
prefix. Hot groups: cuts are bounded in members and in shingles, and the queries of a group are dealt to several tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voxmill.llm import shingles as sh
from voxmill.llm.common import numbered, pick, small_batches, stored, text_or_empty
from voxmill.llm.components import components

#: Prefix shingles beyond the least number, each of which raises by one what a candidate must share.
EXTRA = 3
PART = 1 << 14
#: A cut holds this many shingles per member on average at most, so that groups of long texts have fewer members.
GROUP_SHINGLES = 2000
#: Bytes of sets in a batch that a task sends on.
SEND = 4 << 20


def gram_counts(whole: DataFrame, k: int, slots: int) -> np.ndarray:
    """Counts of all shingles of all texts in ``slots`` hashed counters; the driver gets just these."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(slots, np.int64)
        for b in batches:
            for _, data, offsets in sh.chunks(b.column("text")):
                h, _ = sh.gram_batch(*sh.words(data, offsets), k)
                total += np.bincount((h & np.uint64(slots - 1)).astype(np.int64), minlength=slots)
        parts = total.reshape(-1, min(PART, slots))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts))), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "counts"])

    def add(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(c.as_buffer(), np.int64) for c in table.column("counts"))
        return pa.table({"part": table.column("part")[:1], "counts": pa.array([total.tobytes()], pa.binary())})

    schema = "part long, counts binary"
    some = whole.select("text").mapInArrow(count, schema).withColumn("salt", F.floor(F.spark_partition_id() / 256))
    summed = some.groupBy("part", "salt").applyInArrow(lambda t: add(t.drop_columns(["salt"])), schema).groupBy("part").applyInArrow(add, schema)
    out = np.zeros(slots, np.int64)
    for r in summed.collect():
        part = np.frombuffer(r.counts, np.int64)
        out[r.part * len(part) : (r.part + 1) * len(part)] = part
    return np.minimum(out, np.iinfo(np.uint32).max).astype(np.uint32)


def sets_of(column: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingles) of each text."""
    for first, data, offsets in sh.chunks(column):
        h, begins = sh.gram_batch(*sh.words(data, offsets), k)
        for i in range(len(offsets) - 1):
            s = h[begins[i] : begins[i + 1]]
            s.sort()
            yield first + i, s[np.append(True, s[1:] != s[:-1])] if len(s) else s


def _ceil_share(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def prefix_length(n: int, percent: int) -> int:
    return min(n, n - _ceil_share(n, percent) + 1 + EXTRA)


def prefixes(whole: DataFrame, k: int, percent: int, order: np.ndarray) -> DataFrame:
    """doc_id, n, s1, s2 (of the whole set) and the prefix of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mask = np.uint64(len(order) - 1)
        for b in batches:
            n, s1, s2, pre = [], [], [], []
            for _, s in sets_of(b.column("text"), k):
                n.append(len(s))
                s1.append(int(np.bitwise_xor.reduce(sh.mixed(s, 1))) if len(s) else 0)
                s2.append(int(np.add.reduce(sh.mixed(s, 2))) if len(s) else 0)
                p = prefix_length(len(s), percent)
                if p < len(s):
                    c = order[s & mask]
                    edge = np.partition(c, p - 1)[p - 1]
                    few = np.flatnonzero(c <= edge)
                    s = s[few[np.lexsort((s[few], c[few]))[:p]]]
                pre.append(s.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(np.array(s1, np.uint64).view(np.int64)), pa.array(np.array(s2, np.uint64).view(np.int64)), pa.array(pre, pa.list_(pa.int64()))],
                ["doc_id", "n", "s1", "s2", "prefix"],
            )

    return stored(whole.mapInArrow(run, "doc_id long, n long, s1 long, s2 long, prefix array<long>"), "prefixes")


def able(rows: DataFrame, percent: int, *more: str) -> DataFrame:
    """``rows`` (one a set and shingle x) of the sets that have as many as a link asks for.

    Of sets of a <= b shingles at the threshold, ``_ceil_share(b)`` or more are common, and all but the larger set's
    ``beyond`` of them lie in both prefixes; so a set of n shares ``min(_ceil_share(n), 1 + EXTRA)`` with whatever it links with.
    """
    keys = [c for c in rows.columns if c not in ("x", *more)]
    held = rows.groupBy(*keys).agg(F.collect_list(F.struct("x", *more)).alias("held"))
    least = F.least(F.ceil(F.col("n") * percent / 100), F.lit(1 + EXTRA))
    return stored(held.where(F.size("held") >= least), "able").select(*keys, F.inline("held"))


def shared_prefixes(reps: DataFrame, percent: int = 80) -> DataFrame:
    """(id, n, x, c) of each prefix shingle x that c > 1 sets have, for sets with as many as a link asks for."""
    rows = reps.select(F.col("doc_id").alias("id"), "n", F.explode("prefix").alias("x"))
    # stored, so that the join is of plain rows and adaptive execution can split a hot shingle
    often = stored(rows.groupBy("x").agg(F.count("*").alias("c")).where("c > 1"), "often")
    return able(rows.join(often, "x").select("id", "n", "x", "c"), percent, "c")


def _cuts(size: int) -> Column:
    """Into how many parts a group is cut: by its members, and by the shingles of their sets."""
    return F.greatest(F.ceil(F.count("*") / size), F.ceil(F.sum("n") / F.lit(size * GROUP_SHINGLES)))


def grouped(shared: DataFrame, percent: int, bundle: int, group_size: int, pivots: int = 8) -> tuple[DataFrame, DataFrame]:
    """(id, n, g, own) of the members of groups, ``g`` of ``group_size`` and ``own`` of ``bundle``, and the pivots' (id, g) in cuts."""
    # sets whose sizes differ by under an eighth of what the threshold allows lie in one size class
    size_class = F.floor(F.log("n") / F.lit(float(np.log(100 / percent) / 4))).cast("long") if percent < 100 else F.col("n")
    best = shared.groupBy("id", "n").agg(F.max(F.struct("c", "x")).alias("top"), F.sum("c").alias("weight"))
    key = stored(best.select("id", "n", "weight", F.xxhash64("top.x", size_class).alias("key")), "keys")
    part = F.pmod(F.xxhash64(F.lit(2), "id"), F.lit(pivots))
    # one pivot of each hash class: one aggregate with partial results, and no group is sorted
    lead = [F.max(F.when(part == i, F.struct("weight", "id"))).alias(f"p{i}") for i in range(pivots)]
    crowd = stored(key.groupBy("key").agg(_cuts(bundle).alias("small"), _cuts(group_size).alias("large"), *lead), "crowd")
    cut = lambda salt, n: F.xxhash64(F.lit(salt), "key", F.pmod(F.xxhash64("id", F.lit(salt)), F.col(n)))
    members = stored(key.join(crowd.select("key", "small", "large"), "key").select("id", "n", cut(0, "large").alias("g"), cut(1, "small").alias("own")), "members")
    each = crowd.where("small > 1").select("key", F.explode(F.array_compact(F.array(*[F.col(f"p{i}.id") for i in range(pivots)]))).alias("id"), F.explode(F.sequence(F.lit(0), F.col("small") - 1)).alias("at"))
    return members, each.select("id", F.xxhash64(F.lit(1), "key", "at").alias("own"))


def opened_groups(shared: DataFrame, members: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """(q, g) of the groups that a query opens, for links to other components than its own. parts(id, component)."""
    named = members.select("id", "g").join(parts, "id", "left").select("id", "g", F.coalesce("component", "id").alias("part"))
    held = stored(shared.select("id", "n", "x").join(named, "id"), "held")
    mixed = stored(held.groupBy("x").agg(F.min("part").alias("a"), F.max("part").alias("b")).where("a <> b").select("x"), "mixed")
    held = able(held.join(mixed, "x"), percent)
    matrix = stored(
        held.groupBy("x", "g").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.min("part").alias("low_part"), F.max("part").alias("high_part")), "matrix"
    )
    nq, low, high = F.col("nq"), F.greatest("nq", "least"), F.least("most", F.floor(F.col("nq") * 100 / percent))
    probe = held.select("x", F.col("id").alias("q"), F.col("n").alias("nq"), "part")
    met = (
        probe.join(matrix, "x")
        .where("low_part <> part OR high_part <> part")
        .where(low <= high)
        .groupBy("q", "nq", "g")
        .agg(F.count("*").alias("met"), F.min("least").alias("least"), F.max("most").alias("most"))
    )
    share = lambda n: F.ceil(n * percent / 100)
    asked = lambda n: F.ceil(percent * (nq + n) / (100 + percent))
    # a set's shingles outside its prefix
    beyond = lambda n: F.greatest(F.lit(0), share(n) - 1 - EXTRA)
    need = F.least(asked(low) - beyond(nq), asked(high) - beyond(high) - 1)
    return stored(met.where(F.col("met") >= F.greatest(F.lit(1), need)).select("q", "g"), "opened")


def linked(a: np.ndarray, b_sizes: np.ndarray, overlap: np.ndarray, percent: int) -> np.ndarray:
    return 100 * overlap >= percent * (len(a) + b_sizes - overlap)


class Forest:
    """Union-find with the least index as root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i: int, j: int) -> None:
        i, j = self.root(i), self.root(j)
        self.up[max(i, j)] = min(i, j)


def links_of(ids: np.ndarray, sets: list[np.ndarray], is_member: np.ndarray, is_query: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between queries and members."""
    forest = Forest(len(ids))
    members = np.flatnonzero(is_member)
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens = np.concatenate([sets[m] for m in members])
    owner = np.repeat(members, sizes[members])
    order = np.argsort(tokens, kind="stable")
    owner = owner[order]
    values, starts, lens = np.unique(tokens[order], return_index=True, return_counts=True)
    for q in np.flatnonzero(is_query):
        s = sets[q]
        at = np.searchsorted(values, s)
        at[at == len(values)] = 0
        at = at[values[at] == s]
        runs = lens[at]
        total = int(runs.sum())
        gather = np.repeat(starts[at] - np.append(0, np.cumsum(runs))[:-1], runs) + np.arange(total)
        overlap = np.bincount(owner[gather], minlength=len(sets))
        for m in np.flatnonzero((overlap > 0) & linked(s, sizes, overlap, percent)):
            if m != q:
                forest.join(int(q), int(m))
    roots = [(i, forest.root(i)) for i in range(len(ids))]
    return [(int(ids[i]), int(ids[r])) for i, r in roots if i != r]


def dealt(members: DataFrame, opened: DataFrame, task_queries: int) -> DataFrame:
    """(id, g, query, member) roles of documents in tasks: the queries of a group in deals, each with all its members."""
    deals = stored(opened.groupBy("g").agg(F.ceil(F.count("*") / task_queries).alias("deals")), "deals")
    at = lambda deal: F.xxhash64("g", deal)
    as_query = opened.join(deals, "g").select(F.col("q").alias("id"), at(F.pmod(F.xxhash64("q"), F.col("deals"))).alias("g"), F.lit(True).alias("query"), F.lit(False).alias("member"))
    as_member = members.select("id", "g").join(deals, "g").select("id", "g", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)).alias("deal"))
    return as_query.unionByName(as_member.select("id", at(F.col("deal")).alias("g"), F.lit(False).alias("query"), F.lit(True).alias("member")))


def verified(whole: DataFrame, roles: DataFrame, k: int, percent: int, slots: int = 1 << 18) -> DataFrame:
    """(a, b) links that join all documents whose sets are linked, of those that meet in a task by roles(id, g, query, member)."""
    routes = stored(roles.groupBy("id").agg(F.collect_list(F.struct("g", "query", "member")).alias("routes")), "routes")
    # texts without a route stay where they are, but for those that share a slot with one
    slot = lambda c: F.pmod(F.xxhash64(c), F.lit(slots))
    live = routes.select(slot("id").alias("slot")).distinct()
    near = whole.withColumn("slot", slot("doc_id")).join(F.broadcast(live), "slot", "left_semi")  # at most `slots` rows
    texts = near.join(routes, near["doc_id"] == routes["id"]).select("id", "text", "routes")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, types = ["g", "query", "member", "id", "tokens"], [pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.binary()]
        out, held = [], 0
        for b in batches:
            ids, routes_of = b.column("id").to_pylist(), b.column("routes").to_pylist()
            for i, s in sets_of(b.column("text"), k):
                raw = s.tobytes()
                for r in routes_of[i]:
                    out.append((r["g"], r["query"], r["member"], ids[i], raw))
                    held += len(raw)
                    if held > SEND:
                        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)
                        out, held = [], 0
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(types)], names)

    def meet(table: pa.Table) -> pa.Table:
        ids, inverse = np.unique(table.column("id").to_numpy(), return_inverse=True)
        flag = lambda c: table.column(c).to_numpy(zero_copy_only=False).astype(bool)
        found: list = [None] * len(ids)
        for i, cell in zip(inverse, table.column("tokens"), strict=True):
            if found[i] is None:
                found[i] = np.frombuffer(cell.as_buffer(), np.uint64)
        is_member, is_query = np.zeros(len(ids), bool), np.zeros(len(ids), bool)
        is_member[inverse[flag("member")]] = True
        is_query[inverse[flag("query")]] = True
        pairs = links_of(ids, found, is_member, is_query, percent) if is_member.any() and len(ids) > 1 else []
        return pa.table({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})

    shipped = texts.mapInArrow(sets, "g long, query boolean, member boolean, id long, tokens binary")
    return stored(shipped.groupBy("g").applyInArrow(meet, "a long, b long"), "found")


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, slots: int = 1 << 20, bundle: int = 128, group_size: int = 2000, task_queries: int = 4000) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of docs(doc_id, text).

    Two documents link when 100 x shared shingles >= percent x all their shingles. A component's id is its least doc_id.
    A text of fewer than k words is one shingle; one without words, or null, has none and links with nothing. Rows
    with a null id keep a null component and link nothing; rows that repeat an id are one document.
    """
    spark = docs.sparkSession
    small_batches(spark)
    whole = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    sets = prefixes(whole, k, percent, gram_counts(whole, k, slots))
    named = sets.where("n > 0 AND doc_id IS NOT NULL")
    same = stored(named.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("rep")), "same")
    reps = stored(named.join(same.select(F.col("rep").alias("doc_id"), "s1", "s2"), ["doc_id", "s1", "s2"], "left_semi").dropDuplicates(["doc_id", "s1", "s2"]), "reps")
    known = whole.where("doc_id IS NOT NULL")
    shared = shared_prefixes(reps, percent)
    members, pivots = grouped(shared, percent, bundle, group_size)
    crowded = stored(members.groupBy("own").agg(F.count("*").alias("size")).where("size > 1").select("own"), "crowded")
    inside = members.select("id", "own").unionByName(pivots).distinct().join(crowded, "own").select("id", F.col("own").alias("g"), F.lit(True).alias("query"), F.lit(True).alias("member"))
    families = verified(known, inside, k, percent)
    parts = stored(components(families), "families")
    opened = opened_groups(shared, members, parts, percent)
    links = families.unionByName(verified(known, dealt(members, opened, task_queries), k, percent))
    # copies follow their representative, so only links between different sets take part in the contraction
    parts = stored(components(links), "components")
    ids = named.select("doc_id", "s1", "s2").join(same, ["s1", "s2"]).select(F.col("doc_id").alias("a"), F.col("rep").alias("b")).where("a <> b").distinct()
    repeated = named.groupBy("doc_id").agg(F.count_distinct("s1", "s2").alias("texts")).where("texts > 1")
    if repeated.limit(1).count():
        parts = stored(components(links.unionByName(ids)), "components")
    rep_of = sets.join(same.select("s1", "s2", "rep"), ["s1", "s2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("rep")).alias("rep"))
    out = rep_of.join(parts, rep_of["rep"] == parts["id"], "left")
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, **how) -> DataFrame:
    """One row of each component, with its own columns: that of the least doc_id (a null one last), then any one.

    Rows are told apart by number, so rows with null or repeated ids are documents of their own. Rows whose texts have no
    words link with nothing and stay.
    """
    rows, number = numbered(docs)
    found = stored(jaccard_components(rows.select(rows[number].alias("doc_id"), rows["`text`"]), **how).select(F.col("doc_id").alias(number), "component_id"), "near")
    crowded = stored(found.groupBy("component_id").agg(F.count("*").alias("size")).where("size > 1").select("component_id"), "crowded")
    near = stored(rows.select(number, F.col("`doc_id`").alias("id")).join(found.join(crowded, "component_id"), number), "near")
    best = stored(near.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("late"), "id", number)).alias("best")).select("component_id", F.col(f"best.{number}").alias("keep")), "best")
    gone = near.join(best, "component_id").where(F.col(number) != F.col("keep")).select(number)
    return rows.join(gone, number, "left_anti").select(*[rows[f"`{c}`"] for c in docs.columns])
