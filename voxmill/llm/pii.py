"""Personal data by candidate gradient boosting, in SQL functions only.

Generators mark candidate spans, overlapping between kinds. Those of the four base kinds that pass their
kind's own check always stay. The rest are scored by boosted trees over format and context, and a threshold
for each kind, set at a given precision on a separate part of the candidates, selects. Every candidate either trains or sets thresholds.

The trees learn from weak labels that they can't see: candidates of added kinds are positive where the words before them name
what they are (or where a known issuer's form does), and the trees are given signs, cases, digits, checksums and punctuation,
but no naming words and no issuers' forms. So they tell a secret or an account number that nothing names. Candidates of
base kinds are positive when they pass their check.

A generator's pattern runs once: each match is fenced with a control sign, the text is split there, and a
running sum over piece lengths gives offsets in code points. Possessive quantifiers keep
every pattern linear in the text. Only slim pieces are shuffled; texts aren't.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from voxmill.llm.common import boosted, pick, stored, text_or_empty

FENCE = "\u0001"

# Kinds in the order of a tie, with each generator's pattern and a sign that its text must hold.
BASE = {
    "email": ("@", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    "ip": ("[0-9]\\.[0-9]", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    "card": ("[0-9]", r"[0-9]++(?:[\x20-][0-9]++)*+"),
    "phone": ("\\+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]"),
}
MORE = {
    "secret": ("[0-9]", r"(?<![A-Za-z0-9_+/])(?=[A-Za-z_+/]*+[0-9])[A-Za-z0-9_+/]{12,}+"),
    "password": ("(?i)pass|pwd", r"(?<=(?i:password|passwd|passphrase|pwd)(?: is )?[\x20\"'=:]{1,4})[^\x20\x09-\x0D\"'=:,;]{4,}+"),
    "iban": ("[A-Z][A-Z][0-9][0-9]", r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"),
    "ssn": ("[0-9]-[0-9][0-9]-[0-9]", r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    "key": ("PRIVATE KEY-----", r"-----BEGIN [A-Z0-9\x20]{0,40}PRIVATE KEY-----[^-]*+-----END [A-Z0-9\x20]{0,40}PRIVATE KEY-----"),
}
KINDS = [*BASE, *MORE]
# Words that name what follows, by kind, and forms of known issuers' keys. Labels come of these, features don't.
NAMED = {
    "secret": r"(?i)(?:password|passwd|pwd|secret|token|api.?key|access.?key|private.?key|auth|credential)[\x20\"':=]*$",
    "password": r"(?i)(?:password|passwd|passphrase|pwd)\x20?[:=][\x20\"']*$",
    "iban": r"(?i)(?:iban|account|konto|cuenta|compte)[^0-9]{0,12}$",
    "ssn": r"(?i)(?:ssn|social security)[^0-9]{0,12}$",
}
KEY_FORM = r"^(?:AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abp][0-9A-Za-z]+$"
CONTEXT = 32


def _pieces(text: Column, needs: str, pattern: str) -> Column:
    """Alternating gaps and matches of ``pattern``: (length, match or null, the signs before a match); a last one without length."""
    clean = F.when(F.contains(text, F.lit(FENCE)), F.translate(text, FENCE, "\u0002")).otherwise(text)
    parts = F.split(F.regexp_replace(clean, pattern, FENCE + "$0" + FENCE), FENCE)
    # each piece beside the one before it: what a function of pieces names of the text would be worked out again for each
    pairs = F.arrays_zip(parts.alias("own"), F.concat(F.array(F.lit("")), parts).alias("last"))
    made = F.transform(
        pairs,
        lambda x, i: F.struct(
            F.char_length(x["own"]).alias("n"),
            F.when(i % 2 == 1, x["own"]).alias("match"),
            F.when(i % 2 == 1, F.substring(x["last"], -CONTEXT, CONTEXT)).alias("before"),
        ),
    )
    return F.when(F.rlike(text, F.lit(needs)), F.when(F.size(parts) > 1, made))


def luhn(digits: Column) -> Column:
    """Whether a digit string's Luhn sum is a multiple of 10."""
    backwards = F.reverse(digits)
    each = F.transform(F.sequence(F.lit(0), F.length(digits) - 1), lambda i: (F.substring(backwards, i + 1, F.lit(1)).cast("int") * (1 + i % 2)))
    return (F.length(digits) > 0) & (F.aggregate(each, F.lit(0), lambda s, d: s + d - F.when(d > 9, 9).otherwise(0)) % 10 == 0)


def mod97(code: Column) -> Column:
    """An account code's remainder by 97, its first four signs last and letters as 10 to 35."""
    signs = F.split(F.concat(F.substring(code, 5, 1000), F.substring(code, 1, 4)), "")
    value = lambda ch: F.when(ch >= "A", F.ascii(ch) - 55).otherwise(ch.cast("int"))
    return F.aggregate(F.filter(signs, lambda ch: ch != ""), F.lit(0), lambda r, ch: (r * F.when(ch >= "A", 100).otherwise(10) + value(ch)) % 97)


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _valid() -> Column:
    """Whether a match passes its base kind's check."""
    d = _digits(F.col("match"))
    count = F.length(d)
    parts = F.split("match", "\\.")
    return (
        F.when(F.col("kind") == "email", True)
        .when(F.col("kind") == "ip", F.forall(parts, lambda p: F.length(F.regexp_replace(p, "^0+(?=[0-9])", "")) <= 3) & F.forall(parts, lambda p: F.substring(F.regexp_replace(p, "^0+(?=[0-9])", ""), 1, 3).cast("int") <= 255))
        .when(F.col("kind") == "card", F.when(count.between(12, 19), luhn(d)).otherwise(False))
        .when(F.col("kind") == "phone", count.between(9, 15))
        .otherwise(False)
    )


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, h, kind, start, end, match, before, valid for each span that a generator proposes.

    h: two hashes of the text. Rows that repeat both id and text are one document here. Digit groups of fewer
    than 7 digits are not proposed.
    """
    text = F.col("text")
    row = pick(docs, "doc_id", "text").where("text IS NOT NULL").select("doc_id", _h(text).alias("h"), "text")
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), _pieces(text, needs, p).alias("pieces")) for k, (needs, p) in {**BASE, **MORE}.items()])
    rows = row.select("doc_id", "h", F.explode(kinds).alias("k")).where("k.pieces IS NOT NULL")
    rows = rows.select("doc_id", "h", "k.kind", F.posexplode("k.pieces").alias("i", "p")).select("doc_id", "h", "kind", "i", "p.*").where("n IS NOT NULL")
    once = rows.groupBy("doc_id", "h", "kind", "i").agg(F.first("n").alias("n"), F.first("match").alias("match"), F.first("before").alias("before"))
    end = F.sum("n").over(Window.partitionBy("doc_id", "h", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    spans = once.withColumn("end", end.cast("long")).where("match IS NOT NULL").withColumn("start", F.col("end") - F.col("n"))
    proposed = spans.where((F.col("kind") != "card") | (F.length(_digits(F.col("match"))) >= 7))
    return proposed.withColumn("valid", _valid()).select("doc_id", "h", "kind", "start", "end", "match", "before", "valid")


def _h(text: Column) -> Column:
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(5), text).alias("b"))


def _with_features(spans: DataFrame) -> DataFrame:
    """Format and context of each span as a vector; nothing of NAMED or KEY_FORM."""
    m, b = F.col("match"), F.coalesce(F.col("before"), F.lit(""))
    size = F.greatest(F.char_length(m), F.lit(1)).cast("double")
    share = lambda p: F.regexp_count(m, F.lit(p)) / size
    kind = [(F.col("kind") == k).cast("double") for k in KINDS]
    part = lambda i: F.get(F.split(m, "-"), F.lit(i))
    check = (
        F.when(F.col("kind") == "iban", (mod97(F.replace(m, F.lit(" "), F.lit(""))) == 1).cast("double"))
        .when(F.col("kind") == "ssn", (~part(0).isin("000", "666") & (part(0) < "900") & (part(1) != "00") & (part(2) != "0000")).cast("double"))
        .otherwise(0.5)
    )
    return spans.withColumn(
        "features",
        array_to_vector(
            F.array(
                *kind, size, share("[0-9]"), share("[A-Z]"), share("[a-z]"), share("[^A-Za-z0-9]"),
                F.regexp_count(m, F.lit("(?<=[A-Za-z])[0-9]|(?<=[0-9])[A-Za-z]")) / size,
                F.size(F.array_distinct(F.split(m, ""))) / size,
                share("[a-f0-9]"), check,
                F.rlike(b, F.lit("[=:]\\x20?[\"']?$")).cast("double"),
                F.rlike(b, F.lit("[\"']$")).cast("double"),
                F.rlike(b, F.lit("(?i)(?:tel|phone|call|card|mail|contact|version|license|order|invoice|part|serial)[^a-z]*$")).cast("double"),
                F.length(_digits(m)).cast("double"),
            ).cast("array<double>")
        ),
    )


def _weak_label() -> Column:
    """1: passes a base check, is named by the words before it, or has a known key form; 0: neither."""
    before = F.coalesce(F.col("before"), F.lit(""))
    named = F.lit(False)
    for kind, words in NAMED.items():
        named = named | ((F.col("kind") == kind) & F.rlike(before, F.lit(words)))
    return (F.col("valid") | named | (F.col("kind") == "key") | ((F.col("kind") == "secret") & F.rlike("match", F.lit(KEY_FORM)))).cast("double")


def selected(spans: DataFrame, even: int = 20_000, precision: float = 0.9) -> DataFrame:
    """The spans that stay, with ``p``: base spans (p null), and others at or over their kind's threshold.

    All candidates train the trees (three quarters of the ids) and set the thresholds: per kind the least score from which on the
    other quarter holds ``precision`` of weak positives. An added kind without such a score takes that of all added kinds
    together. So that no common kind drowns the others, candidates of one kind weigh as much as ``even`` over the number of kinds at most.
    """
    base = spans.where("valid").withColumn("p", F.lit(None).cast("double"))
    sizes = {r.kind: r["count"] for r in spans.groupBy("kind").count().collect()}  # one row a kind
    weight = F.lit(1.0)
    for kind, n in sizes.items():
        weight = F.when(F.col("kind") == kind, F.lit(min(1.0, even / len(KINDS) / n))).otherwise(weight)
    known = _with_features(spans).withColumn("label", _weak_label())
    part = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(4))
    known = stored(known.select("kind", "features", "label", weight.alias("weight"), part.alias("part")), "known")
    trees = boosted(known.where("part <> 0"), weight="weight")
    if trees is None:
        return base

    def scored(rows: DataFrame) -> DataFrame:
        return trees.transform(rows).withColumn("p", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction", "features")

    each = scored(known.where("part = 0")).select(F.explode(F.when(F.col("kind").isin(*MORE), F.array("kind", F.lit(""))).otherwise(F.array("kind"))).alias("kind"), "p", "label", "weight")
    w = F.when(F.col("kind") == "", F.col("weight")).otherwise(1.0)
    steps = each.groupBy("kind", F.round("p", 3).alias("p")).agg(F.sum(w * F.col("label")).alias("good"), F.sum(w).alias("all"))
    down = Window.partitionBy("kind").orderBy(F.desc("p"))  # at most 1,001 rows a kind
    limits = (
        steps.withColumn("good", F.sum("good").over(down)).withColumn("all", F.sum("all").over(down))
        .where(F.col("good") >= precision * F.col("all"))
        .groupBy("kind").agg((F.min("p") - 0.0005).alias("limit"))
    )
    limit_of = {r.kind: r.limit for r in limits.collect()}  # at most one row a kind
    limit = F.lit(2.0)
    for kind in KINDS:
        limit = F.when(F.col("kind") == kind, F.lit(limit_of.get(kind, limit_of.get("", 2.0) if kind in MORE else 2.0))).otherwise(limit)
    more = scored(_with_features(spans.where("NOT valid"))).where(F.col("p") >= limit)
    return base.unionByName(more)


def personal_spans(docs: DataFrame, even: int = 20_000, precision: float = 0.9) -> DataFrame:
    """doc_id, h, kind, start, end, base of each span to redact; offsets in code points, end exclusive."""
    spans = stored(candidates(docs), "candidates")
    return selected(spans, even, precision).select("doc_id", "h", "kind", "start", "end", F.col("valid").alias("base"))


def _count_of(kind: str, spans: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def pii_digest(docs: DataFrame, even: int = 20_000, precision: float = 0.9) -> DataFrame:
    """Per row of docs(doc_id, text): counts of base spans, their digest, all spans, and counts of those of added kinds and of all.

    A null text counts as empty and has none. Repeated rows each get the same result.
    """
    order = F.expr("map(" + ",".join(f"'{k}',{i}" for i, k in enumerate(KINDS)) + ")")
    spans = personal_spans(docs, even, precision).withColumn("rank", F.element_at(order, F.col("kind")))
    entry = F.struct("start", "rank", "kind", "end", "base")
    grouped = spans.groupBy("doc_id", "h").agg(F.array_sort(F.collect_list(entry)).alias("all"))
    written = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    text = text_or_empty()
    rows = pick(docs, "doc_id", "text").select("doc_id", _h(text).alias("h"))
    on = rows["doc_id"].eqNullSafe(grouped["doc_id"]) & (rows["h"] == grouped["h"])
    every = F.coalesce(grouped["all"], F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,base:boolean>>"))
    out = rows.join(grouped, on, "left").select(rows["doc_id"], every.alias("all")).withColumn("own", F.filter("all", lambda s: s["base"]))
    return out.select(
        "doc_id",
        *[_count_of(k, "own").alias(f"n_{k}") for k in BASE],
        F.sha2(written(F.col("own")).cast("binary"), 256).alias("base_sha256"),
        written(F.col("all")).alias("spans"),
        *[_count_of(k, "all").alias(f"n_{k}") for k in MORE],
        F.size("all").cast("long").alias("n_spans"),
    )
