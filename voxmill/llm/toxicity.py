"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

A lexicon is learned from labelled texts (words and word beginnings far commoner in toxic ones), then
each text becomes a dozen densities: lexicon hits, hits near a second-person word, capitals,
punctuation, obfuscation. Trees score these, and an isotonic fit turns scores into probabilities.

The labelled rows are dealt by crc32(doc_id) mod 5: 0 is held out and never read, 1 and 2 give the lexicon,
3 the trees, 4 the calibration, so that none sees what the one before has fitted. Training takes
at most about ``max_labels`` labelled rows, drawn by hash; scoring reads every text whole and needs no shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxmill.llm.common import boosted, pick, small_batches, stored, text_or_empty

# Second-person words of the four languages, and look-alike signs of letters.
SECOND_PERSON = frozenset("you your yours yourself du dich dir dein deine deinen ihr euch euer sie tu te toi ton ta tes vous votre vos tú ti tus usted ustedes vosotros su sus".split())
LOOKALIKES = str.maketrans("0134578@$!|", "oieastbasil")

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = "\"'.,;:!?()[]{}<>«»¿¡…-–—*#&%_~"
OPENING = 5
NEAR = 5
FEATURES = 14
SHOUT = re.compile(r"[!?]{2,}")
STRETCH = re.compile(r"(\w)\1\1")
SIGNS = re.compile(r"[^\w\s]")
UPPER = re.compile(r"[^\W\d_a-z]")


def words_of(text: str) -> list[tuple[str, str, bool]]:
    """Each word as (as written, lower case with look-alikes read as letters, whether that differed)."""
    out = []
    for raw in WORD.findall(text):
        w = raw.strip(EDGE)
        low = w.lower()
        if low.isalpha() or not low:
            out.append((w, low, False))
            continue
        plain = "".join(c for c in low.translate(LOOKALIKES) if c.isalpha())
        hidden = not low.isdigit() and any(c.isalpha() for c in low) and plain != low
        out.append((w, plain if hidden else low, hidden))
    return out


def terms_of(word: str) -> list[str]:
    """A word and its beginning, both as lexicon entries."""
    return [word, word[:OPENING] + "~"] if len(word) > OPENING else [word]


def features_of(text: str, lexicon: dict[str, float]) -> list[float]:
    """The dense features of a text; all 0 when it has no words."""
    ws = words_of(text)
    if not ws:
        return [0.0] * FEATURES
    n = len(ws)
    hits, weights, masked, second, hidden, caps = [], [], 0, [], 0, 0
    for i, (raw, low, hid) in enumerate(ws):
        w = lexicon.get(low, 0.0) or (lexicon.get(low[:OPENING] + "~", 0.0) if len(low) > OPENING else 0.0)
        if w:
            hits.append(i)
            weights.append(w)
            masked += hid
        if low in SECOND_PERSON:
            second.append(i)
        hidden += hid
        caps += len(raw) > 2 and raw.isupper()
    near = 0
    if hits and second:
        at = np.searchsorted(second, hits)
        s = np.array([-NEAR - n, *second, n + n + NEAR])
        h = np.array(hits)
        near = int((np.minimum(h - s[at], s[at + 1] - h) <= NEAR).sum())
    size = len(text)
    return [
        len(hits) / n, float(np.log1p(len(hits))), sum(weights) / n, max(weights, default=0.0), len(set(weights)) / n ** 0.5,
        near / n, len(second) / n, len(UPPER.findall(text)) / size, caps / n, len(SIGNS.findall(text)) / size,
        len(SHOUT.findall(text)) / n, hidden / n, masked / n, len(STRETCH.findall(text)) / n,
    ]


def fold() -> F.Column:
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)).cast("int")


def learned_lexicon(train: DataFrame, entries: int = 400, least: int = 4) -> dict[str, float]:
    """Terms by smoothed log odds of their document counts; at most ``entries`` of them reach the driver."""

    @F.pandas_udf("array<string>")
    def terms(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted({x for _, low, _ in words_of(t) if len(low) > 2 for x in terms_of(low)}))

    sizes = {r[0]: r[1] for r in train.groupBy("label").count().collect()}
    pos, neg = sizes.get(1, 0), sizes.get(0, 0)
    counted = (
        train.select("label", F.explode(terms("text")).alias("term"))
        .groupBy("term")
        .agg(F.sum("label").cast("double").alias("p"), F.sum(1 - F.col("label")).cast("double").alias("q"))
        .where(F.col("p") >= least)
    )
    odds = F.log((F.col("p") + 0.5) / (pos + 1.0)) - F.log((F.col("q") + 0.5) / (neg + 1.0))
    strength = odds - 1.6 * F.sqrt(1 / (F.col("p") + 0.5) + 1 / (F.col("q") + 0.5))
    best = counted.select("term", odds.alias("odds"), strength.alias("strength")).where("strength > 1").orderBy(F.desc("strength"), "term").limit(entries)
    return {r.term: round(float(r.odds), 6) for r in best.collect()}


def with_features(rows: DataFrame, lexicon: dict[str, float]) -> DataFrame:
    """rows(text, ...) with ``features`` in place of the text."""

    @F.pandas_udf("array<double>")
    def dense(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(lambda t: features_of(t, lexicon))

    others = [c for c in rows.columns if c != "text"]
    return rows.select(*others, array_to_vector(dense("text")).alias("features"))


def trained(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000) -> Callable[[DataFrame], DataFrame]:
    """A function that gives rows(text, ...) a ``score`` in place of the text; see ``score_documents``."""
    spark = docs.sparkSession
    small_batches(spark)
    known = pick(labels, "doc_id", "toxic").where("toxic IS NOT NULL AND doc_id IS NOT NULL").withColumn("fold", fold()).where("fold <> 0")
    n, positive = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if n > max_labels:
        known = known.where(F.shiftrightunsigned(F.xxhash64("doc_id"), 11) / F.lit(float(1 << 53)) < max_labels / n)
    whole = pick(docs, "doc_id", "text").withColumn("text", text_or_empty())
    # about max_labels rows at most, by the draw above
    train = stored(whole.join(F.broadcast(known), "doc_id").select("text", "fold", F.col("toxic").cast("double").alias("label")), "labelled")
    lexicon = learned_lexicon(train.where("fold IN (1, 2)"))
    dense = stored(with_features(train.where("fold IN (3, 4)"), lexicon), "dense").coalesce(8)
    trees = boosted(dense.where("fold = 3"))
    if trees is None:
        rate = F.lit((positive + 0.1) / (n + 1.0))
        return lambda rows: rows.withColumn("score", rate).drop("text")

    def raw(rows: DataFrame) -> DataFrame:
        return trees.transform(rows).withColumn("raw", vector_to_array("probability")[1]).drop("rawPrediction", "probability", "prediction", "features")

    seen = raw(dense.where("fold = 4"))
    level = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="level").fit(seen) if seen.select("label").distinct().count() == 2 else None

    def score(rows: DataFrame) -> DataFrame:
        scored = raw(with_features(rows, lexicon))
        if level is not None:
            # within a level of the step function the trees' own order stays
            scored = level.transform(scored).withColumn("raw", F.col("level") * 0.99 + F.col("raw") * 0.01).drop("level")
        return scored.withColumn("score", F.least(F.greatest(F.col("raw"), F.lit(0.0)), F.lit(1.0))).drop("raw")

    return score


def score_documents(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs(doc_id, text).

    The score is 0.99 of the isotonic level and 0.01 of the trees' own probability, so that ties within a level keep an order.
    labels(doc_id, toxic): null labels are ignored, and a doc_id labelled twice counts as often. Null texts
    count as empty. When a fold lacks one of the two labels (as with no labels at all), every score is the smoothed
    base rate of the labelled rows, 0.1 without any. A null doc_id is not held out.
    """
    held = F.coalesce(fold() == 0, F.lit(False)).alias("held_out")
    rows = pick(docs, "doc_id", "text").select("doc_id", held, text_or_empty().alias("text"))
    return trained(docs, labels, max_labels)(rows).select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def civil_documents(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000) -> DataFrame:
    """The documents that score under 0.5, with their own columns; a filter in the scan, without a join."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), text_or_empty(docs["text"]).alias("text"))
    return trained(docs, labels, max_labels)(rows).where("score < 0.5").select("row.*")
