"""Toxicity by non-negative positive-unlabelled learning.

A linear classifier over words is trained in numpy from confirmed toxic documents
(positives) and unlabelled text. With the class prior pi of positives in unlabelled
text and the logistic loss l, the risk is
    pi E_P[l(f)] + max(0, E_U[l(-f)] - pi E_P[l(-f)]),
and where the second term falls below zero, the step ascends it instead, which
stops the classifier from fitting the unlabelled positives as negatives.

Features are words (runs of letters, lower-cased) and their beginnings of ``STEMS``
letters, which inflected and compounded words share; each occurs in a document or
not, so length and repetition don't dilute a toxic word, and equal word sets are one
training document. Their counts in both samples rank them by the z-score of the
difference, and the ``features`` most distinct of those over ``least_z`` that
``least_docs`` of either sample have are used, however large the sample. For these
counts, of documents with equal minima of three hashes over their words (near copies,
mostly) only one counts.

Fit: from at most ``positives`` confirmed and ``unlabelled`` other documents, those
with the least hashes of their ids and texts (bounds of memory, not of the input;
only repeated rows tie). The prior is the share of 1 among the training labels; a
label of 0 is used for nothing else. Scoring covers every text and whole texts, of any length.

Nulls: a null text has no words and gets the score of the bias. Labels without a
document, documents without a label and null labels are unlabelled. A document
labelled both 0 and 1 is positive. Without positives every score is 0. Repeated
rows are scored alike; a text of any length is scored whole. Ties in z-score go to the lesser feature. Other columns are
ignored. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.words import letter_words
from tessera.shared import join_slim, map_arrow, materialize, release_memory

#: Lengths of the beginnings of longer words that are features of their own.
STEMS = range(3, 9)


def word_features(word: str) -> list[str]:
    """A word and its beginnings, marked by a star."""
    return [word, *(word[:k] + "*" for k in STEMS if len(word) > k)]


def _words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted distinct words, found by the function that scoring uses, of some texts at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            found = [sorted(set(letter_words(t))) for t in batch.column(0).slice(at, 256).to_pylist()]
            yield pa.record_batch([pa.array(found, pa.list_(pa.string()))], names=["words"])


def _features() -> Column:
    """Distinct features of the column words: as word_features."""
    stems = lambda w: F.filter(F.array(w, *[F.when(F.length(w) > k, F.concat(F.substring(w, 1, k), F.lit("*"))) for k in STEMS]), lambda x: x.isNotNull())
    return F.array_distinct(F.flatten(F.transform("words", stems)))


def _family() -> Column:
    """Near copies mostly share the minima of three hashes over their words, unlike texts hardly ever."""

    def least(seed: int) -> Column:
        return F.array_min(F.transform("words", lambda w: F.xxhash64(F.lit(seed), w)))

    return F.xxhash64(*map(least, range(3)))


def _sample(docs: DataFrame, most: int, seed: int) -> DataFrame:
    """Distinct word sets of the documents with the least hashes of their ids and texts, most documents at most but for repeated rows."""
    docs = docs.withColumn("h", F.xxhash64(F.lit(seed), "doc_id", "text"))
    total = docs.count()
    if total > most:
        # The hash is uniform: a threshold at the wanted share, a little high, then the exact cut.
        share = min(1.0, 1.1 * most / total + 50 / total)
        docs = docs.filter(F.col("h") < F.lit(int(-(1 << 63) + share * ((1 << 64) - 1))))
    last = docs.select("h").orderBy("h").limit(most).agg(F.max("h")).first()[0]
    rows = docs.filter(F.col("h") <= F.lit((1 << 63) - 1 if last is None else last)).select("text").transform(map_arrow, _words, "words array<string>")
    return materialize(rows.groupBy(F.xxhash64("words").alias("h")).agg(F.first("words").alias("words")).select("words", _family().alias("family")), "sample")


def distinct_features(pos: DataFrame, unl: DataFrame, features: int = 4000, least_docs: int = 5, least_z: float = 5.0) -> list[str]:
    """The features whose counts of families differ most between the samples, by z-score."""

    def counts(sample: DataFrame, name: str) -> tuple[DataFrame, int]:
        families = materialize(sample.groupBy("family").agg(F.max("words").alias("words")).repartition("family"), "families")
        return families.select(F.explode(_features()).alias("w")).groupBy("w").agg(F.count("*").alias(name)), max(1, families.count())

    (p, n_p), (u, n_u) = counts(pos, "p"), counts(unl, "u")
    both = p.join(u, "w", "full").fillna(0, ["p", "u"])
    m = (F.col("p") + F.col("u")) / (n_p + n_u)
    z = F.abs(F.col("p") / n_p - F.col("u") / n_u) / F.sqrt(m * (1 - m) * (1 / n_p + 1 / n_u) + 1e-12)
    best = both.filter(F.greatest("p", "u") >= least_docs).select("w", z.alias("z")).filter(F.col("z") > least_z).orderBy(F.desc("z"), "w").limit(features)
    return [r.w for r in best.collect()]


def fit(pos: list[list[str]], unl: list[list[str]], names: list[str], prior: float, steps: int = 1500, rate: float = 0.05, decay: float = 1e-4) -> tuple[dict[str, float], float]:
    """Weights by feature, and the bias, from documents given by their features among names."""
    if not pos or not unl or not names:
        return {}, -30.0
    column = {w: i for i, w in enumerate(names)}

    def entries(docs: list[list[str]]) -> tuple[np.ndarray, np.ndarray]:
        """Rows and columns of the ones of a sparse matrix."""
        return np.repeat(np.arange(len(docs)), [len(d) for d in docs]), np.array([column[w] for d in docs for w in d], np.int64)

    (r_p, c_p), (r_u, c_u), n_p, n_u = entries(pos), entries(unl), len(pos), len(unl)
    w, b, moments = np.zeros(len(column)), float(np.log(prior / (1 - prior))), [np.zeros(len(column) + 1), np.zeros(len(column) + 1)]
    sigmoid = lambda v: 1 / (1 + np.exp(-np.clip(v, -30, 30)))
    for step in range(1, steps + 1):
        s_p, s_u = sigmoid(np.bincount(r_p, w[c_p], n_p) + b), sigmoid(np.bincount(r_u, w[c_u], n_u) + b)
        negative = -np.log(1 - s_u + 1e-7).mean() + prior * np.log(1 - s_p + 1e-7).mean()
        # Gradients with respect to f: of l(f) it is s - 1, of l(-f) it is s.
        if negative >= 0:
            g_p, g_u = prior * (s_p - 1) / n_p - prior * s_p / n_p, s_u / n_u
        else:
            g_p, g_u = prior * s_p / n_p, -s_u / n_u
        g = np.append(np.bincount(c_p, g_p[r_p], len(column)) + np.bincount(c_u, g_u[r_u], len(column)) + decay * w, g_p.sum() + g_u.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.999 * moments[1] + 0.001 * g * g
        move = rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return {word: float(w[i]) for word, i in column.items() if abs(w[i]) > 1e-3}, b


def score_column(model: tuple[dict[str, float], float], text: Column) -> Column:
    weights, bias = model

    # Most words begin like no feature, and are told by three letters.
    starts = {x.rstrip("*")[: STEMS[0]] for x in weights}

    def value(text: str | None) -> float:
        hits = {x for word in set(letter_words(text)) if word[: STEMS[0]] in starts for x in word_features(word) if x in weights}
        return bias + sum(sorted(weights[x] for x in hits))

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(1 / (1 + np.exp(-np.clip([value(t) for t in batch], -30, 30))), dtype="float64")
            release_memory()

    return score(text)


def train(docs: DataFrame, labels: DataFrame, held_out: Column, positives: int = 4000, unlabelled: int = 12_000, least_docs: int = 5, least_z: float = 5.0, seed: int = 8, prior: float | None = None, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> tuple[dict[str, float], float]:
    """The model. held_out (a condition on doc_id) keeps labels and texts out of training.
    Features are counted and ranked by Spark; the driver gets the chosen ones, and each
    sampled document's among them."""
    slim = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter(~held_out)
    marks = labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).alias("y")).filter(~held_out).filter("doc_id is not null and y is not null").groupBy("doc_id").agg(F.max("y").alias("y"))
    marks = materialize(marks, "marks")
    if prior is None:
        prior = min(0.9, max(0.001, marks.agg(F.avg(F.col("y").cast("double"))).first()[0] or 0.001))
    toxic = join_slim(slim, marks.filter("y = 1").select("doc_id"), ["doc_id"], "left_semi")
    samples = [_sample(toxic, positives, seed), _sample(slim, unlabelled, seed + 1)]
    if any(s.isEmpty() for s in samples):
        return fit([], [], [], prior)
    chosen = distinct_features(*samples, least_docs=least_docs, least_z=least_z)
    only = F.array_intersect(_features(), F.array(*map(F.lit, chosen)) if chosen else F.array().cast("array<string>"))
    pos, unl = ([r.words for r in sample.select(only.alias("words")).collect()] for sample in samples)
    return fit(pos, unl, chosen, prior)


def toxicity(docs: DataFrame, labels: DataFrame, held_out: Column, threshold: float = 0.7, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per document: doc_id, held_out, score (0 to 1), predicted (score at or over the threshold)."""
    model = train(docs, labels, held_out, id_col=id_col, text_col=text_col, **options)
    out = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"), score_column(model, F.col(text_col).cast("string")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def held_out_third(id_col: str = "doc_id") -> Column:
    """The documents whose labels are never used: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))
