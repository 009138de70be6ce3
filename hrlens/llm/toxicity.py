"""Toxicity scores from non-negative positive-unlabelled learning.

Training sees confirmed toxic texts (positives) and unlabelled texts only; clean labels are never used.  With class
prior ``p``, logistic loss ``l`` and scores ``g`` the risk is

    p * E_pos[l(g)] + max(0, E_unl[l(-g)] - p * E_pos[l(-g)]),

the second term being the risk on clean text, estimated from unlabelled text after the positives hidden in it are
taken out.  Where that estimate falls below zero (over-fitting) the step climbs it back instead.  A few sparse linear
classifiers are trained with numpy on bootstrap samples and their probabilities averaged.

Features are the distinct words of a text and the words' beginnings (4 and 5 letters), so inflected forms of a
toxic stem count even if unseen.  Neither labels nor lang, source or doc_id enter a score.
"""

from __future__ import annotations

import string
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import body, bound_batches, crc_of_id

#: Bounds of the training sample (documented parameters): positives and unlabelled texts brought to the driver.
MAX_POSITIVES, MAX_UNLABELLED = 3000, 9000
THRESHOLD = 0.3
_BLANK = str.maketrans({c: " " for c in string.punctuation + string.digits})


def words_of(text: str) -> set[str]:
    return set(text.lower().translate(_BLANK).split())


def features_of(word: str) -> tuple[str, ...]:
    """The word itself, and its first 4 and 5 letters marked as beginnings."""
    return (word, *(word[:k] + "*" for k in (4, 5) if len(word) > k))


@dataclass
class ToxicityModel:
    """Averaged linear classifiers: ``weights[feature]`` is a row of one weight per classifier."""
    weights: dict[str, np.ndarray]
    bias: np.ndarray

    def score(self, text: str, memo: dict | None = None) -> float:
        z, memo = self.bias.copy(), {} if memo is None else memo
        for w in words_of(text):
            v = memo.get(w, False)
            if v is False:  # not seen yet; None: no known feature
                found = [self.weights[f] for f in features_of(w) if f in self.weights]
                if len(memo) > 150_000:
                    memo.clear()
                v = memo[w] = sum(found) if found else None
            if v is not None:
                z += v
        return float(np.mean(1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))))


def nnpu_fit(rows: np.ndarray, cols: np.ndarray, n_rows: int, n_cols: int, positive: np.ndarray, prior: float,
             steps: int = 300, rate: float = 0.1, l2: float = 1e-3) -> tuple[np.ndarray, float]:
    """Linear classifier minimising the non-negative risk; (rows, cols) are the ones of a 0/1 matrix."""
    w, b = np.zeros(n_cols), 0.0
    m, v = np.zeros(n_cols + 1), np.zeros(n_cols + 1)
    wp = np.where(positive, 1.0 / max(1, positive.sum()), 0.0)
    wu = np.where(positive, 0.0, 1.0 / max(1, (~positive).sum()))
    for t in range(1, steps + 1):
        z = np.bincount(rows, w[cols], n_rows) + b
        s = 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))          # d l(-g)/dg = s, d l(g)/dg = s - 1
        soft = np.logaddexp(0, z)                                # l(-g)
        clean = wu @ soft - prior * (wp @ soft)
        g_clean = (wu - prior * wp) * s
        dz = prior * wp * (s - 1) + g_clean if clean >= 0 else -g_clean
        grad = np.append(np.bincount(cols, dz[rows], n_cols) + l2 * w * (clean >= 0), dz.sum())
        m, v = 0.9 * m + 0.1 * grad, 0.999 * v + 0.001 * grad**2
        step = rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def train(positives: list[str], unlabelled: list[str], prior: float, n_models: int = 3, min_docs: int = 4,
          max_features: int = 4000, seed: int = 7) -> ToxicityModel:
    """Train on texts.  Without a positive or an unlabelled text the model gives every text the prior.

    Candidate features are those whose share among the positives exceeds what the unlabelled texts show, ranked by
    a z score of the two shares; at most ``max_features`` are kept.
    """
    if not positives or not unlabelled:
        p = min(max(prior, 1e-4), 0.25)
        return ToxicityModel({}, np.array([np.log(p / (1 - p))]))
    n_pos, n_unl = len(positives), len(unlabelled)
    in_pos: Counter = Counter()
    for t in positives:
        in_pos.update({f for w in words_of(t) for f in features_of(w)})
    in_pos = {f: c for f, c in in_pos.items() if c >= min_docs}
    in_unl: Counter = Counter()
    for t in unlabelled:
        in_unl.update({f for w in words_of(t) for f in features_of(w) if f in in_pos})
    ranked = []
    for f, c in in_pos.items():
        a, u = c / n_pos, in_unl.get(f, 0) / n_unl
        share = (c + in_unl.get(f, 0)) / (n_pos + n_unl)
        z = (a - u) / np.sqrt(max(share * (1 - share), 1e-9) * (1 / n_pos + 1 / n_unl))
        if z > 4 and a > 2.5 * u:
            ranked.append((-z, f))
    names = [f for _, f in sorted(ranked)[:max_features]]
    at = {f: i for i, f in enumerate(names)}
    rows, cols = [], []
    for i, t in enumerate((*positives, *unlabelled)):
        hit = sorted({at[f] for w in words_of(t) for f in features_of(w) if f in at})  # same sums in every run
        rows += [i] * len(hit)
        cols += hit
    rows, cols = np.array(rows, np.int64), np.array(cols, np.int64)
    positive = np.arange(n_pos + n_unl) < n_pos
    rng, fits = np.random.default_rng(seed), []
    for _ in range(n_models):
        keep = np.where(positive, True, rng.random(len(positive)) < 0.8)
        new = np.cumsum(keep) - 1
        on = keep[rows]
        fits.append(nnpu_fit(new[rows[on]], cols[on], int(keep.sum()), len(names), positive[keep], prior))
    w = np.array([f[0] for f in fits]).T
    return ToxicityModel({f: w[i] for f, i in at.items() if np.abs(w[i]).max() > 1e-3}, np.array([f[1] for f in fits]))


def held_out(doc_id: Column) -> Column:
    return crc_of_id(doc_id) % 4 == 2


def fit_toxicity(docs: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES,
                 max_unlabelled: int = MAX_UNLABELLED) -> ToxicityModel:
    """Fit on the rows of ``labels`` that are not held out.

    The class prior is the toxic share of all these rows.  Texts are a hash-ordered sample of bounded size: up to
    ``max_positives`` confirmed toxic ones, and up to ``max_unlabelled`` drawn regardless of their label.
    Rows of ``labels`` with a NULL ``toxic`` are unlabelled; a document labelled twice is toxic if any row says so.
    """
    lab = (labels.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
           .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    n, n_toxic = lab.agg(F.count("toxic"), F.sum(F.coalesce(F.col("toxic"), F.lit(0)).cast("long"))).first()
    n, n_toxic = n or 0, n_toxic or 0
    prior = n_toxic / n if n else 0.05
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(11)), F.lit(1_000_000)) / 1e6
    as_pos = (F.col("toxic") == 1) & (draw < min(1.0, max_positives / max(1, n_toxic)))
    as_unl = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(13)), F.lit(1_000_000)) / 1e6 < min(1.0, max_unlabelled / max(1, n))
    picked = lab.select("doc_id", F.coalesce(as_pos, F.lit(False)).alias("p"), as_unl.alias("u")).where("p or u")
    # the sample's expected size is bounded by the two parameters, so it may be broadcast and collected
    rows = (docs.select("doc_id", body().alias("text")).join(F.broadcast(picked), "doc_id")
            .select("text", "p", "u").toLocalIterator())
    positives, unlabelled = [], []
    for t, p, u in rows:
        if p:
            positives.append(t)
        if u:
            unlabelled.append(t)
    return train(sorted(positives), sorted(unlabelled), prior)


def score_column(spark, model: ToxicityModel, text: Column) -> Column:
    """Column of scores (0 to 1); whole texts, NULL as empty."""
    bound_batches(spark)
    shared = spark.sparkContext.broadcast(model)  # at most max_features rows
    memo: dict = {}

    @F.pandas_udf("double")
    def toxicity(t: pd.Series) -> pd.Series:
        m = shared.value
        return pd.Series([m.score(x or "", memo) for x in t], dtype="float64")
    return toxicity(text)


def score_documents(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, held_out, score, predicted (1 if score >= 0.3) for every row."""
    spark = docs.sparkSession
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score_column(spark, model, body()).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with their columns."""
    model = fit_toxicity(docs, labels)
    return docs.where(score_column(docs.sparkSession, model, body()) < THRESHOLD)
