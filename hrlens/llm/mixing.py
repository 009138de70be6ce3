"""Mixing documents to target domain weights with soft memberships.

1. A classifier trained on a bounded sample of labelled rows gives every document a posterior over the domains.
2. With token counts t, posteriors p and targets T, nonnegative document rates r minimise

       sum over domains d of (sum over documents of r t p[d] - T[d])**2 / M[d],   M[d] = sum of t p[d],

   by projected gradient from r = 1.  In the metric of the token counts the Hessian's largest eigenvalue is 1, so the
   step is 1 and an iteration reads ``r = max(floor, r - p . g)``, ``g[d] = (sum of r t p[d] - T[d]) / M[d]``.
   A document's rate follows from its posterior and the few vectors g so far.  So an iteration is one pass over the
   written posteriors that sums one vector per task, and no rate is ever stored or shuffled.
3. A rate becomes copies: its whole part, and one more with the probability of the rest, drawn by hash of the row's number and doc_id.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordIds, body, bound_batches, chunks, fresh, own_columns

#: Bound of the labelled sample brought to the driver (documented parameter).
MAX_LABELLED = 6000
BUCKETS = 1 << 15
ITERATIONS, TOLERANCE = 60, 1e-4
TOGETHER = 2_000_000
#: Target weights of the registered query and the pipeline: language and quality tier.
TARGETS = {"en/1": 0.42, "de/1": 0.15, "fr/1": 0.15, "es/1": 0.12, "en/0": 0.07, "de/0": 0.03, "fr/0": 0.03, "es/0": 0.03}


@dataclass
class DomainModel:
    """Naive Bayes evidence per word bucket, and a softmax layer over its means and a few shape features."""
    domains: list[str]
    evidence: np.ndarray       # buckets x domains
    layer: np.ndarray          # features x domains
    history: list = field(default_factory=list)     # gradient vectors of the fitted rates
    floor: float = 0.0

    def features(self, texts: list[str], ids: WordIds) -> tuple[np.ndarray, np.ndarray]:
        """Feature rows and word counts."""
        words = [t.lower().encode().split() for t in texts]
        index = [ids.index(w) for w in words]
        sizes = np.array([len(x) for x in index], np.int64)
        distinct = np.array([len(set(w)) for w in words], float)
        out = np.zeros((len(texts), len(self.domains) + 4))
        out[:, -1] = 1.0
        some = np.flatnonzero(sizes)
        if len(some):
            bucket = (ids.hashes() & np.uint64(BUCKETS - 1)).astype(np.int64)[np.concatenate(index)]
            starts = np.cumsum(sizes[some]) - sizes[some]
            total = np.add.reduceat(self.evidence[bucket], starts, axis=0)
            out[some, :len(self.domains)] = total / sizes[some, None]
            chars = np.array([len(t) for t in texts], float)
            marks = np.array([t.count("!") + t.count("|") for t in texts], float)
            out[some, -4] = distinct[some] / sizes[some]
            out[some, -3] = marks[some] / sizes[some]
            out[some, -2] = np.minimum(chars[some] / sizes[some], 30) / 10
        return out, sizes

    def posterior(self, texts: list[str], ids: WordIds) -> tuple[np.ndarray, np.ndarray]:
        x, sizes = self.features(texts, ids)
        return softmax(x @ self.layer), sizes

    def rates(self, p: np.ndarray) -> np.ndarray:
        r = np.full(len(p), max(1.0, self.floor))
        for g in self.history:
            r = np.maximum(self.floor, r - p @ g)
        return r


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], names: list[str], steps: int = 400) -> DomainModel:
    """Fit on labelled texts: word evidence from one half, the layer on the other.

    Without texts there is one domain, "", that holds everything.
    """
    domains = sorted(set(names)) or [""]
    y = np.array([domains.index(n) for n in names], np.int64)
    ids, k = WordIds(), len(domains)
    model = DomainModel(domains, np.zeros((BUCKETS, k)), np.zeros((k + 4, k)))
    if k == 1:
        return model
    counts = np.full((BUCKETS, k), 0.1)
    for t, c in zip(texts[::2], y[::2], strict=True):
        index = ids.index(t.lower().encode().split())
        np.add.at(counts[:, c], (ids.hashes()[index] & np.uint64(BUCKETS - 1)).astype(np.int64), 1.0)
    share = np.log(counts / counts.sum(axis=0))
    model.evidence = share - share.mean(axis=1, keepdims=True)
    half = texts[1::2] or texts
    y = y[1::2] if len(texts) > 1 else y
    x = np.concatenate([model.features(half[i:j], ids)[0] for i, j in chunks([len(t) for t in half], TOGETHER)])
    scale = np.maximum(x.std(axis=0), 1e-6)
    scale[-1] = 1.0
    x, w, one = x / scale, np.zeros((k + 4, k)), np.eye(k)[y]
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = x.T @ (softmax(x @ w) - one) / len(x) + 1e-4 * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    model.layer = w / scale[:, None]
    return model


def fit_domains(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DomainModel:
    """Classifier of the labelled rows' domains, language and quality; a hash-ordered sample of bounded size."""
    lab = labels.where("quality is not null and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    n = lab.count()
    draw = F.pmod(F.xxhash64(F.col("doc_id"), F.lit(17)), F.lit(1_000_000)) / 1e6
    picked = lab.where(draw < min(1.0, max_labelled / max(1, n)))
    # the expected size of the sample is bounded by max_labelled
    rows = (docs.where("lang is not null").select("doc_id", "lang", body().alias("text")).join(F.broadcast(picked), "doc_id")
            .select("text", F.concat_ws("/", "lang", "quality").alias("domain")).collect())
    rows = sorted((r["domain"], r["text"]) for r in rows)
    order = np.random.default_rng(5).permutation(len(rows))
    return train([rows[i][1] for i in order], [rows[i][0] for i in order])


def posteriors(docs: DataFrame, model: DomainModel) -> DataFrame:
    """doc_id, n_tokens and posterior of every row; a text without words has the posterior of its empty features."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = WordIds()
        for batch in batches:
            texts = list(batch["text"])
            for i, j in chunks([len(t) for t in texts], TOGETHER):
                ids.room()
                p, sizes = shared.value.posterior(texts[i:j], ids)
                yield pd.DataFrame({"id": batch["id"].to_numpy()[i:j], "no_id": batch["no_id"].to_numpy()[i:j], "n_tokens": sizes, "posterior": list(p)})
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(0)).alias("id"), F.col("doc_id").isNull().alias("no_id"), body().alias("text"))
    made = rows.mapInPandas(run, "id long, no_id boolean, n_tokens long, posterior array<double>")
    return made.select(F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "n_tokens", "posterior")


def domain_totals(table: DataFrame, model: DomainModel) -> np.ndarray:
    """Expected tokens of each domain at the model's rates: one vector a task, summed by Spark."""
    k = len(model.domains)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(k)
        for batch in batches:
            if len(batch):
                p = np.stack(batch["posterior"].to_numpy())
                total += (model.rates(p) * batch["n_tokens"].to_numpy()) @ p
        yield pd.DataFrame([total], columns=[f"d{i}" for i in range(k)])
    sums = table.select("n_tokens", "posterior").mapInPandas(run, ", ".join(f"d{i} double" for i in range(k)))
    row = sums.agg(*[F.sum(f"d{i}").alias(f"d{i}") for i in range(k)]).first()
    return np.array([x or 0.0 for x in row])


def fit_rates(table: DataFrame, model: DomainModel, targets: dict[str, float], floor: float = 0.0) -> dict[str, tuple[float, float]]:
    """Fit the rates (kept in ``model``); returns each domain's target and reached expected tokens.

    Weights of domains the model does not know are spread over the others.  With ``floor`` 0 the targets add up to
    the tokens there are; with a higher floor they are the least totals with these weights that no domain exceeds at
    rate ``floor``, so documents are repeated rather than dropped.
    """
    model.history, model.floor = [], floor
    weight = np.array([max(0.0, targets.get(d, 0.0)) for d in model.domains])
    model_rate = np.maximum(1.0, floor)
    mass = domain_totals(table, model) / model_rate
    weight = np.where(mass > 0, weight, 0.0)
    if not mass.sum() or not weight.sum():
        return dict.fromkeys(model.domains, (0.0, 0.0))
    weight /= weight.sum()
    used = weight > 0
    size = mass.sum() if floor <= 0 else floor * np.max(mass[used] / weight[used])
    target, safe = weight * size, np.maximum(mass, 1e-9)
    reached = mass * model_rate
    for _ in range(ITERATIONS):
        if np.abs(reached - target).max() <= TOLERANCE * size:
            break
        model.history.append((reached - target) / safe)
        reached = domain_totals(table, model)
    return {d: (float(t), float(r)) for d, t, r in zip(model.domains, target, reached, strict=True)}


def copies(rate: Column, row: Column, doc_id: Column) -> Column:
    """Whole copies of a row at its rate; rows that share a doc_id are drawn one by one."""
    draw = F.pmod(F.xxhash64(row, F.coalesce(doc_id.cast("long"), F.lit(-1).cast("long")), F.lit(23)), F.lit(1 << 30)) / float(1 << 30)
    return (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long")


def rates(table: DataFrame, model: DomainModel) -> DataFrame:
    """The table (with its rows' numbers) with each document's rate and copies, without the numbers."""
    @F.pandas_udf("double")
    def rate(p: pd.Series) -> pd.Series:
        return pd.Series(model.rates(np.stack(p.to_numpy())) if len(p) else [], dtype="float64")
    return table.withColumn("rate", rate("posterior")).withColumn("copies", copies(F.col("rate"), F.col("row"), F.col("doc_id"))).drop("row")


def mixing_rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS, floor: float = 0.0) -> tuple[DataFrame, DomainModel]:
    """doc_id, n_tokens, posterior, rate, copies of every row, and the fitted model."""
    spark = docs.sparkSession
    bound_batches(spark)
    model = fit_domains(docs, labels)
    table = Scratch(spark, "mixing").table("posteriors", posteriors(docs, model).withColumn("row", F.monotonically_increasing_id()))
    fit_rates(table, model, targets, floor)
    return rates(table, model), model


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """The documents, each repeated by its rate (1 at least), with their columns; totals match the target weights."""
    _, model = mixing_rates(docs, labels, targets, floor=1.0)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    ids = WordIds()

    @F.pandas_udf("double")
    def rate(text: pd.Series) -> pd.Series:
        texts, out = list(text), []
        for i, j in chunks([len(t) for t in texts], TOGETHER):
            ids.room()
            out.append(shared.value.rates(shared.value.posterior(texts[i:j], ids)[0]))
        return pd.Series(np.concatenate(out) if out else [], dtype="float64")
    r, row, copy = (fresh(docs, c) for c in ("rate", "row", "copy"))
    numbered = docs.withColumn(r, rate(body())).withColumn(row, F.monotonically_increasing_id())
    times = F.sequence(F.lit(1).cast("long"), F.greatest(copies(F.col(r), F.col(row), F.col("doc_id")), F.lit(1)))
    return numbered.withColumn(copy, F.explode(times)).select(own_columns(docs.columns))
