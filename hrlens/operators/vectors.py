"""Vector operators: normalisation, centroids, nearest-centroid matching (V1–V4).

Vectors stay ``array<double>`` columns and all reported arithmetic is higher-order SQL
functions (``aggregate``, ``transform``, ``zip_with``) — JVM-side, no UDF.

Matching is an exact search in a gallery of any size (V3).  A few pivots, persons drawn by hash, cut the gallery into
cells: a person belongs to its nearest pivot and keeps its distance from it.  Cells are packed, in order of that
distance, into chunks of bounded size.  A target first searches the chunks of its own nearest cell.  The similarity found
there limits how far a better person may be; by the triangle inequality a person at distance r from a pivot is no
nearer to the target than |D - r|, D being the target's distance from the pivot.  So only cells, and of these only
chunks, whose range of r reaches into the limit are searched then: a keyed join with a range condition.  A chunk and the
targets that meet it are one product of matrices; persons within rounding of the best are then compared by the sum in
order, so the similarity is that of folding over the arrays.  No (target, person) pair is a row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .persist import materialize

#: Pivots grow with the square root of the gallery up to this number (they go to every task).
MAX_PIVOTS = 256
#: Persons and numbers in one chunk of a cell.
CHUNK_PERSONS, CHUNK_VALUES = 512, 1 << 18
#: Of distances: more than their rounding.
SLACK = 1e-6
#: Targets that meet a chunk in one group, and targets multiplied at once.
GROUP_TARGETS, STEP = 8192, 1024
#: Numbers in the copies of targets that a task makes for the cells they visit, at a time.
VISITED_VALUES = 1 << 20


def as_double_array(c: Column) -> Column:
    return F.transform(c, lambda x: x.cast("double"))


def normalize(v: Column) -> Column:
    """v/‖v‖; the zero vector is returned unchanged; NULL stays NULL.

    The sum of squares is folded once and handed to the finish function, so
    the per-element division reads a lambda variable instead of recomputing
    the norm for every element.
    """
    return F.aggregate(v, F.lit(0.0), lambda acc, x: acc + x * x,
                       lambda ss: F.when(ss == 0, v).otherwise(F.transform(v, lambda x: x / F.sqrt(ss))))


def dot(a: Column, b: Column) -> Column:
    """Σ aᵢbᵢ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def elementwise_mean(df: DataFrame, key: str, vec: str) -> DataFrame:
    """Per key, the element-wise mean vector and the member count.

    Elements are exploded with their position and averaged per (key, position):
    the partial aggregation happens before the shuffle, so a key holding a
    third of all vectors costs map-side work only.  The vector is rebuilt in
    position order with ``sort_array`` over (pos, value) structs.
    """
    e = df.select(key, F.posexplode(vec).alias("pos", "x"))
    per = e.groupBy(key, "pos").agg(F.avg("x").alias("x"), F.count(F.lit(1)).alias("n"))
    return per.groupBy(key).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("mean_vec"),
        F.max("n").alias("n_members"))


def centroids(refs: DataFrame, person: str, vec: str) -> DataFrame:
    """V1+V2: normalise each reference vector, average per person, normalise the mean."""
    n = refs.select(F.col(person).alias("person"), normalize(as_double_array(F.col(vec))).alias("v")) \
            .where(F.col("v").isNotNull() & F.col("person").isNotNull())
    m = elementwise_mean(n, "person", "v")
    return m.select("person", F.col("n_members").alias("n_refs"), normalize(F.col("mean_vec")).alias("centroid"))


def _matrix(vectors, dim: int) -> np.ndarray:
    out = np.zeros((len(vectors), dim))
    for i, v in enumerate(vectors):
        out[i, :min(len(v), dim)] = np.nan_to_num(np.asarray(v, np.float64))[:dim]
    return out


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + (pivots * pivots).sum(axis=1) - 2 * x @ pivots.T, 0.0))


def _chunks(cent: DataFrame, pivots: np.ndarray, dim: int) -> DataFrame:
    """The gallery by cells: cell, lo and hi (distances from the pivot), norm (largest squared), gallery (sorted by person)."""
    most = max(1, min(CHUNK_PERSONS, CHUNK_VALUES // max(1, dim)))
    kind = cent.schema["person"].dataType.simpleString()
    columns = ["cell", "lo", "hi", "norm", "gallery"]

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = _matrix(batch["centroid"], dim)
            d = _distances(x, pivots)
            at = d.argmin(axis=1)
            yield batch.assign(cell=at.astype(np.int32), r=d[np.arange(len(x)), at], norm=(x * x).sum(axis=1))

    def packed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cell, held = None, []

        def chunk() -> tuple:
            r = [h[1] for h in held]
            return cell, min(r), max(r), max(h[2] for h in held), [{"person": h[0], "centroid": h[3]} for h in held]
        for batch in batches:
            out = []
            for c, *values in zip(batch["cell"], batch["person"], batch["r"], batch["norm"], batch["centroid"], strict=True):
                if held and (c != cell or len(held) == most):
                    out.append(chunk())
                    held = []
                cell = c
                held.append(values)
            if out:
                yield pd.DataFrame(out, columns=columns)
        if held:
            yield pd.DataFrame([chunk()], columns=columns)
    at = cent.select("person", "centroid").mapInPandas(placed, f"person {kind}, centroid array<double>, cell int, r double, norm double")
    ranged = at.repartitionByRange("cell", "r").sortWithinPartitions("cell", "r", "person")
    made = ranged.mapInPandas(packed, f"cell int, lo double, hi double, norm double, gallery array<struct<person:{kind},centroid:array<double>>>")
    return made.withColumn("gallery", F.sort_array("gallery"))


def _pieces(batch: pd.DataFrame, cells: int, dim: int) -> Iterator[pd.DataFrame]:
    """The targets in pieces whose copies, one a cell, hold at most VISITED_VALUES numbers."""
    step = max(1, VISITED_VALUES // max(1, cells * dim))
    for i in range(0, len(batch), step):
        yield batch.iloc[i:i + step]


def _meet(visits: DataFrame, chunks: DataFrame) -> DataFrame:
    """The chunks of the visited cells whose distances from the pivot lie between near and far."""
    return visits.join(chunks, "cell").where((F.col("lo") <= F.col("far")) & (F.col("hi") >= F.col("near")))


def _plain(v: Column, dim: int) -> Column:
    """A vector of the full length without missing or huge numbers."""
    return (F.size(v) == dim) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 1e150))


def best_in_chunk(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each row of x the first row of y with the largest product, summed in the order of the numbers, and that product."""
    place, best = np.zeros(len(x), np.int64), np.zeros(len(x))
    error = 1e-14 * (x.shape[1] + 1) * np.sqrt((x * x).sum(axis=1) * (y * y).sum(axis=1).max())
    for a in range(0, len(x), STEP):
        near = x[a:a + STEP] @ y.T
        i, j = np.nonzero(near >= (near.max(axis=1) - error[a:a + STEP])[:, None])
        s = np.zeros(len(i))
        for k in range(x.shape[1]):
            s += x[a + i, k] * y[j, k]
        order = np.lexsort((j, -s, i))
        first = order[np.searchsorted(i[order], np.arange(len(near)))]
        place[a:a + STEP], best[a:a + STEP] = j[first], s[first]
    return place, best


def nearest_centroid(targets: DataFrame, id_col: str, vec: str, cent: DataFrame,
                     threshold: float, unknown: str = "unknown", n_pivots: int | None = None) -> DataFrame:
    """V3+V4: best person by cosine (strict '>' → smallest person wins ties), thresholded.

    Output: id, match_name, best_person, best_sim, similarity (the reported value:
    best_sim when matched, else max(best_sim, 0)), is_match.  A target without a vector, or an
    empty gallery, has no best person and a best_sim of -1.
    """
    t = materialize(targets.select(F.col(id_col).alias("id"), normalize(as_double_array(F.col(vec))).alias("t"),
                                   F.monotonically_increasing_id().alias("row")), repartition=False)
    cent = materialize(cent.select("person", "centroid"), repartition=False)
    size = cent.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("centroid")).alias("dim")).first()
    n, dim = int(size["n"] or 0), int(size["dim"] or 0)
    wanted = n_pivots or min(MAX_PIVOTS, max(1, math.isqrt(n)))
    drawn = cent.orderBy(F.xxhash64(F.col("person").cast("string")), "person").limit(wanted).collect()  # at most MAX_PIVOTS
    pivots = _matrix([r["centroid"] for r in drawn], dim) if drawn else np.zeros((1, dim))
    chunks = materialize(_chunks(cent, pivots, dim).select(
        "*", F.monotonically_increasing_id().alias("chunk"), F.forall("gallery", lambda g: _plain(g["centroid"], dim)).alias("plain")), repartition=False)
    seen = t.agg(F.count(F.lit(1)), F.min(_plain(F.col("t"), dim))).first()
    salts, odd = max(1, -(-seen[0] // GROUP_TARGETS)), seen[1] is False or chunks.agg(F.min("plain")).first()[0] is False
    cells = {r["cell"]: r for r in chunks.groupBy("cell").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.max("norm").alias("norm")).collect()}
    own = np.array(sorted(cells), np.int64)  # a row a pivot at most
    lo, hi, norm = (np.array([cells[c][k] for c in own], np.float64) for k in ("lo", "hi", "norm"))
    kind = f"row long, t array<double>, cell int, far double, near double"

    def visits(batches: Iterator[pd.DataFrame], first: bool) -> Iterator[pd.DataFrame]:
        for batch in (piece for whole in batches for piece in _pieces(whole, 1 if first else len(own), dim)):
            if not len(own):
                continue
            x = _matrix(batch["t"], dim)
            d = _distances(x, pivots)[:, own]
            nearest = d.argmin(axis=1)
            if first:
                yield pd.DataFrame({"row": batch["row"], "t": batch["t"], "cell": own[nearest].astype(np.int32), "far": np.inf, "near": 0.0})
                continue
            # a person as good as the best so far is at most so far away
            sim = batch["sim"].to_numpy(np.float64)
            limit = np.sqrt(np.maximum((x * x).sum(axis=1)[:, None] + norm - 2 * sim[:, None], 0.0)) + SLACK
            keep = (np.maximum(d - hi, lo - d) <= limit) & (np.arange(len(own)) != nearest[:, None])
            i, j = np.nonzero(keep)
            if not len(i):
                continue
            yield pd.DataFrame({"row": batch["row"].to_numpy()[i], "t": [batch["t"].iloc[k] for k in i], "cell": own[j].astype(np.int32),
                                "far": d[i, j] + limit[i, j], "near": d[i, j] - limit[i, j]})

    init = F.struct(F.lit(None).cast("string").alias("person"), F.lit(-1.0).alias("sim"))

    def step(acc, g):
        # the dot product is folded once and compared in the finish function
        prods = F.zip_with(F.col("t"), g["centroid"], lambda x, y: x * y)
        return F.aggregate(prods, F.lit(0.0), lambda a, x: a + x,
                           lambda s: F.when(s > acc["sim"], F.struct(g["person"].cast("string").alias("person"),
                                                                     s.alias("sim"))).otherwise(acc))

    def search(there: pd.DataFrame, chunk: pd.DataFrame) -> pd.DataFrame:
        if there.empty or chunk.empty:
            return pd.DataFrame(columns=["row", "person", "sim"])
        place, sim = best_in_chunk(np.stack(there["t"]), np.stack(chunk["centroids"].iloc[0]))
        better = sim > -1.0
        person = np.where(better, np.asarray(chunk["persons"].iloc[0], object)[place], None)
        return pd.DataFrame({"row": there["row"].to_numpy(), "person": person, "sim": np.where(better, sim, -1.0)})

    def best_of(found: DataFrame) -> DataFrame:
        met = _meet(found.withColumn("whole", _plain(F.col("t"), dim)), chunks)
        at = met.where(F.col("whole") & F.col("plain")).select("row", "t", "chunk", F.pmod(F.xxhash64("row"), F.lit(salts)).alias("salt"))
        usual = chunks.where("plain")
        dealt = usual.select(F.col("chunk").alias("of_chunk"), F.transform("gallery", lambda g: g["person"].cast("string")).alias("persons"),
                             F.transform("gallery", lambda g: g["centroid"]).alias("centroids"),
                             F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))).alias("of_salt"))
        usual = at.groupBy("chunk", "salt").cogroup(dealt.groupBy("of_chunk", "of_salt")).applyInPandas(search, "row long, person string, sim double")
        usual = usual.select("row", F.struct("person", "sim").alias("b"))
        if not odd:
            return usual
        # vectors with missing numbers or of another length: folded one by one
        return usual.unionByName(met.where(~(F.col("whole") & F.col("plain"))).select("row", F.aggregate("gallery", init, step).alias("b")))
    # smallest (−sim, has_no_person, person): best similarity, then first person
    key = F.struct((-F.col("b.sim")).alias("neg_sim"), F.col("b.person").isNull().alias("none"), F.col("b.person").alias("person"))
    there = t.where(F.col("t").isNotNull()).select("row", "t")
    start = best_of(there.mapInPandas(lambda batches: visits(batches, True), kind)).groupBy("row").agg(F.min(key).alias("w"))
    start = materialize(start, repartition=False)
    more = best_of(there.join(start.select("row", (-F.col("w.neg_sim")).alias("sim")), "row").mapInPandas(lambda batches: visits(batches, False), kind))
    win = start.unionByName(more.groupBy("row").agg(F.min(key).alias("w"))).groupBy("row").agg(F.min("w").alias("w"))
    win = t.select("id", "row").join(win, "row", "left").select(
        F.col("id").alias(id_col), F.col("w.person").alias("best_person"), F.coalesce(-F.col("w.neg_sim"), F.lit(-1.0)).alias("best_sim"))
    matched = F.col("best_person").isNotNull() & (F.col("best_sim") >= threshold)
    return win.select(id_col,
                      F.when(matched, F.col("best_person")).otherwise(F.lit(unknown)).alias("match_name"),
                      "best_person", "best_sim",
                      F.when(matched, F.col("best_sim")).otherwise(F.greatest(F.col("best_sim"), F.lit(0.0)))
                       .alias("similarity"),
                      matched.alias("is_match"))


def box_area(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """F19."""
    return (x2 - x1) * (y2 - y1)


def largest_per_group(df: DataFrame, group: str, area: Column, tie_cols: list[str],
                      payload: list[str]) -> DataFrame:
    """Per group the row with the largest area; ties → first by ``tie_cols``.

    ``max_by`` with a struct ordering key is a partial aggregate (map-side
    combine), so a hot group does not reach one task whole.
    """
    order = F.struct(area.alias("a"), *[(-F.col(c)).alias(f"neg_{c}") for c in tie_cols])
    row = F.struct(*[F.col(c) for c in payload], area.alias("area"))
    return (df.groupBy(group).agg(F.max_by(row, order).alias("best"))
              .select(group, "best.*"))
