"""Exact matching in galleries of any size: equal to the full scan, with fewer pairs."""
import numpy as np
import pytest

from hrlens.operators import vectors


def tables(spark, gallery, targets):
    cent = spark.createDataFrame([(f"p{i:04d}", [float(v) for v in g]) for i, g in enumerate(gallery)], "person string, centroid array<double>")
    t = spark.createDataFrame([(i, None if x is None else [float(v) for v in x]) for i, x in enumerate(targets)], "id long, v array<double>")
    return cent.repartition(3), t.repartition(3)


def unit(x):
    n = np.linalg.norm(x, axis=-1, keepdims=True)
    return np.where(n > 0, x / np.where(n > 0, n, 1), x)


@pytest.mark.parametrize("pivots", [None, 1, 40])
def test_equals_the_full_scan(spark, monkeypatch, pivots):
    monkeypatch.setattr(vectors, "CHUNK_PERSONS", 7)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 6))
    gallery = unit(centres[rng.integers(8, size=300)] + rng.normal(0, 0.1, (300, 6)))
    gallery[100:200] = gallery[100]  # a third of the persons are alike: the first one wins
    gallery[250] = 0
    targets = [*(centres[rng.integers(8, size=60)] + rng.normal(0, 0.2, (60, 6))), np.zeros(6), None, gallery[100], -gallery[100]]
    cent, t = tables(spark, gallery, targets)
    got = {r["id"]: r for r in vectors.nearest_centroid(t, "id", "v", cent, 0.35, n_pivots=pivots).collect()}
    assert len(got) == len(targets)
    for i, x in enumerate(targets):
        if x is None:
            assert (got[i]["best_person"], got[i]["best_sim"], got[i]["match_name"], got[i]["similarity"]) == (None, -1.0, "unknown", 0.0)
            continue
        sims = np.array([sum(a * b for a, b in zip(unit(np.asarray(x)), g)) for g in gallery])
        assert got[i]["best_sim"] == pytest.approx(sims.max()) and sims[int(got[i]["best_person"][1:])] == pytest.approx(sims.max())
        assert got[i]["is_match"] == (sims.max() >= 0.35)
    assert got[62]["best_person"] == "p0100" and got[60]["best_person"] == "p0000"


def test_bounds_leave_out_most_of_a_clustered_gallery(spark, monkeypatch):
    """Persons met at the joins, against all (target, person) pairs."""
    monkeypatch.setattr(vectors, "CHUNK_PERSONS", 16)
    rng = np.random.default_rng(2)
    centres = unit(rng.normal(size=(30, 12)))
    gallery = unit(centres[np.arange(1500) % 30] + rng.normal(0, 0.02, (1500, 12)))
    cent, t = tables(spark, gallery, centres + rng.normal(0, 0.02, centres.shape))
    met, meet = [], vectors._meet

    def counted(visits, chunks):
        both = meet(visits, chunks)
        met.append(both.selectExpr("sum(size(gallery))").first()[0] or 0)
        return both
    monkeypatch.setattr(vectors, "_meet", counted)
    out = vectors.nearest_centroid(t, "id", "v", cent, 0.35).collect()
    assert sum(r["is_match"] for r in out) == 30 and len(met) == 2
    assert sum(met) < 0.25 * 30 * 1500


def test_edges(spark):
    cent, t = tables(spark, np.eye(3), [[1, 0, 0], [0, 0, 0]])
    assert {r["best_person"] for r in vectors.nearest_centroid(t, "id", "v", cent.limit(0), 0.35).collect()} == {None}
    assert vectors.nearest_centroid(t.limit(0), "id", "v", cent, 0.35).collect() == []
    twice = t.union(t)
    assert vectors.nearest_centroid(twice, "id", "v", cent, 0.35).where("best_person = 'p0000'").count() == 4


def test_chunk_search_is_a_product(spark):
    """The product finds the person that the sum in order finds, ties to the first; odd vectors still go by folding."""
    rng = np.random.default_rng(7)
    y = unit(rng.normal(size=(40, 9)))
    y[20:30] = y[3]
    x = np.concatenate([unit(rng.normal(size=(3000, 9))), y])
    place, best = vectors.best_in_chunk(x, y)
    for i in [*range(0, 3000, 97), *range(3000, 3040)]:
        sums = []
        for g in y:
            s = 0.0
            for a, b in zip(x[i], g):
                s += a * b
            sums.append(s)
        assert best[i] == max(sums) and place[i] == sums.index(max(sums))
    cent = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [1.0]), ("d", [None, 5.0])], "person string, centroid array<double>")
    t = spark.createDataFrame([(1, [2.0, 0.0]), (2, [0.0, 3.0]), (3, [4.0]), (4, [None, 1.0])], "id long, v array<double>")
    got = {r["id"]: (r["best_person"], r["best_sim"]) for r in vectors.nearest_centroid(t, "id", "v", cent, 0.35, n_pivots=1).collect()}
    assert got == {1: ("a", 1.0), 2: ("b", 1.0), 3: ("c", 1.0), 4: (None, -1.0)}


def test_copies_of_targets_are_made_piece_by_piece(spark, monkeypatch):
    """A task never holds a batch's targets times all cells; the result is that of one piece."""
    import pandas as pd
    batch = pd.DataFrame({"row": range(100)})
    monkeypatch.setattr(vectors, "VISITED_VALUES", 60)
    pieces = list(vectors._pieces(batch, 4, 3))
    assert [len(p) for p in pieces] == [5] * 20 and pd.concat(pieces).equals(batch)
    rng = np.random.default_rng(5)
    gallery, targets = unit(rng.normal(size=(120, 3))), rng.normal(size=(40, 3))
    cent, t = tables(spark, gallery, targets)
    got = {r["id"]: r["best_person"] for r in vectors.nearest_centroid(t, "id", "v", cent, 0.35).collect()}
    assert got == {i: f"p{int(np.argmax(gallery @ x)):04d}" for i, x in enumerate(targets)}
