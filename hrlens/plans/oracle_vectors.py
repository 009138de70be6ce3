"""DuckDB oracle SQL for the vector keys."""

from __future__ import annotations

from ..operators.ml.split import exact_split_sql, split_sql
from .oracle_views import sig, with_views
from .vectors import SIM_THRESHOLD, UNKNOWN


def _norm(v: str) -> str:
    n = f"sqrt(list_reduce(list_transform({v}, lambda x: x * x), lambda a, b: a + b))"
    return f"(CASE WHEN {n} = 0 THEN {v} ELSE list_transform({v}, lambda x: x / {n}) END)"


def _vectors() -> str:
    test = split_sql("vec_id")
    return f"""WITH e AS (SELECT vec_id, CAST(label AS VARCHAR) AS person,
         list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v, {test} = 'test' AS is_target FROM embeddings),
n AS (SELECT vec_id, person, is_target, {_norm('v')} AS v FROM e WHERE v IS NOT NULL),
u AS (SELECT person, unnest(v) AS x, unnest(generate_series(1, len(v))) AS pos FROM n WHERE NOT is_target AND person IS NOT NULL),
m AS (SELECT person, pos, avg(x) AS x, count(*) AS cnt FROM u GROUP BY person, pos),
c0 AS (SELECT person, max(cnt) AS n_refs, list(x ORDER BY pos) AS mv FROM m GROUP BY person),
c AS (SELECT person, n_refs, {_norm('mv')} AS cv FROM c0)
"""


def sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["person_centroids"] = _vectors() + f"SELECT person, n_refs, list_transform(cv, lambda x: {sig('x')}) AS centroid FROM c"
    th = SIM_THRESHOLD
    def match(pairs: str) -> str:
        return _vectors() + (
            f", s AS ({pairs}), "
            f"b AS (SELECT vec_id, person, sim FROM s QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, person) = 1)\n"
            f"SELECT vec_id, CASE WHEN sim >= {th} THEN person ELSE '{UNKNOWN}' END AS match_name, person AS best_person, "
            f"{sig('sim')} AS best_sim, {sig(f'CASE WHEN sim >= {th} THEN sim ELSE greatest(sim, 0.0) END')} AS similarity, "
            f"sim >= {th} AS is_match FROM b")
    q["person_match"] = match("SELECT t.vec_id, c.person, list_dot_product(t.v, c.cv) AS sim FROM n t, c WHERE t.is_target")
    q["person_match_all"] = match("SELECT t.vec_id, c.person, list_dot_product(t.v, c.cv) AS sim FROM n t, c")
    q["vector_match"] = match("SELECT t.vec_id, format('v{:012d}', g.vec_id) AS person, list_dot_product(t.v, g.v) AS sim FROM n t, n g WHERE t.is_target AND NOT g.is_target")
    area = "(l_quantity - l_discount) * (l_extendedprice / 1000 - l_tax)"
    q["largest_box"] = (
        f"SELECT l_orderkey AS image_id, l_linenumber AS face_no, l_partkey, l_suppkey, {sig('area')} AS area FROM ("
        f"SELECT *, {area} AS area FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey "
        f"ORDER BY {area} DESC, l_linenumber, l_partkey, l_suppkey) = 1) t")
    q["split_exact"] = with_views("emp") + exact_split_sql("emp", "employee_id")
    q["split_check"] = with_views("emp") + f"SELECT employee_id, {split_sql('employee_id')} AS split FROM emp"
    return q
