"""DuckDB text of the boosting keys: bins by exact ranks, then each split of a tree as one step of materialised CTEs."""

from __future__ import annotations

from ..operators.ml import boost
from .boosting import FEATURES
from .oracle_views import PAY_WON, sig, with_views


def _binned(bins: int) -> str:
    """l: est_id, g (gradient at the mean), j (feature), b (bin); cuts: j, c."""
    x = ", ".join(f"CAST({'year(start_date)' if f == 'year' else f} AS DOUBLE)" for f in FEATURES)
    k = len(FEATURES)
    return with_views("est") + (
        f", d AS MATERIALIZED (SELECT est_id, y, x FROM (SELECT est_id, {PAY_WON} AS y, [{x}] AS x FROM est WHERE status_code = 1 AND headcount >= 1) q WHERE y IS NOT NULL), "
        f"v AS (SELECT est_id, CAST(j AS INTEGER) AS j, x[j] AS v FROM d, range(1, {k + 1}) t(j)), "
        "r AS (SELECT j, v, row_number() OVER (PARTITION BY j ORDER BY v) AS rn, count(*) OVER (PARTITION BY j) AS n, max(v) OVER (PARTITION BY j) AS top FROM v WHERE v IS NOT NULL), "
        f"cuts AS MATERIALIZED (SELECT j, list_sort(list(DISTINCT v)) AS c FROM r JOIN range(1, {bins}) q(i) ON rn = greatest(1, CAST(ceil(CAST(i AS DOUBLE) / {bins} * n) AS BIGINT)) "
        "WHERE v < top GROUP BY j), "
        "l AS MATERIALIZED (SELECT v.est_id, v.j, (SELECT avg(y) FROM d) - y AS g, "
        "CASE WHEN v IS NULL THEN 0 ELSE 1 + len([q FOR q IN coalesce(c, []) IF q < v]) END AS b FROM v JOIN d USING (est_id) LEFT JOIN cuts ON cuts.j = v.j)")


def _step(t: int, p: boost.Params, one: bool) -> str:
    """s{t}: the best split of each open node (of all nodes, if ``one``); a{t + 1}: the rows' nodes after it."""
    gain = f"gl * gl / (nl + {p.l2}) + (tg - gl) * (tg - gl) / (tn - nl + {p.l2}) - tg * tg / (tn + {p.l2})"
    first = "ORDER BY gain DESC, node, j, b" if one else "PARTITION BY node ORDER BY gain DESC, j, b"
    return (
        f", h{t} AS (SELECT node, j, b, sum(g) AS g, count(*) AS n FROM l JOIN a{t} USING (est_id) WHERE open GROUP BY node, j, b), "
        f"c{t} AS (SELECT node, j, b, sum(g) OVER w AS gl, sum(n) OVER w AS nl, sum(g) OVER (PARTITION BY node, j) AS tg, sum(n) OVER (PARTITION BY node, j) AS tn "
        f"FROM h{t} WINDOW w AS (PARTITION BY node, j ORDER BY b)), "
        f"e{t} AS (SELECT node, j, b, tn, gain AS raw, {sig('gain')} AS gain FROM (SELECT *, {gain} AS gain FROM c{t} "
        f"WHERE least(nl, tn - nl) >= {max(1, p.min_rows, int(p.min_hessian))}) q), "
        f"s{t} AS MATERIALIZED (SELECT node, j, b, tn, gain FROM e{t} WHERE gain > 0 QUALIFY row_number() OVER ({first}) = 1), "
        f"a{t + 1} AS MATERIALIZED (SELECT a.est_id, CASE WHEN s.node IS NULL THEN a.node ELSE 2 * a.node + CASE WHEN l.b <= s.b THEN 0 ELSE 1 END END AS node, "
        f"{'true' if one else 's.node IS NOT NULL'} AS open FROM a{t} a LEFT JOIN s{t} s ON s.node = a.node AND a.open LEFT JOIN l ON l.est_id = a.est_id AND l.j = s.j)")


def _tree(p: boost.Params, steps: int, one: bool) -> str:
    names = "[" + ", ".join(f"'{f}'" for f in FEATURES) + "]"
    out = _binned(p.bins) + ", a0 AS (SELECT est_id, CAST(1 AS BIGINT) AS node, true AS open FROM d)"
    out += "".join(_step(t, p, one) for t in range(steps))
    splits = " UNION ALL ".join(f"SELECT {t} AS step, node, j, b, gain FROM s{t}" for t in range(steps))
    # the rows that passed a node are those whose last node lies below it
    out += (
        f", sp AS MATERIALIZED ({splits}), fin AS (SELECT est_id, node, y FROM a{steps} JOIN d USING (est_id)), "
        "up AS (SELECT DISTINCT est_id, node >> CAST(i AS BIGINT) AS node, y FROM fin, range(0, 40) t(i) WHERE node >> CAST(i AS BIGINT) > 0), "
        f"val AS (SELECT node, count(*) AS n, -sum((SELECT avg(y) FROM d) - y) / (count(*) + {p.l2}) AS value FROM up GROUP BY node)\n"
        f"SELECT CAST(val.node AS VARCHAR) AS node, {'CAST(step AS INTEGER) AS step, ' if one else ''}{names}[sp.j] AS feature, c[b] AS cut, gain, n, CASE WHEN sp.node IS NULL THEN {sig('value')} END AS value "
        "FROM val LEFT JOIN sp USING (node) LEFT JOIN cuts ON cuts.j = sp.j")
    return out


def sql() -> dict[str, str]:
    leaf, depth = boost.LEAF_WISE, boost.DEPTH_WISE
    names = "[" + ", ".join(f"'{f}'" for f in FEATURES) + "]"
    return {
        "pay_leafwise_tree": _tree(leaf, leaf.max_leaves - 1, one=True),
        "pay_newton_tree": _tree(depth, depth.max_depth, one=False),
        "pay_gradient_histogram": _binned(leaf.bins) + (
            f"\nSELECT {names}[j] AS feature, CAST(b AS INTEGER) AS bin, any_value(CASE WHEN b > 0 THEN c[b] END) AS cut, count(*) AS n, round(sum(g), 2) AS gradient "
            "FROM l LEFT JOIN cuts USING (j) GROUP BY j, b"),
    }
