"""DuckDB text of distribution tails for the test-report oracles.

The upper tail of F (and two-sided t) is an incomplete beta function.  With x = 1 / (1 + z) and w0 = sqrt(a ln(1 + z)),
I_x(a, b) is the integral of g(w) = 2 w exp(-w * w) (1 - exp(-w * w / a))^(b - 1) from w0 on over that from 0 on.
g is smooth for whole and half b, so Simpson's rule is accurate.
"""

from __future__ import annotations

STEPS = 20000


def beta_tail(src: str, name: str) -> str:
    """CTE ``name`` (id, p) from CTE ``src`` (id, a, b, z): p = I_{1/(1+z)}(a, b)."""
    def term(w: str, over: str) -> str:
        u = f"{w} * {w} / a"
        return f"sum(wt * 2 * {w} * exp(b - {over}) * exp((b - 1) * ln(2 * exp(-{u} / 2) * sinh({u} / 2) * a / b)))"
    return (f"{name}_w AS (SELECT id, a, b, sqrt(a * ln(1 + z)) AS w0, greatest((sqrt(b) + 9) * i / {STEPS}.0, 1e-9) AS w, "
            f"CASE WHEN i = 0 OR i = {STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS wt "
            f"FROM {src}, range({STEPS} + 1) r(i)), "
            f"{name} AS (SELECT id, exp(-any_value(w0 * w0)) * {term('(w0 + w)', 'w * (w + 2 * w0)')} / {term('w', 'w * w')} AS p "
            f"FROM {name}_w GROUP BY id)")


def t_quantile(src: str, name: str, alpha: float = 0.05, z: float = 1.959963984540054) -> str:
    """CTE ``name`` (t): the two-sided ``alpha`` quantile for the df ``nu`` of CTE ``src`` (one row).

    Starts at the expansion around the normal quantile ``z``; three Newton steps on the tail.
    """
    start = f"{z} + ({z ** 3 + z}) / (4 * nu) + ({5 * z ** 5 + 16 * z ** 3 + 3 * z}) / (96 * nu * nu)"
    out = [f"{name}_0 AS (SELECT nu, {start} AS t FROM {src})"]
    for i in range(3):
        out.append(f"{name}_s{i} AS (SELECT 0 AS id, nu / 2 AS a, 0.5 AS b, t * t / nu AS z FROM {name}_{i})")
        out.append(beta_tail(f"{name}_s{i}", f"{name}_p{i}"))
        density = ("exp(-(nu + 1) / 2 * ln(1 + t * t / nu) - ln(nu) / 2 - lgamma(nu / 2) - lgamma(0.5::DOUBLE) + lgamma(nu / 2 + 0.5))")
        out.append(f"{name}_{i + 1} AS (SELECT nu, t + (p - {alpha}) / (2 * {density}) AS t FROM {name}_{i}, {name}_p{i})")
    out.append(f"{name} AS (SELECT t FROM {name}_3)")
    return ", ".join(out)
