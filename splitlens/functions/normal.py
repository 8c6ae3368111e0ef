"""Normal-distribution helpers as Column expressions.

Spark has no ``erf``/``erfc``.  The two-sided p-value of a z statistic is
``erfc(|z| / sqrt(2))``; it is built here as an ordinary SQL expression, so it
stays inside whole-stage codegen and the very same text runs in DuckDB for the
test oracle:

* x < 2.5: ``erfc = 1 - 2/sqrt(pi) * exp(-x^2) * x * S`` with the all-positive
  series ``S = sum_n (2x^2)^n / (1*3*...*(2n+1))`` (Horner form);
* x >= 2.5: Laplace's continued fraction
  ``erfc = exp(-x^2)/sqrt(pi) / (x + (1/2)/(x + 1/(x + (3/2)/(x + ...))))``.

Each branch clamps x to its own range, so neither can divide by zero whichever
way an engine evaluates CASE.  Quantiles of literal probabilities (alpha,
power) are constants and are computed once on the driver.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column
from pyspark.sql import functions as F

SERIES_TERMS = 60
FRACTION_DEPTH = 60
SWITCH = "2.5"


def _dbl(v: str) -> str:
    return f"cast({v} as double)"


def erfc_sql(x: str, terms: int = SERIES_TERMS, depth: int = FRACTION_DEPTH) -> str:
    """SQL text of erfc(x) for a non-negative double expression ``x``."""
    xs = f"least({x}, {_dbl(SWITCH)})"
    y = f"(2 * {xs} * {xs})"
    s = "1"
    for k in range(terms, 0, -1):
        s = f"(1 + {y} / {2 * k + 1} * {s})"
    series = f"(1 - 2 / sqrt(pi()) * exp(-({xs} * {xs})) * {xs} * {s})"

    xf = f"greatest({x}, {_dbl(SWITCH)})"
    frac = xf
    for k in range(depth, 0, -1):
        frac = f"({xf} + {_dbl(str(k / 2))} / {frac})"
    fraction = f"(exp(-({xf} * {xf})) / sqrt(pi()) / {frac})"
    return f"(case when {x} < {_dbl(SWITCH)} then {series} else {fraction} end)"


def two_sided_p_sql(z: str) -> str:
    """SQL text of the two-sided normal p-value 2*sf(|z|)."""
    return erfc_sql(f"(abs({z}) / sqrt(2))")


def erfc_loop_sql(x: str, terms: int = SERIES_TERMS, depth: int = FRACTION_DEPTH) -> str:
    """erfc(x) with the same recurrences written as Spark ``aggregate`` loops.

    Numerically identical to :func:`erfc_sql` but a compact expression: the
    unrolled form costs seconds of code generation per query, the loop form
    evaluates in microseconds (it is applied after aggregation, to one row per
    run)."""
    xs = f"least({x}, {_dbl(SWITCH)})"
    xf = f"greatest({x}, {_dbl(SWITCH)})"
    series = (f"(1 - 2 / sqrt(pi()) * exp(-({xs} * {xs})) * {xs} * "
              f"aggregate(sequence({terms}, 1, -1), cast(1 as double), "
              f"(acc, k) -> 1 + (2 * {xs} * {xs}) / (2 * k + 1) * acc))")
    fraction = (f"(exp(-({xf} * {xf})) / sqrt(pi()) / "
                f"aggregate(sequence({depth}, 1, -1), {xf}, (acc, k) -> {xf} + (k / 2.0D) / acc))")
    return f"(case when {x} < {_dbl(SWITCH)} then {series} else {fraction} end)"


def two_sided_p(z_name: str) -> Column:
    """Column of the two-sided p-value 2*sf(|z|) for the column named ``z_name``."""
    return F.expr(erfc_loop_sql(f"(abs(`{z_name}`) / sqrt(2))"))


def z_quantile(p: float) -> float:
    """Standard normal quantile (driver-side constant)."""
    return NormalDist().inv_cdf(p)
