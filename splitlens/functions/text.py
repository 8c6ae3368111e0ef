"""Number formatting that matches Python's ``f"{x:.{d}f}"``.

Python (and C's printf) round the *exact* binary value of a double; Java's
``%.nf`` rounds the shortest decimal text half-up, so e.g. 63.049999999999997
(printed "63.05") becomes "63.1" in Java but "63.0" in Python.  Here the value
is scaled by 10^d in double-double arithmetic (each *10 is 8x + 2x, both
exact, with the rounding error of the sum kept by TwoSum), rounded half-even
on the exact residual, and only the already-rounded value is formatted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _times10(hi: Column, lo: Column) -> tuple[Column, Column]:
    a = hi * 8.0
    b = hi * 2.0
    s = a + b
    bb = s - a
    err = (a - (s - bb)) + (b - bb)
    return s, err + lo * 10.0


def _fixed_body(v: Column, digits: int) -> Column:
    hi0 = F.abs(v)
    hi, lo = hi0, F.lit(0.0)
    for _ in range(digits):
        hi, lo = _times10(hi, lo)
    f = F.floor(hi).cast("double")
    frac = hi - f
    up = ((frac > 0.5)
          | ((frac == 0.5) & ((lo > 0) | ((lo == 0) & (F.pmod(f, F.lit(2.0)) == 1.0)))))
    n = f + F.when(up, F.lit(1.0)).otherwise(F.lit(0.0))
    bound = float(1 << 52) / 10 ** digits
    beyond = (hi0 >= bound) & (hi0 < float("inf"))
    body = F.when(beyond, F.raise_error(F.concat(F.lit(f"{digits} decimals of this number are not exact: "),
                                                 v.cast("string"))).cast("string")).otherwise(
        F.format_string(f"%.{digits}f", n / float(10 ** digits)))
    # The text form keeps the sign of -0.0, which Python prints as "-0.0".
    sign = F.when(v.cast("string").startswith("-"), F.lit("-")).otherwise(F.lit(""))
    return F.when(v.isNull(), F.lit(None).cast("string")).otherwise(F.concat(sign, body))


def fixed_str(x: Column, digits: int) -> Column:
    """Text of ``x`` with ``digits`` decimals, rounded like Python; NULL stays
    NULL.  Exact for |x| * 10^digits < 2^52; a larger finite number raises.

    The arithmetic refers to its input many times; it is evaluated on the
    variable of a one-element ``transform`` so that ``x`` -- possibly a large
    expression -- appears once in the plan instead of dozens of times."""
    return F.element_at(F.transform(F.array(x.cast("double")), lambda v: _fixed_body(v, digits)), 1)
