"""Round half-to-even on the exact binary value of a double.

Python's ``round(x, d)`` decides ties on the exact binary value of ``x``;
Spark's ``bround`` (and DuckDB's ``round_even``) decide them on the shortest
decimal form, so ``round(0.665, 2)`` is 0.67 in Python but 0.66 in both
engines. The expression below settles the tie exactly with plain double
arithmetic: ``x`` is split into two halves (Veltkamp) so that ``x * 10**d``
is the exact sum of two doubles, and the sign of its distance to the
half-way point is then exact. It stays a JVM-side expression, and the same
text runs in DuckDB, so the oracle rounds identically.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPLIT = 134217729.0          # 2**27 + 1
_EXACT_LIMIT = 4503599627370496.0  # 2**52: above it every double is whole


def py_round(c: Column, digits: int) -> Column:
    """Column form of Python's ``round(x, digits)`` for doubles."""
    x = c.cast("double")
    s = float(10 ** digits)
    k = F.floor(x * F.lit(s))
    t = x * F.lit(_SPLIT)
    hi = t - (t - x)
    lo = x - hi
    d = (hi * F.lit(s) - (k + F.lit(0.5))) + lo * F.lit(s)
    up = (F.when(d > 0, F.lit(1)).when(d < 0, F.lit(0))
          .when(F.abs(k % 2) == 1, F.lit(1)).otherwise(F.lit(0)))
    return (F.when(x.isNull(), F.lit(None).cast("double"))
            .when(~(F.abs(x) * F.lit(s) < F.lit(_EXACT_LIMIT)), x)
            .when(k + up == 0, x * F.lit(0.0))   # keeps the sign of zero, as Python
            .otherwise((k + up) / F.lit(s)))


def py_round_sql(x: str, digits: int) -> str:
    """The same rounding as SQL text (valid in Spark SQL and DuckDB)."""
    s = f"CAST({10 ** digits} AS DOUBLE)"
    xd = f"CAST(({x}) AS DOUBLE)"
    k = f"floor({xd} * {s})"
    t = f"({xd} * CAST({_SPLIT!r} AS DOUBLE))"
    hi = f"({t} - ({t} - {xd}))"
    lo = f"({xd} - {hi})"
    d = f"((({hi} * {s}) - ({k} + CAST(0.5 AS DOUBLE))) + ({lo} * {s}))"
    up = (f"(CASE WHEN {d} > 0 THEN 1 WHEN {d} < 0 THEN 0 "
          f"WHEN abs({k} % 2) = 1 THEN 1 ELSE 0 END)")
    return (f"(CASE WHEN {xd} IS NULL THEN CAST(NULL AS DOUBLE) "
            f"WHEN NOT (abs({xd}) * {s} < CAST({_EXACT_LIMIT!r} AS DOUBLE)) THEN {xd} "
            f"WHEN ({k} + {up}) = 0 THEN {xd} * CAST(0.0 AS DOUBLE) "
            f"ELSE ({k} + {up}) / {s} END)")


def fixed2(c: Column) -> Column:
    """Python's ``f"{x:.2f}"``: exact-binary rounding, then two decimals."""
    return F.format_string("%.2f", py_round(c, 2))


def fixed2_sql(x: str) -> str:
    return f"printf('%.2f', {py_round_sql(x, 2)})"
