"""Rounding rules.

* Means of measures are exact: long sums of unscaled values, divided and
  rounded half away from zero in integer arithmetic (``exact_mean_col``).
  Spark's own decimal ``avg`` first rounds the mean to scale + 4 digits,
  which is kept only where that is the wanted semantics (day-of-year table).
* Mean day counts follow Python's ``round``: half to even (``F.bround``).
* Truncation toward zero (the shell ``bc scale=1`` behaviour) is
  ``sign(x) * floor(abs(x) * 10) / 10`` in decimal.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T


def ratio_half_up(num: Column, den: Column, scale: int = 1) -> Column:
    """``round(num / den, scale)`` half away from zero, exact for decimals.

    ``den`` is a count; a zero count yields NULL instead of an error.
    """
    n = num.cast(T.DecimalType(30, 8))
    d = F.when(den > 0, den.cast(T.DecimalType(20, 0)))
    return F.round(n / d, scale)


def ratio_half_even_int(num: Column, den: Column) -> Column:
    """Python ``round(num / den)``: half to even, integer result."""
    q = num.cast(T.DecimalType(30, 8)) / F.when(den > 0, den.cast(T.DecimalType(20, 0)))
    return F.bround(q, 0).cast(T.LongType())


def truncate_toward_zero(x: Column, scale: int = 1, to: T.DecimalType | None = None) -> Column:
    """Cut ``x`` to ``scale`` decimals toward zero (``bc`` with ``scale=1``)."""
    f = 10 ** scale
    d = x.cast(T.DecimalType(20, 6))
    cut = F.signum(d).cast("int") * F.floor(F.abs(d) * f)
    out = cut.cast(T.DecimalType(20, 0)) / F.lit(f)
    return out.cast(to or T.DecimalType(10, scale))


def half_up(x: Column, scale: int = 1, to: T.DecimalType | None = None) -> Column:
    """``printf %.1f``-style rounding in decimal (half away from zero)."""
    return F.round(x.cast(T.DecimalType(20, 6)), scale).cast(to or T.DecimalType(10, scale))


# --- long-arithmetic means ---------------------------------------------------
# Sums of unscaled longs stay in the fixed-width aggregation buffer (no
# BigDecimal per row) and the rounding is integer division, so these are both
# exact and cheap. The SQL text is parsed once per expression.

def _sgn(x: str) -> str:
    return f"(CASE WHEN {x} < 0 THEN -1 ELSE 1 END)"


def half_up_div_sql(num: str, den: str) -> str:
    """round_half_up(num / den) for longs, den > 0."""
    return f"({_sgn(num)} * ((2 * abs({num}) + {den}) div (2 * {den})))"


def _unscaled_sum(col: str, scale_in: int) -> str:
    # unscaled value through a double: exact while |unscaled| < 2^50, far
    # beyond any measure column, and much cheaper per row than decimal math
    return f"sum(CAST(floor(CAST({col} AS DOUBLE) * {10 ** scale_in} + 0.5) AS BIGINT))"


def mean_sql(col: str, scale_in: int, scale_out: int, to: str) -> str:
    """``round(avg(col), scale_out)`` half up, exact; ``col`` has ``scale_in`` decimals."""
    s, n = _unscaled_sum(col, scale_in), f"count({col})"
    num = f"({s} * {10 ** scale_out})" if scale_out else s
    den = f"({n} * {10 ** scale_in})" if scale_in else n
    q = half_up_div_sql(num, den)
    return (f"CAST(CASE WHEN {n} > 0 THEN CAST({q} AS DECIMAL(20, 0)) / {10 ** scale_out} END "
            f"AS {to})")


def exact_mean_col(col: str, scale_in: int, scale_out: int = 1, to: str = "DECIMAL(10, 1)") -> Column:
    """Aggregate: exact mean of ``col`` rounded half up (see :func:`mean_sql`)."""
    return F.expr(mean_sql(col, scale_in, scale_out, to))
