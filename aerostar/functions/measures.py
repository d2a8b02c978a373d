"""Aggregate expressions shared by the jobs.

Output-type rule (keeps results independent of row order and equal to an
exact-arithmetic engine): counts and integer sums are BIGINT; money sums are
summed exactly as DECIMAL and leave as DOUBLE; averages and ratios are one
IEEE division of exact sums; ROUND comes last.  Ratios use ``try_divide`` so
an empty denominator yields NULL (the original's ``NULLIF(x, 0)``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value of the original: arrival delay (minutes) at or below which a
# flight counts as on time.
ON_TIME_MINUTES = 15


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def rows() -> Column:
    return F.count(F.lit(1))


def count_if(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)`` (NULL condition counts 0)."""
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def int_sum(col: Column | str) -> Column:
    return F.sum(_c(col)).cast("long")


def money_sum(col: Column | str) -> Column:
    """Exact decimal sum, returned as DOUBLE."""
    return F.sum(_c(col)).cast("double")


def exact_avg(col: Column | str) -> Column:
    """AVG as exact sum / non-NULL count: no order-dependent double sums."""
    c = _c(col)
    return F.try_divide(F.sum(c).cast("double"), F.count(c).cast("double"))


# Extra decimal digits kept before the final rounding (see ``exact_round``).
GUARD_DIGITS = 3


def exact_round(num: Column, den: Column, digits: int) -> Column:
    """``ROUND(num / den, digits)`` of two integral values, computed exactly.

    The quotient is truncated (integer division) at ``digits`` + 3 places and
    then rounded HALF_UP (away from zero) as a DECIMAL, which equals rounding
    the exact rational -- the original's NUMERIC semantics.  Rounding a
    DOUBLE instead would depend on the binary representation of ties such as
    91.165.  NULL when ``den`` is 0 or NULL.  Returns DOUBLE.
    """
    g = digits + GUARD_DIGITS
    n = num.cast("decimal(38,0)")
    d = den.cast("decimal(38,0)")
    ad = F.when(d != 0, F.abs(d))
    big = F.abs(n) * F.lit(10 ** g).cast("decimal(20,0)")
    q = ((big - F.pmod(big, ad)) / ad).cast("decimal(38,0)")
    sign = (F.signum(n) * F.signum(d)).cast("decimal(1,0)")
    unit = F.lit(f"{10 ** -g:.{g}f}").cast(f"decimal({g + 1},{g})")
    scaled = (q * sign).cast("decimal(26,0)") * unit
    return F.round(scaled, digits).cast("double")


def ratio(num: Column, den: Column, digits: int | None = None, scale: int = 0) -> Column:
    """``num / NULLIF(den, 0)``; with ``digits``, rounded exactly.

    For rounding, ``num`` and ``den`` must become integers when multiplied
    by ``10**scale`` (e.g. ``scale=2`` for sums of money).
    """
    if digits is None:
        return F.try_divide(num.cast("double"), den.cast("double"))
    k = F.lit(10 ** scale)
    return exact_round(num * k, den * k, digits)


def pct(num: Column, den: Column, digits: int = 2, scale: int = 0) -> Column:
    """``ROUND(100.0 * num / NULLIF(den, 0), digits)``, exactly."""
    k = F.lit(10 ** scale)
    return exact_round(num * k * F.lit(100), den * k, digits)


def rounded_avg(col: Column | str, digits: int, scale: int = 0) -> Column:
    """``ROUND(AVG(col), digits)`` for a column with ``scale`` decimals."""
    c = _c(col)
    return ratio(F.sum(c), F.count(c), digits, scale)


def on_time(delay: Column | str = "ArrivalDelayMin", late: int = ON_TIME_MINUTES) -> Column:
    return _c(delay) <= late


MODES = ("reference", "corrected")


def check_mode(mode: str) -> bool:
    """True for ``corrected``: jobs with a quirk of the original offer both
    the original result (``reference``, the default) and a corrected one."""
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, got {mode!r}")
    return mode == "corrected"


def flight_costs(prefix: str = "", mode: str = "reference") -> Column:
    """Fuel + crew + fees of one flight row.

    ``reference``: NULL if any part is NULL (so the row drops out of SUM);
    ``corrected``: a missing part counts as 0.
    """
    parts = [F.col(prefix + c) for c in ("FuelCost", "CrewCost", "AirportFees")]
    if check_mode(mode):
        parts = [F.coalesce(p, F.lit(0)) for p in parts]
    return parts[0] + parts[1] + parts[2]


def weighted_avg(sum_col: Column, count_col: Column) -> Column:
    """Average from pre-aggregated (sum, count) pairs."""
    return F.try_divide(F.sum(sum_col).cast("double"), F.sum(count_col).cast("double"))
