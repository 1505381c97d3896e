"""Numeric helpers shared by the queries.

Averages are exact and order-independent
-----------------------------------------
A sum of doubles depends on the order in which partial sums are combined, i.e. on the
partitioning, so a rounded average could change between cluster layouts. Here an
average at ``scale`` decimals is computed from two partial aggregates that are exact
and associative - ``s = sum(x * 10^scale)`` as a decimal(38,0) integer and ``n =
count(x)`` - and finished with integer arithmetic:

    avg = sign(s) * ((2*|s| + n) div (2*n)) / 10^scale      (half away from zero)

which is the NUMERIC rounding of the exact mean. ``avg_parts`` goes into ``agg``;
``avg_finish`` projects the result. The oracle uses the same formula.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUND = 6
EXACT = "decimal(28,6)"


def r6(col: Column) -> Column:
    return F.round(col.cast("double"), ROUND)


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def avg_parts(col: Column | str, name: str, scale: int = ROUND) -> list[Column]:
    """Partial aggregates of an exact average (use inside ``agg``)."""
    x = _c(col)
    fixed = (x.cast(f"decimal(28,{scale})") * F.lit(10**scale)).cast("decimal(38,0)")
    return [F.sum(fixed).alias(f"{name}__s"), F.count(x).alias(f"{name}__n")]


def avg_sql(s: str, n: str, scale: int, int_div: str = "div") -> str:
    return (
        f"CASE WHEN {n} = 0 THEN NULL ELSE "
        f"CAST(sign({s}) * ((2 * abs({s}) + {n}) {int_div} (2 * {n})) AS DOUBLE) / {10**scale} END"
    )


def avg_value(name: str, scale: int = ROUND) -> Column:
    return F.expr(avg_sql(f"`{name}__s`", f"`{name}__n`", scale))


def avg_finish(df: DataFrame, names: list[str] | str, scale: int = ROUND, zero_if_null: bool = False) -> DataFrame:
    """Replace the partial columns of each average by its rounded value (double)."""
    for name in [names] if isinstance(names, str) else names:
        v = avg_value(name, scale)
        if zero_if_null:
            v = F.coalesce(v, F.lit(0.0))
        df = df.withColumn(name, v).drop(f"{name}__s", f"{name}__n")
    return df


def mean_raw(name: str) -> Column:
    """Unrounded mean (double) from the partials of ``name``."""
    return F.try_divide(F.col(f"{name}__s").cast("double"), F.col(f"{name}__n").cast("double"))


def pct(part: Column, whole: Column) -> Column:
    """``ROUND(100.0 * part / whole, 2)`` as double (NULL when ``whole`` is 0)."""
    return F.round(F.try_divide(F.lit(100.0) * part.cast("double"), F.nullif(whole.cast("double"), F.lit(0.0))), 2)


def ratio(num: Column, den: Column, scale: int = ROUND) -> Column:
    """``num / NULLIF(den, 0)`` rounded to ``scale`` decimals."""
    return F.round(F.try_divide(num.cast("double"), F.nullif(den.cast("double"), F.lit(0.0))), scale)


def small_distinct(col: Column | str) -> Column:
    """Exact ``COUNT(DISTINCT col)`` for a small non-negative integer domain (< 63 values,
    e.g. hour of day, day of month, month): popcount of ``bit_or(2^col)``. Unlike a
    distinct aggregate it needs no Expand (row replication) and combines map-side."""
    c = _c(col)
    bit = F.pow(F.lit(2), c).cast("bigint")  # 2^c is exact in double and bigint for c <= 62
    return F.coalesce(F.bit_count(F.bit_or(bit)), F.lit(0)).cast("bigint")
