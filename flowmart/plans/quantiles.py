"""Exact continuous percentile of a DECIMAL(10,3) column in two passes, without a collect.

1. One pass counts the values and sketches them (``percentile_approx``): the values at ranks a little
   below and above the wanted one bracket both ranks that the interpolation needs. The sketch's
   rank error is 1 / ACCURACY of the rows; the bracket leaves three times that on either side.
2. One pass counts what lies below the bracket and, per distinct value, what lies inside; a running
   sum over these few values gives the values at the exact ranks.

Both results are scalar subqueries, so the caller's plan stays lazy. The window of the second
pass sees the distinct thousandths inside the bracket, at most WHOLE or 6 / ACCURACY of the rows. A rank
outside the bracket (the sketch broke its promise) is an error, never a wrong bound.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ACCURACY = 100_000
#: Up to so many rows the bracket is the whole column (the margin would be less than a few ranks).
WHOLE = 1_000_000


def above_percentile(df: DataFrame, col: str, hundredths: int) -> Column:
    """The smallest DECIMAL(10,3) value strictly above ``percentile_cont(hundredths / 100)`` of
    ``col``, as a scalar subquery: ``x > percentile`` is ``x >= above_percentile``, which
    compares the column itself and so can be pushed into the scan. NULL without values."""
    values = df.filter(F.col(col).isNotNull()).select((F.col(col) * 1000).cast("bigint").alias("v"))
    p, margin = hundredths / 100, 3 / ACCURACY
    ends = F.percentile_approx("v", [max(0.0, p - margin), min(1.0, p + margin)], ACCURACY)
    few = F.count(F.lit(1)) <= WHOLE
    low = F.min("v") if p <= margin else F.when(few, F.min("v")).otherwise(ends[0])
    high = F.max("v") if p >= 1 - margin else F.when(few, F.max("v")).otherwise(ends[1])
    sketch = values.agg(F.struct(F.count(F.lit(1)).alias("n"), low.alias("low"), high.alias("high")).alias("s")).scalar()
    h = F.lit(hundredths) * (sketch["n"] - 1)
    first, part = F.floor(h / 100).cast("bigint"), h % 100
    second = first + F.when(part > 0, 1).otherwise(0)

    inside = F.greatest(F.col("v"), sketch["low"] - 1)  # all below the bracket is one group
    counts = values.filter(F.col("v") <= sketch["high"]).groupBy(inside.alias("v")).agg(F.count(F.lit(1)).alias("n"))
    run = counts.select("v", F.sum("n").over(Window.orderBy("v")).alias("to"))
    at = lambda rank: F.min(F.when(F.col("to") > rank, F.col("v")))
    found = run.agg(F.struct(at(first).alias("a"), at(second).alias("b")).alias("s")).scalar()
    a, b = found["a"], found["b"]
    exact = a * 100 + part * (b - a)  # the interpolated percentile in 1e-5 seconds
    bound = ((F.floor(exact / 100) + 1).cast("decimal(13,0)") / 1000).try_cast("decimal(10,3)")  # null: nothing fits above
    held = (a >= sketch["low"]) & b.isNotNull()
    return F.when(sketch["n"] == 0, F.lit(None)).when(held, bound).otherwise(F.raise_error(F.lit("the rank lies outside the sketch's bracket")))
