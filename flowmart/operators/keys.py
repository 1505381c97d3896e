"""Dense surrogate keys without a task that sees all rows.

Rows are dealt by ranges of (kind, order) and numbered inside their range; a range's first
number is the count of the ranges before it. The counts are one row per kind and range.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.operators.tables import write_table
from flowmart.session import scratch_path


def dense_keys(df: DataFrame, kind: str, order: list[str], keys: dict[str, Column],
               after: DataFrame | None = None, stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` with a key 1, 2, .. per ``kind`` in the order of ``order`` (which is unique there) for each
    of ``keys`` (name -> which rows get one; the others get null).

    ``after`` has (kind, one last number per key): new numbers go on from there. The dealt rows
    are staged, because another run of the sampling could deal them otherwise."""
    stage = stage or (lambda x: write_table(x, scratch_path(x.sparkSession, "keys")))
    by = [F.col(c).asc_nulls_first() for c in order]
    dealt = stage(df.repartitionByRange(F.col(kind), *by).withColumn("_range", F.spark_partition_id()))
    flag = {k: F.when(which, 1).otherwise(0) for k, which in keys.items()}
    inside = Window.partitionBy(kind, "_range").orderBy(*by).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = Window.partitionBy(kind).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(kind, "_range").agg(*[F.sum(f).alias(f"_n_{k}") for k, f in flag.items()])
    start = counts.select(kind, "_range", *[F.coalesce(F.sum(f"_n_{k}").over(before), F.lit(0)).alias(f"_from_{k}") for k in keys])
    if after is not None:
        last = after.select(kind, *[F.col(k).alias(f"_last_{k}") for k in keys])
        start = start.join(last, kind, "left").select(kind, "_range", *[(F.col(f"_from_{k}") + F.coalesce(f"_last_{k}", F.lit(0))).alias(f"_from_{k}") for k in keys])
    numbered = dealt.select("*", *[F.sum(f).over(inside).alias(f"_in_{k}") for k, f in flag.items()])
    # One row per kind and range: it fits any broadcast limit.
    out = numbered.join(F.broadcast(start), [kind, "_range"])
    return out.select(*df.columns, *[F.when(which, F.col(f"_from_{k}") + F.col(f"_in_{k}")).cast("int").alias(k) for k, which in keys.items()])
