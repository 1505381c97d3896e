"""Written tables: parquet under the shared checkpoint folder, read back with the written schema."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def distinct_rows(df: DataFrame) -> DataFrame:
    """The distinct rows, by a hash aggregate of its own. Below a minimum or maximum the optimizer drops a plain
    ``distinct``, and one of strings sorts all of its input; it keeps a count that a filter needs."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 0").drop("_n")


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, mode: str = "overwrite") -> DataFrame:
    """Write ``df`` as parquet (optionally partitioned) and return the re-read table."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    # Read back with the written schema (partition columns last, as on disk): an empty
    # result leaves no data files, and inference would fail.
    parts = set(partition_by or [])
    fields = [f for f in df.schema.fields if f.name not in parts] + [f for f in df.schema.fields if f.name in parts]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)
