"""File sources for connection records.

* ``read_with_header``   - CSV with a header row, explicit schema (S1).
* ``read_raw_lines``     - headerless files as (file, line_number, raw_line) with exact,
                           distributed line numbers (S2) and blank lines dropped (S4).
* ``parse_lines``        - positional split into the 49 typed staging fields (S3); empty
                           fields become NULL, unparsable numbers become NULL and are
                           reported by ``parse_errors`` (S8).
* ``read_features`` / ``missing_required_features`` - feature dictionary (S5/S6).

Line numbers: a file may be split across many tasks, and Spark does not expose a line
offset. Each row gets ``monotonically_increasing_id`` (ordered within a task) and the
block it was read from (``_metadata.file_block_start``); one small aggregation gives
rows per block, a window over blocks (a few per file) turns them into offsets, and a
join adds the offset back (its plan is Spark's choice: the block list grows with the data).
Exact, and no task ever holds a whole file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmart.sources.schema import FEATURES_SCHEMA, REQUIRED_FEATURES, STAGING_FIELDS, STAGING_SCHEMA, conform

BOM = "﻿"


def read_with_header(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row into the staging schema (no inference)."""
    df = spark.read.schema(STAGING_SCHEMA).option("header", True).option("enforceSchema", True).csv(path)
    return conform(df)


def read_raw_lines(spark: SparkSession, path: str) -> DataFrame:
    """S2 + S4: (file_name, line_number, raw_line) of every non-blank line."""
    raw = spark.read.text(path).select(
        F.col("value").alias("raw_line"),
        F.col("_metadata.file_path").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block_start"),
        F.monotonically_increasing_id().alias("row_id"),
    )
    blocks = raw.groupBy("file_name", "block_start").agg(
        F.count(F.lit(1)).alias("rows"), F.min("row_id").alias("first_row_id")
    )
    w = Window.partitionBy("file_name").orderBy("block_start").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("offset", F.coalesce(F.sum("rows").over(w), F.lit(0)))
    numbered = raw.join(blocks.select("file_name", "block_start", "offset", "first_row_id"), ["file_name", "block_start"])
    line_number = F.col("offset") + (F.col("row_id") - F.col("first_row_id")) + 1
    out = numbered.select("file_name", line_number.alias("line_number"), "raw_line")
    return out.filter(~F.col("raw_line").rlike(r"^\s*$"))


def _fields(lines: DataFrame) -> DataFrame:
    """The lines with their fields as an array, split once; a byte-order mark can only be on a
    file's first line."""
    line = F.when((F.col("line_number") == 1) & F.col("raw_line").startswith(BOM), F.substring("raw_line", 2, 1 << 30)).otherwise(F.col("raw_line"))
    return lines.select("file_name", "line_number", "raw_line", F.split(line, ",").alias("_f"))


def _field(i: int) -> Column:
    return F.nullif(F.get("_f", F.lit(i)), F.lit(""))


def parse_lines(lines: DataFrame, keep_source: bool = False) -> DataFrame:
    """S3: each line's fields as the 49 staging fields.

    A leading byte-order mark is removed; empty and missing fields are NULL for every column
    (text included); numbers are parsed with ``try_cast`` so a bad value is NULL, not a failed
    load (``parse_errors`` lists them)."""
    cols = [_field(i).try_cast(dtype).alias(name) for i, (name, dtype) in enumerate(STAGING_FIELDS)]
    keep = ["file_name", "line_number", "raw_line"] if keep_source else []
    return _fields(lines).select(*keep, *cols)


def parse_errors(lines: DataFrame) -> DataFrame:
    """Load-error log (file_name, line_number, error_message, raw_data) for fields that
    are present but do not parse as their declared type."""
    messages = [
        F.when(_field(i).isNotNull() & _field(i).try_cast(dtype).isNull(), F.lit(f"invalid {name}"))
        for i, (name, dtype) in enumerate(STAGING_FIELDS)
        if not isinstance(dtype, T.StringType)
    ]
    out = _fields(lines).select("file_name", "line_number", F.concat_ws("; ", *messages).alias("error_message"), F.col("raw_line").alias("raw_data"))
    return out.filter(F.col("error_message") != "")


def load_source_data(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines -> typed staging (line identity dropped)."""
    return parse_lines(read_raw_lines(spark, path))


def write_lines(staging: DataFrame, path: str) -> None:
    """Write staging rows as headerless positional CSV lines (the source format)."""
    fields = [F.coalesce(F.col(n).cast("string"), F.lit("")) for n, _ in STAGING_FIELDS]
    staging.select(F.concat_ws(",", *fields).alias("value")).write.mode("overwrite").text(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Feature dictionary (CSV with header)."""
    return spark.read.schema(FEATURES_SCHEMA).option("header", True).csv(path)


def missing_required_features(features: DataFrame) -> DataFrame:
    """Required feature names absent from the dictionary (all nine are required)."""
    spark = features.sparkSession
    required = spark.createDataFrame([(n,) for n in REQUIRED_FEATURES], "name string")
    return required.join(features.select(F.lower(F.trim("name")).alias("name")), "name", "left_anti")


def load_all(spark: SparkSession, features_path: str, data_path: str) -> tuple[DataFrame, DataFrame]:
    """Check the feature dictionary (all required names present), load the data
    files, and return (staging, one-row data-quality profile)."""
    from flowmart.operators.quality import quality_profile

    missing = [r["name"] for r in missing_required_features(read_features(spark, features_path)).collect()]
    if missing:
        raise ValueError(f"the feature dictionary lacks: {', '.join(sorted(missing))}")
    staging = load_source_data(spark, data_path)
    return staging, quality_profile(staging)
