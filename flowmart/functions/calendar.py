"""Calendar attributes as column expressions over epoch seconds / timestamps.

Both time dimensions are pure functions of their key (epoch seconds of the second, or of
the hour start), so facts can carry the key and derive attributes without a join.
Requires ``spark.sql.session.timeZone=UTC`` (set by ``flowmart.session.ensure_conf``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowmart.functions.classify import BUSINESS_HOURS, PEAK_HOURS

SECONDS_PER_HOUR = 3600


def hour_start(epoch: Column) -> Column:
    """Epoch seconds of the hour that contains ``epoch`` (floor, also for negatives)."""
    return (epoch - F.pmod(epoch, F.lit(SECONDS_PER_HOUR))).cast("bigint")


def to_ts(epoch: Column) -> Column:
    return F.timestamp_seconds(epoch)


def pg_dow(ts: Column) -> Column:
    """Day of week with 0 = Sunday ... 6 = Saturday."""
    return (F.dayofweek(ts) - 1).cast("int")


def is_weekend(ts: Column) -> Column:
    return pg_dow(ts).isin(0, 6)


def padded_name(ts: Column, pattern: str) -> Column:
    """Full day / month name right-padded to 9 characters."""
    return F.rpad(F.date_format(ts, pattern), 9, " ")


def hour_attributes(time_id: Column) -> list[Column]:
    """Mart-generation hour dimension attributes for ``time_id`` = epoch of the hour start."""
    ts = to_ts(time_id)
    hour = F.hour(ts)
    weekend = is_weekend(ts)
    return [
        time_id.cast("bigint").alias("time_id"),
        ts.alias("datetime"),
        hour.cast("int").alias("hour"),
        F.dayofmonth(ts).cast("int").alias("day"),
        F.month(ts).cast("int").alias("month"),
        F.year(ts).cast("int").alias("year"),
        F.when(weekend, F.lit("WEEKEND")).otherwise(F.lit("WEEKDAY")).alias("day_type"),
        padded_name(ts, "EEEE").alias("day_name"),
        padded_name(ts, "MMMM").alias("month_name"),
        (hour.between(*BUSINESS_HOURS) & ~weekend).alias("is_business_hour"),
        hour.isin(*PEAK_HOURS).alias("is_peak_hour"),
        F.weekofyear(ts).cast("int").alias("week_of_year"),
        F.quarter(ts).cast("int").alias("quarter"),
    ]


def second_attributes(time_key: Column) -> list[Column]:
    """Simple-generation time dimension attributes for ``time_key`` = epoch seconds."""
    ts = to_ts(time_key)
    return [
        time_key.cast("bigint").alias("time_key"),
        ts.alias("timestamp"),
        F.hour(ts).cast("int").alias("hour"),
        F.dayofmonth(ts).cast("int").alias("day"),
        F.month(ts).cast("int").alias("month"),
        F.quarter(ts).cast("int").alias("quarter"),
        F.year(ts).cast("int").alias("year"),
        is_weekend(ts).alias("is_weekend"),
    ]
