"""Rollups, special facts and materialised views of the mart generation (R1-R3i, F6, F7, R8-R11).

Inputs are the written connection fact (surrogate keys, ``time_id`` = epoch of the hour)
and the size-checked dimensions. Calendar attributes come from ``time_id`` itself.

Scale notes
- The fact is read once for the port grain, with all measures (the hourly base and the special
  facts are finished from it; hours, days and months from the base), and once for the sets
  of source ports, with its keys only.
- Peaks are small aggregates joined back; there are no windows over the rollup.
- Distinct ports are bit sets in words of 64 bits, which merge over any hours: no Expand, no explode.
- Averages of decimal measures use exact decimal sums (order-independent), then the
  declared NUMERIC(10,3) rounding.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.functions import calendar as cal
from flowmart.functions.numeric import avg_finish, avg_parts, avg_value, mean_raw, pct

DEC3 = 3


def _window(df: DataFrame, t0: int | None, t1: int | None) -> DataFrame:
    """``datetime BETWEEN t0 AND t1`` on the hour key (epoch seconds, inclusive)."""
    if t0 is not None:
        df = df.filter(F.col("time_id") >= F.lit(t0))
    if t1 is not None:
        df = df.filter(F.col("time_id") <= F.lit(t1))
    return df


def connections(fact: DataFrame, attack: DataFrame, t0: int | None = None, t1: int | None = None) -> DataFrame:
    """Fact rows with ``is_attack``/``category`` (broadcast lookup) and calendar columns."""
    f = _window(fact, t0, t1).join(attack.select("attack_id", "is_attack", "category"), "attack_id", "inner")
    ts = cal.to_ts(F.col("time_id"))
    return (
        f.withColumn("datetime", ts)
        .withColumn("hour", F.hour(ts))
        .withColumn("day", F.dayofmonth(ts))
        .withColumn("month", F.month(ts))
        .withColumn("day_start", F.col("time_id") - F.pmod(F.col("time_id"), F.lit(86400)))
        .withColumn("month_start", F.unix_seconds(F.date_trunc("month", ts)))
    )


def _avg3(col: Column, name: str) -> list[Column]:
    """Partials of AVG into NUMERIC(10,3) (exact; finished by ``avg_finish(.., 3)``)."""
    return avg_parts(col, name, DEC3)


def _z(col: Column) -> Column:
    return F.coalesce(col, F.lit(0))


def _when_attack(col: Column, attack: bool) -> Column:
    return F.when(F.col("is_attack") == F.lit(attack), col)


KEYS = ["service_id", "protocol_id", "attack_id"]
# ---- one base per hour: every rollup is finished from it ------------------------------

def _calendar(df: DataFrame) -> DataFrame:
    """hour / day / day_start / month_start of ``time_id`` (a pure function of the key)."""
    ts = cal.to_ts(F.col("time_id"))
    return (
        df.withColumn("hour", F.hour(ts))
        .withColumn("day", F.dayofmonth(ts))
        .withColumn("day_start", F.col("time_id") - F.pmod(F.col("time_id"), F.lit(86400)))
        .withColumn("month_start", F.unix_seconds(F.date_trunc("month", ts)))
    )


#: Ports per word of a port set.
WORD = 64
SOURCE, DEST = 0, 1


def port_words(conn: DataFrame, grain: DataFrame) -> DataFrame:
    """The exact sets of ports per (hour, service, protocol, attack) and kind (source, destination), as
    words of 64 bits: (.., kind, word, mask), a bit per port id. Sets merge by ``bit_or`` and are counted by
    ``bit_count``, so days, months and any window get exact distinct ports from the hours.

    Words are plain longs: partial aggregation keeps 8 bytes per group and word, a group with few
    ports has few words, and a full one has 1,024 per kind. Source ports take one scan of the
    fact's five key columns, destination ports come from ``port_grain``."""
    def words(df: DataFrame, port: str, kind: int) -> DataFrame:
        bit = F.expr(f"shiftleft(1L, cast({port} % {WORD} as int))")
        rows = df.select("time_id", *KEYS, F.lit(kind).cast("tinyint").alias("kind"), F.expr(f"{port} div {WORD}").cast("int").alias("word"), bit.alias("bit"))
        return rows.groupBy("time_id", *KEYS, "kind", "word").agg(F.bit_or("bit").alias("mask"))

    return words(conn, "source_port_id", SOURCE).unionByName(words(grain, "port_id", DEST))


def distinct_ports(words: DataFrame, by: list[str]) -> DataFrame:
    """(by, distinct_source_ports, distinct_dest_ports) of the union of the sets in each group of ``by``
    (columns of ``words``, calendar columns included)."""
    merged = _calendar(words).groupBy(*by, "kind", "word").agg(F.bit_or("mask").alias("mask"))
    n = lambda kind: F.sum(F.when(F.col("kind") == kind, F.bit_count("mask")).otherwise(0)).cast("bigint")
    return merged.groupBy(*by).agg(n(SOURCE).alias("distinct_source_ports"), n(DEST).alias("distinct_dest_ports"))


def period_ports(words: DataFrame, dim_time: DataFrame, period: str) -> DataFrame:
    """Distinct ports per (day or month, service, protocol, attack); ``time_id`` as in the declared rollups."""
    return distinct_ports(words, [period, *KEYS]).join(_first_hour_of(dim_time, period), period, "inner").drop(period)


def hourly_base(grain: DataFrame, words: DataFrame) -> DataFrame:
    """Exact additive sums per (hour, service, protocol, attack), finished from the port grain, with the
    number of distinct ports (source and destination) from the port sets: no fact is read.

    A group has one attack member, so it is either normal or attack traffic and needs no split
    sums. Both sides are grouped on the same keys, so they meet without another shuffle."""
    sums = ["n", "dur__s", "dur__n", "byt__s", "byt__n", "load__s", "load__n", "bytes", "packets"]
    keys = ["time_id", *KEYS]
    rows = grain.groupBy(*keys).agg(F.min("is_attack").alias("is_attack"), F.min("category").alias("category"), *[F.sum(x).alias(x) for x in sums])
    ports = words.groupBy(*keys).agg(F.sum(F.bit_count("mask")).cast("bigint").alias("distinct_ports"))
    return rows.join(ports, keys)


def _split(name: str, col: Column) -> list[Column]:
    """``<name>_normal`` and ``<name>_attack`` of a group's value, 0 for the other class."""
    return [F.when(F.col("is_attack") == F.lit(x), col).otherwise(F.lit(0)).alias(f"{name}_{y}") for x, y in ((False, "normal"), (True, "attack"))]


def _class_avg(source: str, name: str, attack: bool) -> Column:
    """A class's exact average of ``source``; 0 when the group is of the other class or empty."""
    return F.coalesce(F.when(F.col("is_attack") == F.lit(attack), avg_value(source, DEC3)), F.lit(0.0)).alias(name)


def hourly_traffic(base: DataFrame) -> DataFrame:
    """One row per (time, service, protocol, attack); peak = busiest (service, hour-of-day).

    The peak is a small aggregate joined back (24 rows per service), not a window."""
    rows = _calendar(base)
    peak = rows.groupBy("service_id", "hour").agg(F.max("n").alias("peak_hour_connections"))
    normal, attack = (F.when(F.col("is_attack") == F.lit(x), F.col("n")).otherwise(0) for x in (False, True))
    return rows.join(peak, ["service_id", "hour"]).select(
        "time_id",
        *KEYS,
        F.col("n").alias("total_connections"),
        normal.alias("normal_connections"),
        attack.alias("attack_connections"),
        F.coalesce(avg_value("dur", DEC3), F.lit(0.0)).alias("avg_duration"),
        _class_avg("dur", "avg_duration_normal", False),
        _class_avg("dur", "avg_duration_attack", True),
        *_split("total_bytes", _z(F.col("bytes"))),
        *_split("total_packets", _z(F.col("packets"))),
        _class_avg("byt", "avg_bytes_per_conn", False),
        _class_avg("byt", "avg_bytes_per_attack", True),
        _class_avg("load", "avg_load_normal", False),
        _class_avg("load", "avg_load_attack", True),
        # COUNT(DISTINCT service_id) in a group keyed by the (never NULL) service_id is 1.
        F.lit(1).cast("bigint").alias("distinct_services"),
        "distinct_ports",
        "peak_hour_connections",
    )


def _period_sums(base: DataFrame, by: list[str]) -> DataFrame:
    """Base sums rolled up to coarser groups that keep KEYS (so each has one class)."""
    c = F.col
    return _calendar(base).groupBy(*by).agg(
        F.sum("n").alias("total_connections"),
        F.sum(F.when(~c("is_attack"), c("n")).otherwise(0)).alias("normal_connections"),
        F.sum(F.when(c("is_attack"), c("n")).otherwise(0)).alias("attack_connections"),
        F.sum("dur__s").alias("avg_duration__s"),
        F.sum("dur__n").alias("avg_duration__n"),
        F.sum("bytes").alias("total_bytes"),
        F.sum("packets").alias("total_packets"),
        # The attack member is part of the group, so there is one type in it, or none.
        F.max(F.when(c("is_attack"), 1).otherwise(0)).cast("bigint").alias("distinct_attack_types"),
    )


def _period_literal(base: DataFrame, dim_time: DataFrame, period: str, sub: str, peak_name: str) -> DataFrame:
    """R2/R3 as written: grouped by (period, keys, sub-unit); peak over (service, sub-unit)
    across the whole range; ``time_id`` = first hour of the period present in the hour
    dimension. Rolled up from the hourly base: the fact is not read."""
    agg = _period_sums(base, [period, *KEYS, sub])
    agg = avg_finish(agg, "avg_duration", DEC3).withColumn("attack_percentage", pct(F.col("attack_connections"), F.col("total_connections")))
    peak = agg.groupBy("service_id", sub).agg(F.max("total_connections").alias(f"{peak_name}_connections"))
    agg = agg.join(peak, ["service_id", sub]).withColumnRenamed(sub, peak_name)
    return agg.join(_first_hour_of(dim_time, period), period, "inner").drop(period)


def _first_hour_of(dim_time: DataFrame, period: str) -> DataFrame:
    """period start -> MIN(time_id) among the hour dimension's rows of that period (one row
    per day or month of the calendar)."""
    t = F.col("time_id")
    start = (t - F.pmod(t, F.lit(86400))) if period == "day_start" else F.unix_seconds(F.date_trunc("month", cal.to_ts(t)))
    return dim_time.groupBy(start.alias(period)).agg(F.min("time_id").alias("time_id"))


def daily_traffic_literal(base: DataFrame, dim_time: DataFrame) -> DataFrame:
    """R2: daily rollup as the procedure computes it (one row per active hour of the day)."""
    return _period_literal(base, dim_time, "day_start", "hour", "peak_hour")


def monthly_traffic_literal(base: DataFrame, dim_time: DataFrame) -> DataFrame:
    """Monthly rollup as the procedure computes it (one row per active day of month)."""
    return _period_literal(base, dim_time, "month_start", "day", "peak_day")


def _period_declared(base: DataFrame, dim_time: DataFrame, period: str, sub: str, peak_name: str) -> DataFrame:
    """R2i/R3i: one row per (period, keys); peak = sub-unit with most connections
    (ties -> lowest), found by a two-level aggregation of the hourly base."""
    lvl1 = _period_sums(base, [period, *KEYS, sub])
    n = F.col("total_connections")
    sums = ["normal_connections", "attack_connections", "avg_duration__s", "avg_duration__n", "total_bytes", "total_packets"]
    lvl2 = lvl1.groupBy(period, *KEYS).agg(
        F.max_by(F.col(sub), F.struct(n, -F.col(sub))).alias(peak_name),
        F.max(n).alias(f"{peak_name}_connections"),
        F.sum(n).alias("total_connections"),
        *[F.sum(x).alias(x) for x in sums],
        F.max("distinct_attack_types").alias("distinct_attack_types"),
    )
    lvl2 = avg_finish(lvl2, "avg_duration", DEC3)
    lvl2 = lvl2.withColumn("attack_percentage", pct(F.col("attack_connections"), F.col("total_connections")))
    return lvl2.join(_first_hour_of(dim_time, period), period, "inner").drop(period)


def daily_traffic(base: DataFrame, dim_time: DataFrame) -> DataFrame:
    return _period_declared(base, dim_time, "day_start", "hour", "peak_hour")


def monthly_traffic(base: DataFrame, dim_time: DataFrame) -> DataFrame:
    return _period_declared(base, dim_time, "month_start", "day", "peak_day")


# ---- special facts (declared in the schema, formulas ours: SURVEY 7.3) ---------------

def _dec3(col: Column) -> Column:
    return F.round(col, DEC3).cast("double")


def port_grain(conn: DataFrame) -> DataFrame:
    """Exact sums per (hour, service, protocol, attack, destination port), from one scan of the
    fact: the hourly base, F6, F7 and QD4 are aggregates of it."""
    c = F.col
    bytes_ = c("source_bytes") + c("dest_bytes")
    packets = c("source_packets").cast("bigint") + c("dest_packets").cast("bigint")
    return conn.groupBy("time_id", *KEYS, c("dest_port_id").alias("port_id"), "is_attack", "category").agg(
        F.count(F.lit(1)).alias("n"),
        *_avg3(c("duration"), "dur"),
        *_avg3(bytes_, "byt"),
        *_avg3(packets, "pck"),
        *_avg3(c("source_load"), "load"),
        F.sum(bytes_).alias("bytes"),
        F.sum(packets).alias("packets"),
    )


def _sums_of(attack: bool, source: str, name: str) -> list[Column]:
    """Partials of an average over one class, from the grain's partials."""
    return [F.sum(_when_attack(F.col(f"{source}__{p}"), attack)).alias(f"{name}__{p}") if p == "s" else F.coalesce(F.sum(_when_attack(F.col(f"{source}__n"), attack)), F.lit(0)).alias(f"{name}__n") for p in ("s", "n")]


def service_stats(grain: DataFrame) -> DataFrame:
    """F6, grain (service, time, protocol, attack), from ``port_grain``.

    Per grain: connection counts, attack %, bytes/packets by class, average bytes per
    connection and per attack connection. Per service (repeated on its rows, because
    ``attack_id`` in the grain makes per-row splits degenerate): average durations and
    their ratio, bytes and packets ratios (attack mean / normal mean), distinct attack
    types, peak hour of day for normal and attack traffic (ties -> lowest hour), and the
    number of destination ports of the service used only by attacks.
    """
    c = F.col
    rows = grain.groupBy("service_id", "time_id", "protocol_id", "attack_id").agg(
        F.sum("n").alias("total_connections"),
        F.sum(F.when(~c("is_attack"), c("n")).otherwise(0)).alias("normal_connections"),
        F.sum(F.when(c("is_attack"), c("n")).otherwise(0)).alias("attack_connections"),
        _z(F.sum(_when_attack(c("bytes"), False))).alias("total_bytes_normal"),
        _z(F.sum(_when_attack(c("bytes"), True))).alias("total_bytes_attack"),
        _z(F.sum(_when_attack(c("packets"), False))).alias("total_packets_normal"),
        _z(F.sum(_when_attack(c("packets"), True))).alias("total_packets_attack"),
        F.sum("byt__s").alias("avg_bytes_per_conn__s"),
        F.sum("byt__n").alias("avg_bytes_per_conn__n"),
        *_sums_of(True, "byt", "avg_bytes_per_attack"),
    ).withColumn("attack_percentage", pct(F.col("attack_connections"), F.col("total_connections")))
    rows = avg_finish(rows, ["avg_bytes_per_conn", "avg_bytes_per_attack"], DEC3)

    # Everything per service comes from three small aggregates of the grain.
    per_service = grain.groupBy("service_id").agg(
        *_sums_of(False, "dur", "avg_duration_normal"),
        *_sums_of(True, "dur", "avg_duration_attack"),
        *_sums_of(False, "byt", "mb_normal"),
        *_sums_of(True, "byt", "mb_attack"),
        *_sums_of(False, "pck", "mp_normal"),
        *_sums_of(True, "pck", "mp_attack"),
    )
    per_service = (
        per_service.withColumn("duration_ratio", _dec3(F.try_divide(mean_raw("avg_duration_attack"), F.nullif(mean_raw("avg_duration_normal"), F.lit(0.0)))))
        .withColumn("bytes_ratio", _dec3(F.try_divide(mean_raw("mb_attack"), F.nullif(mean_raw("mb_normal"), F.lit(0.0)))))
        .withColumn("packets_ratio", _dec3(F.try_divide(mean_raw("mp_attack"), F.nullif(mean_raw("mp_normal"), F.lit(0.0)))))
    )
    per_service = avg_finish(per_service, ["avg_duration_normal", "avg_duration_attack"], DEC3).drop(
        *[f"{m}__{p}" for m in ("mb_normal", "mb_attack", "mp_normal", "mp_attack") for p in ("s", "n")]
    )
    by_hour = grain.groupBy("service_id", "is_attack", "category", F.hour(cal.to_ts(c("time_id"))).alias("hour")).agg(F.sum("n").alias("n"))
    types = by_hour.filter("is_attack").groupBy("service_id").agg(F.countDistinct("category").alias("distinct_attack_types"))
    hours = by_hour.groupBy("service_id", "is_attack", "hour").agg(F.sum("n").alias("n"))
    peaks = hours.groupBy("service_id").agg(
        F.max_by(F.when(~F.col("is_attack"), F.col("hour")), F.when(~F.col("is_attack"), F.struct("n", -F.col("hour")))).alias("peak_hour_normal"),
        F.max_by(F.when(F.col("is_attack"), F.col("hour")), F.when(F.col("is_attack"), F.struct("n", -F.col("hour")))).alias("peak_hour_attack"),
    )
    exclusive = (
        grain.groupBy("service_id", "port_id")
        .agg(F.bool_and("is_attack").alias("only_attacks"))
        .groupBy("service_id")
        .agg(F.count(F.when(F.col("only_attacks"), 1)).alias("exclusive_attack_ports"))
    )
    # One row per service; Spark broadcasts it if its bytes allow.
    service_side = per_service.join(types, "service_id", "left").join(peaks, "service_id", "left").join(exclusive, "service_id", "left")
    service_side = service_side.withColumn("distinct_attack_types", _z(c("distinct_attack_types")))
    return rows.join(service_side, "service_id", "left")


def port_usage(grain: DataFrame) -> DataFrame:
    """F7, grain (destination port, service, protocol, attack, time), from ``port_grain``.

    Per grain: usage counts and ``usage_percentage`` = share of that hour's connections.
    Per port (repeated): attack %, exclusive to attacks, most frequent attack category
    (ties alphabetical, NULL when none), first/last hour seen, distinct services.
    """
    c = F.col
    attacks = F.when(c("is_attack"), c("n")).otherwise(0)
    rows = grain.select(
        "port_id", "service_id", "protocol_id", "attack_id", "time_id",
        c("n").alias("total_usage"), (c("n") - attacks).alias("normal_usage"), attacks.alias("attack_usage"),
    )
    per_hour = grain.groupBy("time_id").agg(F.sum("n").alias("hour_total"))
    per_port = grain.groupBy("port_id").agg(
        pct(F.sum(attacks), F.sum("n")).alias("attack_percentage"),
        F.bool_and("is_attack").alias("exclusive_to_attacks"),
        cal.to_ts(F.min("time_id")).alias("first_seen"),
        cal.to_ts(F.max("time_id")).alias("last_seen"),
        F.countDistinct("service_id").alias("distinct_services"),
    )
    by_cat = grain.filter(c("is_attack")).groupBy("port_id", "category").agg(F.sum("n").alias("n"))
    primary = by_cat.groupBy("port_id").agg(
        F.min_by(F.col("category"), F.struct(-F.col("n"), F.col("category"))).alias("primary_attack_type")
    )
    # per_hour: one row per hour; per_port / primary: one row per port (<= 65,536).
    return (
        rows.join(per_hour, "time_id", "inner")
        .withColumn("usage_percentage", pct(F.col("total_usage"), F.col("hour_total")))
        .drop("hour_total")
        .join(per_port.join(primary, "port_id", "left"), "port_id", "inner")
    )
