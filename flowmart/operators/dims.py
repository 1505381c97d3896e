"""Dimension builders for both schema generations.

All small dimensions are derived from one table of *dimension members*: a single scan of
staging emits, per row, the natural keys it contributes to each dimension; one
aggregation (partial, map-side) reduces them to distinct members. So the staging table is
read once for all dimensions instead of once per dimension, and the shuffle carries only
distinct keys per task.

Surrogate keys are dense numbers in the order of the natural key, given by ranges of the members
(``operators/keys.py``). Sets that grow
with the data (the simple generation's one-row-per-second calendar, its address x port
locations) are computed on demand, keep their natural key and are never numbered.
"""

from __future__ import annotations

import datetime as _dt

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.functions import calendar as cal
from flowmart.functions import classify as cls
from flowmart.operators.keys import dense_keys

#: A member is one of these; the kind first.
MEMBER_KEY = ["dim", "name", "name2", "num"]
MEMBER_SCHEMA = "dim string, name string, name2 string, num bigint, attr string"

# Member kinds (the ``dim`` column of the members table).
M_SERVICE = "service"  # name = service, attr = protocol seen with it
M_PROTO = "proto"  # name = proto
M_STATE = "state"  # name = state
M_PORT = "port"  # num = source or destination port, attr = service seen with it
M_ATTACK_CAT = "attack_cat"  # name = attack_cat (non-null, may be empty)
M_HOUR = "hour"  # num = epoch of the hour start
M_PROTO_STATE = "proto_state"  # name = proto, name2 = state (simple generation)
M_ATTACK_FLAG = "attack_flag"  # name = attack_cat, num = 1/0 for label = 1 (simple generation)


def _member(kind: str, name: Column | None = None, name2: Column | None = None,
            num: Column | None = None, attr: Column | None = None, when: Column | None = None) -> Column:
    s = F.struct(
        F.lit(kind).alias("dim"),
        (name if name is not None else F.lit(None)).cast("string").alias("name"),
        (name2 if name2 is not None else F.lit(None)).cast("string").alias("name2"),
        (num if num is not None else F.lit(None)).cast("bigint").alias("num"),
        (attr if attr is not None else F.lit(None)).cast("string").alias("attr"),
    )
    return s if when is None else F.when(when, s)


def _facet(facet: str, num: Column, names: list[str]) -> Column:
    """A part of a staging row that some kinds of members follow from; its other names are null."""
    return F.struct(F.lit(facet).alias("facet"), num.cast("bigint").alias("num"),
                    *[(F.col(n) if n in names else F.lit(None).cast("string")).alias(n) for n in _FACET_NAMES])


_FACET_NAMES = ("service", "proto", "state", "attack_cat")


def dimension_members(stg: DataFrame) -> DataFrame:
    """One scan of clean staging -> distinct members of every small dimension.

    A row is cut into facets (its names and label, its two ports with their service, its hour), which
    are made distinct by hash in the scan's own stage; members are listed from distinct facets.
    ``attr`` keeps the smallest companion value (first-seen attribute made deterministic): a
    minimum of strings sorts its input, so it runs over distinct rows only.
    """
    c = F.col
    label_flag = F.when(c("label") == 1, F.lit(1)).when(c("label").isNotNull(), F.lit(0))
    facets = F.array(
        _facet("names", label_flag, list(_FACET_NAMES)),
        _facet(M_PORT, c("sport"), ["service"]),
        _facet(M_PORT, c("dsport"), ["service"]),
        _facet(M_HOUR, cal.hour_start(c("stime")), []),
    )
    seen = stg.select(F.explode(facets).alias("f")).select("f.*").distinct()
    names, num = c("facet") == "names", c("num")
    members = F.array(
        _member(M_SERVICE, name=c("service"), attr=c("proto"), when=names & c("service").isNotNull()),
        _member(M_PROTO, name=c("proto"), when=names & c("proto").isNotNull()),
        _member(M_STATE, name=c("state"), when=names & c("state").isNotNull()),
        _member(M_PORT, num=num, attr=c("service"), when=(c("facet") == M_PORT) & num.isNotNull()),
        _member(M_ATTACK_CAT, name=c("attack_cat"), when=names & c("attack_cat").isNotNull()),
        _member(M_HOUR, num=num, when=(c("facet") == M_HOUR) & num.isNotNull()),
        _member(M_PROTO_STATE, name=c("proto"), name2=c("state"), when=names & c("proto").isNotNull()),
        _member(M_ATTACK_FLAG, name=c("attack_cat"), num=num, when=names),
    )
    return (
        seen.select(F.explode(members).alias("m"))
        .filter(F.col("m").isNotNull())
        .select("m.*")
        .groupBy(*MEMBER_KEY)
        .agg(F.min("attr").alias("attr"))
    )


def _eligible() -> Column:
    """Members that get their own id in the mart generation (the others fold into the
    default member 0: a literal UNKNOWN / NORMAL / empty category, port 0)."""
    c = F.col
    dim, name = c("dim"), c("name")
    return (
        F.when(dim.isin(M_SERVICE, M_PROTO, M_STATE), name != cls.UNKNOWN)
        .when(dim == M_PORT, c("num") != 0)
        .when(dim == M_ATTACK_CAT, ~name.isin("", cls.NORMAL))
        .otherwise(F.lit(True))
    )


def number_members(distinct: DataFrame, after: DataFrame | None = None, stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Dense keys for every member kind (``keys.dense_keys``): ``key_all`` numbers all members (simple
    generation), ``key_g2`` only the eligible ones (mart generation), in the order of the natural
    key; after the last keys in ``after`` (dim, key_all, key_g2), if given. Dimensions are plain
    projections of the written table."""
    return dense_keys(distinct, "dim", MEMBER_KEY[1:], {"key_all": F.lit(True), "key_g2": _eligible()}, after, stage)


def _of(members: DataFrame, kind: str) -> DataFrame:
    return members.filter(F.col("dim") == kind)


def _g2_members(members: DataFrame, kind: str, key: str) -> DataFrame:
    """Eligible members of one kind with their mart-generation id."""
    return _of(members, kind).filter(F.col("key_g2").isNotNull()).withColumn(key, F.col("key_g2"))


def _g1_members(members: DataFrame, kind: str, key: str) -> DataFrame:
    return _of(members, kind).withColumn(key, F.col("key_all"))


def _scd_columns(valid_from: _dt.datetime) -> list[Column]:
    return [
        F.lit(True).alias("is_active"),
        F.lit(valid_from).cast("timestamp").alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
        F.lit(1).alias("version"),
    ]


# --------------------------------------------------------------------------------------
# Mart generation
# --------------------------------------------------------------------------------------

def g2_dim_time(members: DataFrame) -> DataFrame:
    """One row per observed hour; ``time_id`` = epoch seconds of the hour start."""
    return _of(members, M_HOUR).select(*cal.hour_attributes(F.col("num")))


def calendar_hours(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Hourly calendar from ``start`` to ``end`` inclusive (e.g. 2024 -> 8,784 rows)."""
    seq = F.sequence(
        F.to_timestamp(F.lit(start)), F.to_timestamp(F.lit(end)), F.expr("interval 1 hour")
    )
    return (
        spark.range(1)
        .select(F.explode(seq).alias("datetime"))
        .select(*cal.hour_attributes(F.unix_seconds(F.col("datetime"))))
    )


def g2_dim_service(members: DataFrame, valid_from: _dt.datetime) -> DataFrame:
    """D3: services with first-seen protocol (smallest), category and risk; id 0 = UNKNOWN."""
    name = F.col("name")
    real = _g2_members(members, M_SERVICE, "service_id").select(
        "service_id",
        name.alias("name"),
        F.col("attr").alias("protocol"),
        F.lit(cls.SERVICE_TYPE).alias("service_type"),
        cls.service_category(name).alias("category"),
        cls.service_risk(name).alias("risk_level"),
        F.lit("service seen in the connection records").alias("description"),
        *_scd_columns(valid_from),
    )
    default = real.sparkSession.range(1).select(
        F.lit(0).alias("service_id"),
        F.lit(cls.UNKNOWN).alias("name"),
        F.lit(cls.UNKNOWN).alias("protocol"),
        F.lit(cls.UNKNOWN).alias("service_type"),
        F.lit(cls.UNKNOWN).alias("category"),
        F.lit(cls.SERVICE_RISK_DEFAULT).alias("risk_level"),
        F.lit("default member for a missing service").alias("description"),
        *_scd_columns(valid_from),
    )
    return default.unionByName(real)


def _g2_named_dim(members: DataFrame, kind: str, id_col: str, class_col: str, classify, note: str) -> DataFrame:
    name = F.col("name")
    real = _g2_members(members, kind, id_col).select(
        id_col,
        name.alias("name"),
        classify(name).alias(class_col),
        F.lit(note).alias("description"),
        F.lit(True).alias("is_active"),
    )
    default = real.sparkSession.range(1).select(
        F.lit(0).alias(id_col),
        F.lit(cls.UNKNOWN).alias("name"),
        F.lit(cls.UNKNOWN).alias(class_col),
        F.lit("default member for a missing value").alias("description"),
        F.lit(True).alias("is_active"),
    )
    return default.unionByName(real)


def g2_dim_protocol(members: DataFrame) -> DataFrame:
    """Protocols typed TRANSPORT / INTERNET / OTHER; id 0 = UNKNOWN."""
    return _g2_named_dim(members, M_PROTO, "protocol_id", "type", cls.protocol_type, "protocol seen in the connection records")


def g2_dim_state(members: DataFrame) -> DataFrame:
    """States grouped CONNECTION / ACCESS / OTHER; id 0 = UNKNOWN."""
    return _g2_named_dim(members, M_STATE, "state_id", "category", cls.state_category, "connection state seen in the records")


def g2_dim_port(members: DataFrame, valid_from: _dt.datetime) -> DataFrame:
    """Source and destination ports with range type and default service.

    Port 0 is the default member (id 0, range UNKNOWN), so a real port 0 maps to it.
    ``default_service`` is the smallest service seen on the port, UNKNOWN when none.
    """
    port = F.col("num").cast("int")
    real = _g2_members(members, M_PORT, "port_id").select(
        "port_id",
        port.alias("port_number"),
        cls.port_range(port).alias("range_type"),
        F.coalesce(F.col("attr"), F.lit(cls.UNKNOWN)).alias("default_service"),
        *_scd_columns(valid_from),
    )
    default = real.sparkSession.range(1).select(
        F.lit(0).alias("port_id"),
        F.lit(0).alias("port_number"),
        F.lit(cls.UNKNOWN).alias("range_type"),
        F.lit(cls.UNKNOWN).alias("default_service"),
        *_scd_columns(valid_from),
    )
    return default.unionByName(real)


def g2_dim_attack(members: DataFrame) -> DataFrame:
    """Attack categories with severity; id 0 = NORMAL (not an attack)."""
    name = F.col("name")
    real = _g2_members(members, M_ATTACK_CAT, "attack_id").select(
        "attack_id",
        name.alias("category"),
        F.lit(True).alias("is_attack"),
        cls.attack_severity(name).alias("severity"),
        F.lit("attack category seen in the records").alias("description"),
        F.lit(True).alias("is_active"),
    )
    default = real.sparkSession.range(1).select(
        F.lit(0).alias("attack_id"),
        F.lit(cls.NORMAL).alias("category"),
        F.lit(False).alias("is_attack"),
        F.lit(cls.ATTACK_SEVERITY_DEFAULT).alias("severity"),
        F.lit("normal traffic").alias("description"),
        F.lit(True).alias("is_active"),
    )
    return default.unionByName(real)


# --------------------------------------------------------------------------------------
# Simple generation (G1)
# --------------------------------------------------------------------------------------

def g1_dim_time(stg: DataFrame) -> DataFrame:
    """One row per distinct second; ``time_key`` = epoch seconds.

    This set grows with the data (up to 31.6 M rows a year), so it is not part of the
    small-dimension members: facts carry the epoch and derive the attributes."""
    return stg.filter(F.col("stime").isNotNull()).select("stime").distinct().select(*cal.second_attributes(F.col("stime")))


def g1_dim_service(members: DataFrame) -> DataFrame:
    """Distinct non-null services."""
    return _g1_members(members, M_SERVICE, "service_key").select(
        "service_key", F.col("name").alias("service_name")
    )


def g1_dim_protocol(members: DataFrame) -> DataFrame:
    """Distinct (proto, state) with proto non-null (state may be NULL)."""
    return _g1_members(members, M_PROTO_STATE, "protocol_key").select(
        "protocol_key", F.col("name").alias("protocol_name"), F.col("name2").alias("protocol_state")
    )


def g1_dim_attack_category(members: DataFrame) -> DataFrame:
    """E5: distinct non-null attack categories."""
    return _g1_members(members, M_ATTACK_CAT, "category_key").select(
        "category_key", F.col("name").alias("category_name")
    )


def g1_dim_attack(members: DataFrame, categories: DataFrame) -> DataFrame:
    """E6 with DISTINCT: one row per (category, is_attack) pair, is_attack = (label = 1).

    The category name is carried along so facts resolve the key in one lookup.
    """
    pairs = _g1_members(members, M_ATTACK_FLAG, "attack_key").select(
        "attack_key", F.col("name").alias("category_name"), (F.col("num") == 1).alias("is_attack")
    )
    # Ordered by (category nulls first, is_attack nulls first): num 0 < 1 is false < true.
    return pairs.join(categories, "category_name", "left").select(
        "attack_key", "category_key", "category_name", "is_attack"
    )


def g1_dim_attack_v2(spark: SparkSession) -> DataFrame:
    """The two-row attack dimension (true / false), no category."""
    return spark.createDataFrame(
        [(1, None, True), (2, None, False)], "attack_key int, category_key int, is_attack boolean"
    )


def g1_dim_location(stg: DataFrame) -> DataFrame:
    """Set union of source and destination (ip, port) with numeric ports.

    This set grows with the data (addresses x ports), so it keeps its natural key and is
    never numbered with a global window; facts carry (ip, port) directly.
    """
    src = stg.filter(F.col("sport").isNotNull()).select(F.col("srcip").alias("ip_address"), F.col("sport").alias("port"))
    dst = stg.filter(F.col("dsport").isNotNull()).select(F.col("dstip").alias("ip_address"), F.col("dsport").alias("port"))
    return src.union(dst).distinct()
