"""Facts resolved against dimension versions at their own time (D10 + F3).

A version is valid for ``valid_from <= t < valid_to`` (no end: for good). Joining facts and
versions on the member and that range alone would let one hot member's facts meet all its
versions in one task. Instead time is cut into buckets: a version is listed once in every
bucket that it touches, and facts meet it on (member, bucket) with the range as a residual
condition. A fact meets the versions of one bucket only, a hot member's facts are spread over
the buckets, and a listing that is small enough is broadcast, so the facts stay where they are.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.plans.joins import sized

DAY = 86400


def overlaps(dim: DataFrame, key: str) -> DataFrame:
    """Versions that begin before the end of an earlier version of their member: with such rows a
    fact would be doubled."""
    w = Window.partitionBy(key).orderBy("valid_from", "version")
    end = F.max(F.coalesce("valid_to", F.lit(_dt.datetime(9999, 12, 31)))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return dim.withColumn("_end", end).filter(F.col("valid_from") < F.col("_end")).drop("_end")


def listed_by_bucket(dim: DataFrame, key: str, attributes: list[str], first: Column, last: Column, width: int = DAY) -> DataFrame:
    """(key, bucket, from, to, attributes): every version once per bucket of ``width`` seconds that it
    touches between the epochs ``first`` and ``last``."""
    start = F.unix_seconds("valid_from")
    end = F.coalesce(F.unix_seconds("valid_to"), F.lit(2**62))  # exclusive
    bucket = lambda t: F.floor(t / width)
    low, high = F.greatest(start, first), F.least(end - 1, last)
    rows = dim.select(key, start.alias("_from"), end.alias("_to"), *attributes, low.alias("_low"), high.alias("_high")).filter("_low <= _high")
    return rows.select(key, F.explode(F.sequence(bucket(F.col("_low")), bucket(F.col("_high")))).alias("_bucket"), "_from", "_to", *attributes)


def resolve_as_of(facts: DataFrame, at: str, fact_key: str, versions: DataFrame, key: str, attributes: dict[str, str], width: int = DAY) -> DataFrame:
    """``facts`` with the attributes (attribute -> result column) of the version of ``fact_key`` that was
    valid at the epoch ``at``; null where there was none. The listing is counted: it is broadcast
    under the usual bound and shuffled on (member, bucket) beyond it."""
    # The buckets between the first and the last fact: one small aggregate.
    lo, hi = facts.agg(F.min(at), F.max(at)).first()
    listing = listed_by_bucket(versions, key, list(attributes), F.lit(lo or 0), F.lit(hi or 0), width)
    v = listing.select(F.col(key).alias("_key"), "_bucket", "_from", "_to", *[F.col(a).alias(name) for a, name in attributes.items()])
    f = facts.withColumn("_at", F.floor(F.col(at) / width))
    on = (f[fact_key] == v["_key"]) & (f["_at"] == v["_bucket"]) & (v["_from"] <= f[at]) & (f[at] < v["_to"])
    return f.join(sized(v, listing.count()), on, "left").drop("_at", "_key", "_bucket", "_from", "_to")
