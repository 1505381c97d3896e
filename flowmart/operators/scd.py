"""Type-2 slowly changing dimension (D10) for the service and port dimensions.

The schema declares ``valid_from / valid_to / version / is_active`` but never versions a
row; this is the behaviour those columns describe:

* ``scd2_merge`` - compare the active rows with a new snapshot on a hash of the tracked
  attributes (``full_outer`` join on the natural key; both sides are dimensions, so the
  join is small): changed keys close their row (``valid_to = as_of``, inactive) and get
  version + 1 from ``as_of``; new keys start at version 1; keys absent from the snapshot
  stay as they are.
* ``as_of`` - the version valid at a point in time: ``valid_from <= t < valid_to``.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.operators.keys import dense_keys


def _hash(cols: list[str]) -> F.Column:
    return F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\u0000")) for c in cols])


def scd2_merge(current: DataFrame, snapshot: DataFrame, key: str, tracked: list[str], as_of: _dt.datetime,
               id_col: str | None = None) -> DataFrame:
    """New state of a type-2 dimension after applying ``snapshot`` at ``as_of``."""
    ts = F.lit(as_of).cast("timestamp")
    active = current.filter("is_active")
    history = current.filter(~F.col("is_active"))
    snap = snapshot.select(key, *tracked).withColumn("_h_new", _hash(tracked))
    cur = active.withColumn("_h_old", _hash(tracked))
    j = cur.alias("c").join(snap.alias("s"), F.col(f"c.{key}") == F.col(f"s.{key}"), "full_outer")

    changed = F.col("c._h_old").isNotNull() & F.col("s._h_new").isNotNull() & (F.col("c._h_old") != F.col("s._h_new"))
    is_new = F.col("c._h_old").isNull()

    base_cols = [c for c in current.columns]
    # unchanged or absent from the snapshot: keep the active row
    kept = j.filter(F.col("c._h_old").isNotNull() & ~changed).select(*[F.col(f"c.{c}").alias(c) for c in base_cols])
    # changed: close the old version ...
    closed = j.filter(changed).select(*[
        (ts.alias(c) if c == "valid_to" else F.lit(False).alias(c) if c == "is_active" else F.col(f"c.{c}").alias(c))
        for c in base_cols
    ])
    # ... and open the next one with the snapshot's attributes
    opened = j.filter(changed).select(*[
        (F.col(f"s.{c}").alias(c) if c in tracked else
         ts.alias(c) if c == "valid_from" else
         F.lit(None).cast("timestamp").alias(c) if c == "valid_to" else
         (F.col("c.version") + 1).alias(c) if c == "version" else
         F.lit(True).alias(c) if c == "is_active" else
         F.col(f"c.{c}").alias(c))
        for c in base_cols
    ])
    # new natural keys start at version 1
    created = j.filter(is_new).select(*[
        (F.col(f"s.{c}").alias(c) if c in tracked or c == key else
         ts.alias(c) if c == "valid_from" else
         F.lit(None).cast("timestamp").alias(c) if c == "valid_to" else
         F.lit(1).alias(c) if c == "version" else
         F.lit(True).alias(c) if c == "is_active" else
         F.lit(None).cast(current.schema[c].dataType).alias(c))
        for c in base_cols
    ])
    if id_col is not None:
        last = F.coalesce(current.agg(F.max(id_col)).scalar(), F.lit(0))
        created = dense_keys(created.drop(id_col).withColumn("_all", F.lit(0)), "_all", [key], {id_col: F.lit(True)}).drop("_all")
        created = created.withColumn(id_col, (last + F.col(id_col)).cast(current.schema[id_col].dataType))
    return history.unionByName(kept).unionByName(closed).unionByName(opened).unionByName(created)


def as_of(dim: DataFrame, t: _dt.datetime) -> DataFrame:
    """Rows valid at ``t``: ``valid_from <= t < coalesce(valid_to, +inf)``."""
    ts = F.lit(t).cast("timestamp")
    return dim.filter((F.col("valid_from") <= ts) & (F.col("valid_to").isNull() | (ts < F.col("valid_to"))))
