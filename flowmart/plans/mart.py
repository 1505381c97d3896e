"""The materialised mart: staging -> dimensions -> facts, written once, queried many times.

Build (``Mart.build``), per generation:

0. staging is written, typed: later scans read its columns, in splits of bounded size, instead of
   deriving them for every rule and lookup again;
1. one scan of clean staging -> ``members`` (distinct natural keys of every small
   dimension, map-side combined, numbered by ranges) -> written;
2. one grouped count of ``members`` bounds the size of every dimension (the bound is what
   decides broadcast vs shuffle for later lookups); each dimension is a deterministic,
   cached view over ``members``; every natural key must have one active row, or the build fails;
3. the connection fact: one scan of staging with all lookups as broadcast hash joins in
   one stage -> written partitioned by ``year_month``.

Everything else is derived (``DERIVED``: table -> builder and what it reads). A derived table is
built on first use; when something that it reads has changed for some months, it is stale,
and its next use rebuilds it: those months only if its rows belong to a month, all of it
otherwise. All tables live under the shared checkpoint folder.
"""

from __future__ import annotations

import datetime as _dt
import threading
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.operators import dims as D
from flowmart.operators import commits
from flowmart.operators import facts as FX
from flowmart.operators import validation as V
from flowmart.operators.quality import valid_rows
from flowmart.operators.sinks import Audit, write_table
from flowmart.plans.joins import sized
from flowmart.plans.monthly import MONTH, MonthlyTable
from flowmart.session import ensure_conf, scratch_path
from flowmart.sources.fixture import staging_raw

# Tables derived from ``members`` (name -> builder).
_G2_DIMS: dict[str, Callable] = {
    "dim_time": lambda m, vf: D.g2_dim_time(m),
    "dim_service": lambda m, vf: D.g2_dim_service(m, vf),
    "dim_protocol": lambda m, vf: D.g2_dim_protocol(m),
    "dim_state": lambda m, vf: D.g2_dim_state(m),
    "dim_port": lambda m, vf: D.g2_dim_port(m, vf),
    "dim_attack": lambda m, vf: D.g2_dim_attack(m),
}
_G1_DIMS: dict[str, Callable] = {
    "g1_dim_service": lambda m, vf: D.g1_dim_service(m),
    "g1_dim_protocol": lambda m, vf: D.g1_dim_protocol(m),
    "g1_dim_attack_category": lambda m, vf: D.g1_dim_attack_category(m),
}

#: The natural key that is unique among the active rows of a dimension.
_NATURAL_KEYS = {
    "dim_time": "time_id", "dim_service": "name", "dim_protocol": "name", "dim_state": "name", "dim_port": "port_number", "dim_attack": "category",
}


@dataclass(frozen=True)
class Window:
    """What a refresh covers: the months (None: all) and inside them the hours from t0 to t1 (None: open)."""

    months: list[str] | None = None
    t0: int | None = None
    t1: int | None = None

    def has(self, df: DataFrame) -> DataFrame:
        """The rows of a table by month that lie in the window's months."""
        return df if self.months is None else df.filter(F.col(MONTH).isin(self.months))

    def inside(self) -> F.Column:
        at = F.lit(True)
        if self.t0 is not None:
            at = at & (F.col("time_id") >= self.t0)
        return at if self.t1 is None else at & (F.col("time_id") <= self.t1)


@dataclass(frozen=True)
class Derived:
    """A derived table. ``build(mart, window)`` gives its rows of the window's months; ``sources``: the
    tables that it reads; ``by_month``: stored by ``year_month``; ``local``: a month's rows follow from the
    same month of the sources, so that other months can stay; ``hours``: its rows belong to hours,
    so that a window can be replaced exactly."""

    build: Callable[["Mart", Window], DataFrame]
    sources: tuple[str, ...]
    by_month: bool = False
    local: bool = False
    hours: bool = False


#: Derived tables, sources first; the modules that build them register them here.
DERIVED: dict[str, Derived] = {}


def dependants(changed: str) -> list[str]:
    """The derived tables that read ``changed``, directly or not, sources first."""
    found = {changed}
    for name, spec in DERIVED.items():
        if found & set(spec.sources):
            found.add(name)
    return [n for n in DERIVED if n in found and n != changed]


class Mart:
    """Both schema generations over one clean staging DataFrame."""

    def __init__(self, spark: SparkSession, staging: DataFrame, root: str | None = None):
        ensure_conf(spark)
        self.spark = spark
        self.raw = staging
        self.stg = valid_rows(staging)
        self.root = root or scratch_path(spark, "mart")
        self.audit = Audit(spark, f"{self.root}/etl_control")
        # valid_from of every first dimension version: a fixed instant, so that a rebuild
        # of the same input gives identical dimensions (idempotent load).
        self.load_time = _dt.datetime(2024, 1, 1)
        self._tables: dict[str, DataFrame] = {}
        self._monthly: dict[str, MonthlyTable] = {}
        self._plain: dict[str, list[str]] = {}
        self._stale: dict[str, set[str] | None] = {}  # None: all of it
        self._temporary: list[str] = []
        self._companions: dict[str, Mart] = {}
        self.sizes: dict[str, int] = {}
        self._lock = threading.RLock()
        self._building: dict[str, threading.RLock] = {}
        self.built = False
        self.sf_dir: str | None = None

    # ---- storage -------------------------------------------------------------------
    def _write(self, name: str, df: DataFrame, partition_by: list[str] | None = None, count: bool = False) -> DataFrame:
        out = write_table(df, f"{self.root}/{name}", partition_by)
        self._tables[name] = out
        if count:
            self.sizes[name] = out.count()
        return out

    def fresh(self, name: str) -> str:
        """A folder that nothing else uses."""
        return f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"

    def scratch(self, name: str) -> str:
        """A fresh folder for a query's own files; it stays until ``close``."""
        self._temporary.append(self.fresh(name))
        return self._temporary[-1]

    def close(self) -> None:
        """Remove the files that queries wrote for themselves and replaced versions of tables."""
        for path in [*self._temporary, *(p for old in self._plain.values() for p in old[:-1]), *(f for t in self._monthly.values() for f in t.replaced)]:
            commits.remove(self.spark, path)
        self._temporary = []
        self._plain = {n: old[-1:] for n, old in self._plain.items()}
        for t in self._monthly.values():
            t.replaced = []

    # ---- derived tables --------------------------------------------------------------
    def derived(self, name: str) -> DataFrame:
        """A derived table as it should be now: built on first use, rebuilt where it is stale."""
        with self._lock:
            own = self._building.setdefault(name, threading.RLock())
        with own:  # only builds of the same table wait for each other
            if name not in self._tables:
                self.rebuild(name)
            elif name in self._stale:
                months = self._stale[name]
                self.rebuild(name, Window(None if months is None else sorted(months)))
            return self._tables[name]

    def mark_stale(self, changed: str, months: list[str] | None) -> None:
        """What follows from ``changed`` is no longer right in ``months`` (None: all)."""
        for name in dependants(changed):
            if name not in self._tables:
                continue
            if months is None or not DERIVED[name].local:
                self._stale[name] = None
            elif self._stale.get(name, set()) is not None:
                self._stale[name] = {*self._stale.get(name, ()), *months}

    def fresh_again(self, name: str) -> None:
        """What was marked stale has been rebuilt by other means."""
        self._stale.pop(name, None)

    def rebuild(self, name: str, window: Window = Window()) -> DataFrame:
        """Build a derived table anew: the window's months if its rows belong to a month and it is there
        already, else all of it. A stale source is rebuilt first. Rows of the months outside the
        window's hours stay as they are stored."""
        spec = DERIVED[name]
        for source in spec.sources:
            if source in DERIVED:
                self.derived(source)
        partial = spec.local and name in self._monthly and window.months is not None
        new = spec.build(self, window if partial else Window())
        if partial and spec.hours and (window.t0 is not None or window.t1 is not None):
            kept = self._monthly[name].read(window.months).filter(~window.inside())
            new = kept.unionByName(new.filter(window.inside()).select(*kept.columns))
        self._stale.pop(name, None)
        return self._store(name, new, window.months if partial else None, spec.by_month)

    def rebuild_all(self, names: list[str], window: Window = Window()) -> dict[str, int]:
        """``rebuild`` of tables that don't read each other, as concurrent Spark jobs; the rows of each."""
        with ThreadPoolExecutor(max_workers=4) as pool:
            return dict(zip(names, pool.map(lambda n: self.rebuild(n, window).count(), names)))

    def _store(self, name: str, df: DataFrame, months: list[str] | None, by_month: bool) -> DataFrame:
        if by_month:
            table = self._monthly.setdefault(name, MonthlyTable(self.spark, f"{self.root}/{name}"))
            table.write(df, months)
            out = table.read()
        else:
            old = self._plain.setdefault(name, [])
            while len(old) > 1:  # the version before stays for queries that were planned on it
                commits.remove(self.spark, old.pop(0))
            old.append(self.fresh(name))
            out = write_table(df, old[-1])
        with self._lock:
            self._tables[name] = out
        return out

    def rewrite(self, name: str, df: DataFrame, partition_by: list[str] | None = None) -> int:
        """Put ``df`` in a derived table's place, whatever its builder says; its dependants become stale.
        Returns the rows."""
        out = self._store(name, df, None, partition_by == [MONTH])
        self.mark_stale(name, None)
        return out.count()

    def months(self, t0: int | None, t1: int | None) -> list[str] | None:
        """The months of the fact and of the stored hours that [t0, t1] touches; None without bounds."""
        if t0 is None and t1 is None:
            return None
        known = {r[0] for r in self["fact_connection"].select(MONTH).distinct().collect()}  # one row per month
        known |= {m for t in self._monthly.values() for m in t.months}
        name = lambda t: (_dt.datetime(1970, 1, 1) + _dt.timedelta(seconds=t)).strftime("%Y-%m")
        return sorted(m for m in known if m is not None and (t0 is None or m >= name(t0)) and (t1 is None or m <= name(t1)))

    def dim(self, name: str) -> DataFrame:
        """A dimension wrapped for lookups: broadcast when its counted size allows."""
        return sized(self._tables[name], self.sizes[name])

    def companion(self, name: str, load: Callable[[str], "Mart"]) -> "Mart":
        """Another mart that belongs to this one; loaded on first use."""
        with self._lock:
            if name not in self._companions:
                self._companions[name] = load(f"{self.root}/{name}")
            return self._companions[name]

    # ---- build ---------------------------------------------------------------------
    def build(self) -> "Mart":
        with self._lock:
            if self.built:
                return self
            self.audit.fail_orphans()
            self.raw = write_table(self.raw, f"{self.root}/staging")
            self.stg = valid_rows(self.raw)
            self.audit.run("RAW", self._load_dimensions)
            self.audit.run("RAW", self._load_facts)
            self.built = True
            return self

    def _load_dimensions(self, batch_id: int) -> int:
        numbered = D.number_members(D.dimension_members(self.stg), stage=lambda df: write_table(df, self.scratch("members_by_range")))
        return self._register(self._write("members", numbered))

    def _register(self, members: DataFrame) -> int:
        """The dimensions over the written members; returns how many members there are."""
        # One tiny aggregation bounds every dimension (rows <= members of its kind + 1).
        per_kind = {r["dim"]: r["n"] for r in members.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
        bound = {
            "dim_time": per_kind.get(D.M_HOUR, 0),
            "dim_service": per_kind.get(D.M_SERVICE, 0) + 1,
            "dim_protocol": per_kind.get(D.M_PROTO, 0) + 1,
            "dim_state": per_kind.get(D.M_STATE, 0) + 1,
            "dim_port": per_kind.get(D.M_PORT, 0) + 1,
            "dim_attack": per_kind.get(D.M_ATTACK_CAT, 0) + 1,
            "g1_dim_service": per_kind.get(D.M_SERVICE, 0),
            "g1_dim_protocol": per_kind.get(D.M_PROTO_STATE, 0),
            "g1_dim_attack_category": per_kind.get(D.M_ATTACK_CAT, 0),
            "g1_dim_attack": per_kind.get(D.M_ATTACK_FLAG, 0),
        }
        # Dimensions are deterministic views over the written members (dense keys over a
        # unique natural key), cached; a lost cache block is recomputed from ``members``.
        for name, build in {**_G2_DIMS, **_G1_DIMS}.items():
            self._tables[name] = build(members, self.load_time).cache()
        self._tables["g1_dim_attack"] = D.g1_dim_attack(members, self._tables["g1_dim_attack_category"]).cache()
        self._tables["g1_dim_time"] = D.g1_dim_time(self.stg)
        self.sizes.update(bound)
        V.assert_one_active({name: (self._tables[name], key) for name, key in _NATURAL_KEYS.items()})
        return sum(per_kind.values())

    def _load_facts(self, batch_id: int) -> int:
        fact = FX.g2_fact_connection(
            self.stg,
            self.dim("dim_service"),
            self.dim("dim_port"),
            self.dim("dim_state"),
            self.dim("dim_protocol"),
            self.dim("dim_attack"),
            batch_id,
        )
        self._write("fact_connection", fact, ["year_month"], count=True)
        g1 = FX.g1_fact_connections(
            self.stg, self.dim("g1_dim_service"), self.dim("g1_dim_protocol"), self.dim("g1_dim_attack")
        )
        self._write("g1_fact_connections", g1, ["year_month"], count=True)
        return self.sizes["fact_connection"]

    # ---- accessors -----------------------------------------------------------------
    def __getitem__(self, name: str) -> DataFrame:
        return self._tables[name]


_MARTS: dict[tuple[str, str], Mart] = {}
_MARTS_LOCK = threading.Lock()


def get_mart(spark: SparkSession, sf_dir: str) -> Mart:
    """The built mart for ``sf_dir`` in this Spark application (built on first call)."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _MARTS_LOCK:
        mart = _MARTS.get(key)
        if mart is None:
            mart = Mart(spark, staging_raw(spark, sf_dir))
            mart.sf_dir = sf_dir.rstrip("/")
            _MARTS[key] = mart
    return mart.build()
