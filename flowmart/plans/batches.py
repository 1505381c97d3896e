"""F4 + F3: a mart that grows by batches, each of them loaded exactly once.

``append(staging, batch)`` adds a batch to the stored dimensions and facts:

* New members get the ids after the stored ones; members that are there keep theirs, whatever the
  batch says about them.
* The batch's facts go to folders of their own. Loading the same batch again replaces those and
  nothing else: the same input changes nothing, a corrected one corrects its own rows.
* What counts is a numbered commit (``operators/commits.py``): it lists the folders of every batch.
  A load that dies before its commit has changed nothing, and of two loaders that read the same
  state only one can commit; the other looks again, and starts over if members were added.
* The derived tables are stale for the months that the batch has or had, and follow on their
  next use.

The state survives the driver: ``BatchedMart(spark, root)`` goes on where the last one stopped.
Folders that a commit has replaced are removed with the next one.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmart.operators import commits
from flowmart.operators import dims as D
from flowmart.operators import facts as FX
from flowmart.operators.quality import valid_rows
from flowmart.operators.tables import write_table
from flowmart.plans.mart import Mart
from flowmart.plans.monthly import MONTH
from flowmart.sources.schema import STAGING_SCHEMA

FACTS = ("fact_connection", "g1_fact_connections")
MEMBERS = "members"
#: connection_id = batch ordinal, task, row: 15, 20 and 28 bits.
TASK_BITS, ROW_BITS = 20, 28


def _own_ids(fact: DataFrame, id_col: str, ordinal: int) -> DataFrame:
    """Row ids that no other batch has. Out of bits is an error, never a repeated id."""
    raw = F.monotonically_increasing_id()
    task, row = F.shiftright(raw, 33), raw.bitwiseAND(F.lit((1 << 33) - 1))
    fits = (task < (1 << TASK_BITS)) & (row < (1 << ROW_BITS)) & F.lit(ordinal < 1 << 15)
    own = F.lit(ordinal << (TASK_BITS + ROW_BITS)) + F.shiftleft(task, ROW_BITS) + row
    return fact.withColumn(id_col, F.when(fits, own).otherwise(F.raise_error(F.lit("no ids left for this batch"))))


class BatchedMart(Mart):
    def __init__(self, spark: SparkSession, root: str | None = None):
        super().__init__(spark, spark.createDataFrame([], STAGING_SCHEMA), root)
        self.log = commits.Commits(spark, f"{self.root}/_commits")
        self._schemas: dict[str, T.StructType] = {}
        self.built = True  # by its batches
        self.audit.fail_orphans()
        _, state = self.log.latest()
        if state:
            self._show(state)

    # ---- stored state ------------------------------------------------------------------
    def _read(self, name: str, state: dict) -> DataFrame:
        schema = T.StructType.fromJson(state["schemas"][name])
        folders = [f for b in state["batches"].values() for f in b["folders"][name]]
        if not folders:
            return self.spark.createDataFrame([], schema)
        df = self.spark.read.schema(schema).option("basePath", f"{self.root}/{name}").parquet(*[f"{self.root}/{name}/{f}" for f in folders])
        return df.select(*schema.names)

    def _show(self, state: dict) -> None:
        """Make the tables of a committed state the ones that queries see."""
        members = self._read(MEMBERS, state)
        self._tables[MEMBERS] = members
        self._register(members)
        self._show_facts(state)

    def _show_facts(self, state: dict) -> None:
        self._tables.pop("g1_dim_time", None)  # a view of the staging rows, which are not stored
        for name in FACTS:
            self._tables[name] = self._read(name, state)
            self.sizes[name] = sum(b["rows"][name] for b in state["batches"].values())

    def batches(self) -> list[str]:
        return sorted(self.log.latest()[1].get("batches", {}))

    # ---- loading -----------------------------------------------------------------------
    def append(self, staging: DataFrame, batch: str) -> int:
        """Load ``staging`` as ``batch`` (an audited step); returns the rows of its connection fact."""
        rows, loaded = valid_rows(staging), []

        def step(batch_id: int) -> int:
            loaded.append(self._load(rows, batch, batch_id))
            return loaded[0]

        with self._lock:
            self.audit.run("RAW", step)
        return loaded[0]

    def _load(self, rows: DataFrame, batch: str, batch_id: int) -> int:
        while True:
            version, base = self.log.latest()
            state, token = base, f"load={batch}-{uuid.uuid4().hex[:8]}"
            new_members = self._new_members(rows, base, token)
            own, dims = self._facts(rows, base, batch, batch_id, token, new_members)
            # Commit over whatever came meanwhile, as long as nobody gave the same ids.
            while self._member_folders(state) == self._member_folders(base) and own["ordinal"] not in self._ordinals(state, batch):
                new = self._with_batch(state, batch, token, own)
                if self.log.commit(version, new):
                    self._finish(state, new, batch, dims)
                    return own["rows"]["fact_connection"]
                version, state = self.log.latest()
            for name in (MEMBERS, *FACTS):  # start over on the newer state
                commits.remove(self.spark, f"{self.root}/{name}/{token}")

    @staticmethod
    def _ordinals(state: dict, batch: str) -> set[int]:
        """The ordinals of the other batches."""
        return {b["ordinal"] for k, b in state.get("batches", {}).items() if k != batch}

    @staticmethod
    def _member_folders(state: dict) -> set[str]:
        return {f for b in state.get("batches", {}).values() for f in b["folders"][MEMBERS]}

    def _new_members(self, rows: DataFrame, state: dict, token: str) -> DataFrame:
        """The members of the batch that are not stored yet, numbered after the stored ones, written."""
        seen = D.dimension_members(rows)
        after = None
        if state:
            known = self._read(MEMBERS, state)
            same = [seen[c].eqNullSafe(known[c]) for c in D.MEMBER_KEY]
            seen = seen.join(known.select(*D.MEMBER_KEY), same[0] & same[1] & same[2] & same[3], "left_anti")
            after = known.groupBy("dim").agg(F.max("key_all").alias("key_all"), F.max("key_g2").alias("key_g2"))
        numbered = D.number_members(seen, after, stage=lambda df: write_table(df, self.scratch("members_by_range")))
        return write_table(numbered, f"{self.root}/{MEMBERS}/{token}")

    def _facts(self, rows: DataFrame, state: dict, batch: str, batch_id: int, token: str, new_members: DataFrame) -> tuple[dict, tuple]:
        """Write the batch's facts with lookups over all members; ((rows, schemas, ordinal), the dimensions)."""
        members = self._read(MEMBERS, state).unionByName(new_members) if state else new_members
        held = dict(self._tables), dict(self.sizes)
        try:  # lookups as in a build, over the members that will be there
            self._register(members)
            made = {
                "fact_connection": FX.g2_fact_connection(rows, *(self.dim(d) for d in ("dim_service", "dim_port", "dim_state", "dim_protocol", "dim_attack")), batch_id),
                "g1_fact_connections": FX.g1_fact_connections(rows, *(self.dim(d) for d in ("g1_dim_service", "g1_dim_protocol", "g1_dim_attack"))),
            }
            ordinal = state.get("batches", {}).get(batch, {}).get("ordinal") or 1 + max(self._ordinals(state, batch), default=0)
            out = {"rows": {}, "schemas": {MEMBERS: new_members.schema.jsonValue()}, "ordinal": ordinal}
            for name, id_col in zip(FACTS, ("connection_id", "fact_key")):
                df = write_table(_own_ids(made[name], id_col, ordinal), f"{self.root}/{name}/{token}", [MONTH])
                out["rows"][name], out["schemas"][name] = df.count(), df.schema.jsonValue()
            return out, ({**self._tables, MEMBERS: members}, dict(self.sizes))
        finally:
            self._tables, self.sizes = held

    def _with_batch(self, state: dict, batch: str, token: str, own: dict) -> dict:
        batches = dict(state.get("batches", {}))
        before = batches.get(batch, {"folders": {MEMBERS: [], **{n: [] for n in FACTS}}})
        folders = {MEMBERS: [*before["folders"][MEMBERS], token], **{n: [token] for n in FACTS}}  # its members stay, they have ids
        batches[batch] = {"folders": folders, "rows": own["rows"], "ordinal": own["ordinal"]}
        retired = [f"{n}/{f}" for n in FACTS for f in before["folders"][n]]
        return {"batches": batches, "schemas": own["schemas"], "retired": retired}

    def _finish(self, before: dict, after: dict, batch: str, dims: tuple) -> None:
        for folder in before.get("retired", []):  # replaced by the commit before; no new reader uses it
            commits.remove(self.spark, f"{self.root}/{folder}")
        touched = {m for s in (before, after) for f in s.get("batches", {}).get(batch, {}).get("folders", {}).get("fact_connection", []) for m in self._months_of(f)}
        self._tables.update({k: v for k, v in dims[0].items() if k == MEMBERS or k.startswith(("dim_", "g1_dim_"))})
        self.sizes.update(dims[1])
        self._show_facts(after)
        self.mark_stale("fact_connection", sorted(touched))
        self.mark_stale("g1_fact_connections", None)

    def _months_of(self, folder: str) -> list[str]:
        names = commits.children(self.spark, f"{self.root}/fact_connection/{folder}")
        return [n.split("=", 1)[1] for n in names if n.startswith(f"{MONTH}=")]
