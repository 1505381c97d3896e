"""Near-duplicate embeddings: an exact metric range join on the angle between vectors.

Two vectors are linked if their cosine is at least ``COSINE``, that is if their angle is at most
R = acos(COSINE). Angles obey the triangle inequality, so pivots cut the join into cells:

* Equal vectors collapse into one class before anything else.
* Pivots are vectors of a bounded sample (a hash order, ``SAMPLE`` of them at most) and only steer
  the work; the result is the same for any. Some are dense: they have company inside R / 4, so
  a large group of near copies gets one. The others are about one per ``CELL`` classes.
* A class within R / 2 of its nearest dense pivot belongs to the core of it. All members of a core
  are linked by the triangle inequality: they are counted and become one vertex without a
  comparison, however many they are. Any other class belongs to the cell of its nearest other
  pivot. Cores and cells are the parts of the join.
* A class is sent to another part if that could hold a partner: not if its angle to the part's pivot
  lies further than R outside the angles that occur there, and not to a cell if it lies further
  than R beyond the plane between two pivots. A class within R of a whole core is linked to all
  of it at once.
* Parts join independently. Natives of a part are dealt over blocks of about ``CELL``; a task holds the
  natives of one block, and what was sent to it streams past. Each ordered pair is looked at in
  exactly one place (the part in which the second one lives), so link counts add up. Links
  inside a block become a spanning forest; pairs are never listed.

Bounds from angles have a slack of 1e-6, far over rounding; cosines within 1e-9 of the
threshold are decided by correctly rounded sums, alike from both sides.

A metric bound prunes only what has structure: vectors without any, in many dimensions, are all
within reach of every cell (not of the tight cores), and an exact join then compares nearly all
pairs of them, block by block.

Edge cases: vectors that are null, empty, zero or hold null or non-finite components link with
nothing, nor do rows without a vec_id (their component is null and they are kept); shorter
vectors count as padded with zeros; rows with the same vec_id and vector are one vector, each of
them is returned; the vectors of an id with several different ones count apart as links and are
one vertex of the components; an empty table gives an empty result; labels and extra columns are
ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.llm.common import ship, shuffle_partitions, stage, table
from flowmart.llm.components import components

COSINE = 0.9
#: Classes per block, the most vectors that are looked at to choose pivots, the most pivots of a kind.
CELL, SAMPLE, PIVOTS = 4096, 4096, 512
SLACK = 1e-6
STEP = 1024  # rows of a matrix product


def units(vectors: list | pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(vectors padded to ``width``, the same at length 1), in double precision."""
    lists = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
    flat = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    raw = np.zeros((len(lengths), width))
    raw[np.arange(width)[None, :] < lengths[:, None]] = flat
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)  # no overflow in the squares
    return raw, scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def linked(x: np.ndarray, y: np.ndarray, raw_x: np.ndarray, raw_y: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of x (units) are linked to which of y; close calls by correctly rounded sums."""
    c = x @ y.T
    near = c >= cosine
    for i, j in zip(*np.nonzero(np.abs(c - cosine) < 1e-9)):
        a, b = (v / np.abs(v).max() for v in (raw_x[i], raw_y[j]))
        near[i, j] = math.fsum(a * b) / math.sqrt(math.fsum(a * a) * math.fsum(b * b)) >= cosine
    return near


def angles(cosines: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(cosines, -1.0, 1.0))


def choose_pivots(sample: np.ndarray, wanted: int, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """(dense, other) rows of ``sample`` (units): those with company inside reach / 4, most first, no two
    of them that close; and ``wanted`` others, apart from all chosen ones as far as there are such."""
    company = np.concatenate([(sample[i : i + STEP] @ sample.T >= np.cos(reach / 4)).sum(1) for i in range(0, len(sample), STEP)])
    free, dense, other = np.ones(len(sample), bool), [], []
    for i in np.argsort(-company, kind="stable"):
        if company[i] > 2 and free[i] and len(dense) < PIVOTS:
            dense.append(i)
            free &= sample @ sample[i] < np.cos(reach / 4)
    for i in [*np.flatnonzero(free), *np.flatnonzero(~free)]:
        if len(other) < wanted and (free[i] or len(other) + free.sum() < wanted):
            other.append(i)
            free &= sample @ sample[i] < np.cos(reach)
    return sample[dense], sample[other]


class Plan:
    """What tasks need to know: the pivots and, per part (the cores of the dense pivots, then the cells
    of the others), the least and greatest angle to the pivot, the number of blocks, the vectors
    in it and its smallest id."""

    def __init__(self, dense: np.ndarray, other: np.ndarray, width: int, cosine: float):
        self.dense, self.other, self.width, self.cosine = dense, other, width, cosine
        self.reach = math.acos(cosine)
        between = np.sqrt(np.maximum(2 - 2 * other @ other.T, 0))
        self.apart = between * math.sqrt(2 - 2 * cosine) + SLACK
        self.cores, parts = len(dense), len(dense) + len(other)
        self.low, self.high = np.full(parts, np.inf), np.full(parts, -np.inf)
        self.blocks, self.weight, self.head = (np.zeros(parts, np.int64) for _ in range(3))

    def home(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(part, angle to its pivot) of each vector."""
        rows, to = np.arange(len(unit)), unit @ self.other.T
        part = to.argmax(1)
        angle = angles(to[rows, part])
        part += self.cores
        if self.cores:
            to = unit @ self.dense.T
            core = to.argmax(1)
            inner = angles(to[rows, core])
            inside = inner <= self.reach / 2 - SLACK
            part, angle = np.where(inside, core, part), np.where(inside, inner, angle)
        return part, angle

    def reached(self, unit: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Vectors by parts: which part may hold a partner, which core is within reach as a whole."""
        rows, to = np.arange(len(unit)), unit @ self.other.T
        own = to.argmax(1)
        near = to[rows, own][:, None] - to <= self.apart[own]
        angle = angles(np.concatenate([unit @ self.dense.T, to], axis=1))
        may = (self.weight > 0) & (angle - self.reach <= self.high + SLACK) & (angle + self.reach >= self.low - SLACK)
        may[:, self.cores :] &= near
        cell = home >= self.cores
        may[rows[cell], home[cell]] = True
        may[rows[~cell], home[~cell]] = False  # a core needs no look at itself
        whole = may & (np.arange(may.shape[1]) < self.cores) & (angle + self.high <= self.reach - SLACK)
        return may & ~whole, whole

    def vertex(self, part: np.ndarray, rep: np.ndarray) -> np.ndarray:
        """What stands for a class in the components: its smallest id, or its core's."""
        return np.where(part < self.cores, self.head[part], rep)


def _batches(fn):
    """Adapt a function of a record batch that gives a record batch to ``mapInArrow``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, CELL):
                yield fn(b.slice(at, CELL))

    return run


def usable(rows: DataFrame) -> DataFrame:
    """(vec_id, v) of every row of (vec_id, embedding): v is the vector without zeros at its end, null
    if it takes no part."""
    e = F.col("embedding")
    fine = F.col("vec_id").isNotNull() & F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(e, lambda x: x != 0)
    last = F.aggregate(F.sequence(F.lit(1), F.size(e)), F.lit(0), lambda a, i: F.when(F.element_at(e, i) != 0, i).otherwise(a))
    v = F.when(F.element_at(e, -1) != 0, e).otherwise(F.slice(e, 1, last))
    kind = "float" if dict(rows.dtypes)["embedding"] == "array<float>" else "double"
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.when(fine, v.cast(f"array<{kind}>")).alias("v"))


def classes(vectors: DataFrame) -> DataFrame:
    """(v, rep, m, cls) of distinct (vec_id, v): a class per vector, its smallest id, how many ids it has,
    and a number of its own."""
    of = vectors.groupBy("v").agg(F.min("vec_id").alias("rep"), F.count("*").alias("m"))
    return stage(of.withColumn("cls", F.monotonically_increasing_id()), "embedding-classes")


#: A row has (cls, n), the links of a class to natives of a block, or (a, b), vertices of a link.
_FOUND = pa.schema([(n, pa.int64()) for n in ("cls", "n", "a", "b")])
FOUND_DDL = "cls long, n long, a long, b long"


def _root(parent: np.ndarray, i: int) -> int:
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


class _Block:
    """The natives of one block of a part, and what is found while members stream past."""

    def __init__(self, plan: Plan):
        self.plan = plan
        self.rows: list[tuple] = []
        self.parent = None

    def _close(self) -> None:
        self.cls, self.vertex, self.m, self.raw, self.unit = (np.concatenate(x) for x in zip(*self.rows))
        self.parent = np.arange(len(self.cls))

    def join(self, cls: np.ndarray, vertex: np.ndarray, raw: np.ndarray, unit: np.ndarray) -> Iterator[tuple]:
        """What members (class, vertex, vector, unit) find."""
        if not self.rows:
            return
        if self.parent is None:
            self._close()
        for at in range(0, len(cls), STEP):
            near = linked(unit[at : at + STEP], self.unit, raw[at : at + STEP], self.raw, self.plan.cosine)
            near &= cls[at : at + STEP, None] != self.cls[None, :]
            for i in np.flatnonzero(near.any(1)).tolist():
                to = np.flatnonzero(near[i])
                yield int(cls[at + i]), int(self.m[to].sum()), int(vertex[at + i]), int(self.vertex[to[0]])
                roots = {_root(self.parent, j) for j in to.tolist()}
                for r in roots:
                    self.parent[r] = min(roots)

    def forest(self) -> Iterator[tuple]:
        """The links that connect natives which members have in common."""
        for i in range(len(self.parent) if self.parent is not None else 0):
            r = _root(self.parent, i)
            if r != i:
                yield None, None, int(self.vertex[i]), int(self.vertex[r])


def _join_parts(plan: Plan):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows in the order of (part, block, natives first)."""
        key, block, out = None, _Block(plan), []
        full = lambda: pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out), _FOUND)], schema=_FOUND)
        for b in batches:
            keys = np.stack([b["part"].to_numpy(), b["block"].to_numpy(), b["native"].to_numpy(zero_copy_only=False).astype(np.int64)])
            cuts = [0, *(np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(0)) + 1).tolist(), b.num_rows]
            cls, vertex, m = (b[n].to_numpy() for n in ("cls", "vertex", "m"))
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                if key != (now := tuple(keys[:2, lo].tolist())):
                    out += block.forest()
                    key, block = now, _Block(plan)
                raw, unit = units(b["v"].slice(lo, hi - lo), plan.width)
                if keys[2, lo]:
                    block.rows.append((cls[lo:hi], vertex[lo:hi], m[lo:hi], raw, unit))
                else:
                    out += block.join(cls[lo:hi], vertex[lo:hi], raw, unit)
            if out:
                yield full()
                out = []
        out += block.forest()
        if out:
            yield full()

    return run


def links(found: DataFrame, cosine: float = COSINE) -> tuple[DataFrame, DataFrame, DataFrame, Plan]:
    """(the classes with their parts, (cls, n): the links of each class to other classes, counted in
    vectors, (a, b): vertices whose links connect what is linked, the plan) of ``classes``."""
    spark = found.sparkSession
    ship(spark)
    vector = f"v {found.schema['v'].dataType.simpleString()}"
    n, width = found.agg(F.count("*"), F.max(F.size("v"))).first()
    width = width or 1
    # The sample's vectors on the driver: SAMPLE rows at most, whatever the input.
    sample = found.orderBy(F.xxhash64("cls"), "cls").limit(SAMPLE).select("v").toArrow()["v"]
    pivots = choose_pivots(units(sample, width)[1], min(PIVOTS, -(-n // CELL)), math.acos(cosine)) if n else (np.zeros((0, width)), np.zeros((1, width)))
    plan = Plan(*pivots, width, cosine)

    def at_home(b: pa.RecordBatch) -> pa.RecordBatch:
        part, angle = plan.home(units(b["v"], plan.width)[1])
        return pa.record_batch([pa.array(part, pa.int64()), pa.array(angle), *(b[c] for c in ("cls", "rep", "m", "v"))], names=["part", "angle", "cls", "rep", "m", "v"])

    homes = stage(found.select("cls", "rep", "m", "v").mapInArrow(_batches(at_home), f"part long, angle double, cls long, rep long, m long, {vector}"), "embedding-homes")
    # One row per part: 2 * PIVOTS at most.
    for r in homes.groupBy("part").agg(F.min("angle"), F.max("angle"), F.count("*"), F.sum("m"), F.min("rep")).collect():
        plan.low[r[0]], plan.high[r[0]], plan.blocks[r[0]], plan.weight[r[0]], plan.head[r[0]] = r[1], r[2], -(-r[3] // CELL), r[4], r[5]

    def send(b: pa.RecordBatch) -> pa.RecordBatch:
        """Copies for the blocks of parts that may hold partners; block -1: a whole core within reach."""
        home = b["part"].to_numpy()
        may, whole = plan.reached(units(b["v"], plan.width)[1], home)
        (at, part), (own, core) = np.nonzero(may), np.nonzero(whole)
        copies = plan.blocks[part]
        block = np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
        at, part = np.repeat(at, copies), np.repeat(part, copies)
        rows = pa.array(np.concatenate([at, own]))
        v = pa.concat_arrays([b["v"].take(pa.array(at)), pa.nulls(len(own), b["v"].type)])
        to = (pa.array(np.concatenate(x), pa.int64()) for x in ([part, core], [block, np.full(len(own), -1)]))
        vertex = pa.array(plan.vertex(home, b["rep"].to_numpy()))
        return pa.record_batch([*to, b["cls"].take(rows), vertex.take(rows), v], names=["part", "block", "cls", "vertex", "v"])

    sent = stage(homes.select("part", "cls", "rep", "v").mapInArrow(_batches(send), f"part long, block long, cls long, vertex long, {vector}"), "embedding-sent")
    asked = F.broadcast(sent.where("block >= 0").select("part").distinct())  # one row per part
    vertex = F.when(F.col("part") < plan.cores, _per_part(plan.head)).otherwise(F.col("rep"))
    natives = homes.join(asked, "part", "left_semi").select(
        "part", F.pmod(F.xxhash64("cls"), _per_part(plan.blocks)).alias("block"), F.lit(True).alias("native"), "cls", vertex.alias("vertex"), "m", "v"
    )
    members = sent.where("block >= 0").select("part", "block", F.lit(False).alias("native"), "cls", "vertex", F.lit(0).cast("long").alias("m"), "v")
    dealt = natives.unionByName(members).repartition(shuffle_partitions(spark), "part", "block").sortWithinPartitions("part", "block", F.desc("native"))
    joined = stage(dealt.mapInArrow(_join_parts(plan), FOUND_DDL), "embedding-links")

    whole = sent.where("block < 0")
    inside = homes.where(F.col("part") < plan.cores).select("cls", (_per_part(plan.weight) - F.col("m")).alias("n"))
    counts = joined.where("n is not null").select("cls", "n").unionByName(inside).unionByName(whole.select("cls", _per_part(plan.weight).alias("n")))
    edges = joined.select("a", "b").unionByName(whole.select(F.col("vertex").alias("a"), _per_part(plan.head).alias("b")))
    return homes.withColumn("vertex", vertex), counts.groupBy("cls").agg(F.sum("n").alias("n")), edges, plan


def _per_part(values: np.ndarray):
    """The value of the row's part (a literal array of 2 * PIVOTS numbers at most)."""
    return F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in values]), (F.col("part") + 1).cast("int"))


def groups(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding)."""
    vectors = stage(usable(rows), "embedding-vectors")
    ids = vectors.where("v is not null").distinct()
    found = classes(ids)
    homes, counts, edges, plan = links(found, cosine)
    # An id with several vectors is one vertex.
    several = ids.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id")
    if not several.isEmpty():
        edges = edges.unionByName(ids.join(several, "vec_id", "left_semi").join(homes, "v").select(F.col("vec_id").alias("a"), F.col("vertex").alias("b")))
    parts = components(edges)
    # A core is one vertex, its component a number per core (PIVOTS at most): no join on a hot vertex.
    core = dict(parts.where(F.col("v").isin([int(x) for x in plan.head[: plan.cores]])).collect()) if plan.cores else {}
    of_core = _per_part([core.get(int(x), x) for x in plan.head])
    inside, outside = homes.where(F.col("part") < plan.cores), homes.where(F.col("part") >= plan.cores)
    whole = inside.join(counts, "cls", "left").withColumn("c", of_core).select("v", "m", "n", "c").unionByName(
        outside.join(counts, "cls", "left").join(parts.withColumnRenamed("v", "rep"), "rep", "left").select("v", "m", "n", F.coalesce("component", "rep").alias("c"))
    )
    whole = stage(whole.withColumn("n", F.col("m") - 1 + F.coalesce("n", F.lit(0))), "embedding-results")
    # Classes of many copies meet their rows by broadcast: at most 1,000 hold a thousandth of the rows each.
    total = max(1, vectors.count())
    hot = whole.where(F.col("m") * 1000 >= total).select("v", F.col("n").alias("hot_n"), F.col("c").alias("hot_c"))
    met = vectors.join(F.broadcast(hot), "v", "left")
    out = met.where("v is null or hot_n is not null").select("vec_id", F.coalesce("hot_n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("hot_c", "vec_id").alias("component_id"))
    cold = met.where("v is not null and hot_n is null").select("vec_id", "v").join(whole.where(F.col("m") * 1000 < total), "v")
    out = out.unionByName(cold.select("vec_id", F.col("n").alias("n_links"), F.col("c").alias("component_id")))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return groups(table(spark, sf_dir, "embeddings"))


ORACLE = {
    "op11_embedding_dedup": """
with recursive v as (
  select vec_id, list_transform(embedding, lambda x: x::double) as e from embeddings),
u as (select distinct vec_id, e from v where vec_id is not null and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
s as (select vec_id, e, list_dot_product(e, e) as sq from u),
l as (select a.vec_id as a, b.vec_id as b from s a, s b where a.vec_id <> b.vec_id and list_dot_product(a.e, b.e) / sqrt(a.sq * b.sq) >= 0.9),
r(a, c) as (select vec_id, vec_id from u union select l.a, r.c from l join r on l.b = r.a),
n as (select a, count(*) as n_links from l group by a),
c as (select a, min(c) as component_id from r group by a)
select v.vec_id, coalesce(n.n_links, 0)::bigint as n_links, coalesce(c.component_id, v.vec_id) as component_id,
  v.vec_id is not distinct from coalesce(c.component_id, v.vec_id) as kept
from v left join n on v.vec_id = n.a left join c on v.vec_id = c.a
"""
}
