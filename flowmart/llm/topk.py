"""Exact top-k search by distributed histogram selection.

All (query, candidate) scores are computed block by block and never stored. Per query a
histogram of its scores over all blocks is summed; the bin that holds the k-th highest score
becomes the next round's range, until the range is one score wide. A last pass keeps
the scores above it and, of the ties, the smallest ids (at most k per block and query), and
a window ranks what is left.

A cell of work is one block of candidates against one block of queries; both block counts
follow from the row counts, so a cell's size is bounded and cells spread over the cluster.

Vectors are scaled and floored to integers, which doubles hold exactly, and all scores are exact
integers of any size: where a product could leave 64 bits, Python's integers take over, the
histograms run over the scores' leading bits, and the exact scores break the ties. A score beyond
64 bits is reported as the nearest long; ranks follow the exact ones. Vectors that are null or hold
a component that is null or, scaled, not finite take no part, nor do rows without an id.
Shorter vectors count as padded with zeros. Equal rows count once, rows that share the
query's id are its own. An empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmart.llm.common import ship, stage, table

BLOCK_ROWS = 4096
BINS = 256
#: Bits of the numbers that the histograms run over, so that no range leaves a long.
KEY_BITS = 54
LONG = 2**63 - 1


def integer_vectors(rows: DataFrame, scale: float = 64.0) -> DataFrame:
    """(vec_id, v): the usable vectors as integers ``floor(scale * x)`` in doubles."""
    scaled = lambda x: F.lit(scale) * x.cast("double")
    usable = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(scaled(x)) < float("inf"))
    )
    whole = lambda y: F.when(F.abs(y) < 2.0**53, F.floor(y).cast("double")).otherwise(y)  # noqa: E731  beyond, doubles are whole
    v = F.transform("embedding", lambda x: whole(scaled(x)))
    return rows.where(usable).select(F.col("vec_id").cast("long"), v.alias("v")).distinct()


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    lengths = np.diff(lists.offsets.to_numpy())
    flat = lists.flatten().to_numpy()
    if len(lengths) and (lengths == width).all():
        return flat.reshape(len(lengths), width)
    out = np.zeros((len(lengths), width))
    at = np.repeat(np.arange(len(lengths)), lengths)
    out[at, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
    return out


def _whole(m: np.ndarray) -> np.ndarray:
    """Whole doubles as Python's integers."""
    return np.array([[int(x) for x in row] for row in m], object).reshape(m.shape)


def _scores(cands: pa.Table, queries: pa.Table) -> Iterator[np.ndarray]:
    """The exact scores of all candidates, query by query."""
    width = max((max(t["v"].combine_chunks().value_lengths().to_numpy(zero_copy_only=False), default=0) for t in (cands, queries)), default=0)
    c, q = _matrix(cands["v"], width), _matrix(queries["v"], width)
    bound = float(np.abs(c).max(initial=0)) * float(np.abs(q).max(initial=0)) * max(width, 1)
    if bound < 2**52:  # then doubles hold every partial sum exactly
        yield from np.rint(q @ c.T).astype(np.int64)
        return
    most = math.isqrt(2**62 // max(int(width), 1))
    large = np.abs(c).max(axis=1, initial=0) > most
    small, wide = c[~large].astype(np.int64), _whole(c[large])
    for row in q:
        exact = _whole(row[None])[0]
        if np.abs(row).max(initial=0) > most:
            yield _whole(c) @ exact
        elif large.any():
            out = np.empty(len(c), object)
            out[~large], out[large] = (small @ row.astype(np.int64)).tolist(), wide @ exact
            yield out
        else:
            yield small @ row.astype(np.int64)


def top_k(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score) of each query's ``k`` best candidates in ``vectors``."""
    ship(vectors.sparkSession)
    vectors = stage(vectors, "topk-vectors")
    queries = stage(queries.withColumnRenamed("vec_id", "query_id"), "topk-queries")
    n_blocks, q_blocks = (max(1, -(-t.count() // BLOCK_ROWS)) for t in (vectors, queries))
    length = F.max(F.coalesce(F.array_max(F.transform("v", F.abs)), F.lit(0.0)))
    size = F.max(F.size("v"))
    c_max, c_len = vectors.agg(length, size).first()
    q_max, q_len = queries.agg(length, size).first()
    reach = int(c_max or 0) * int(q_max or 0) * max(1, min(c_len or 0, q_len or 0))  # no score is further from 0
    shift = max(0, reach.bit_length() - KEY_BITS)
    limit = (reach >> shift) + 1
    width = reach.bit_length() // 8 + 1
    offset = 1 << (8 * width - 1)

    def key(scores: np.ndarray) -> np.ndarray:
        """The leading bits of scores, in the same order; all of them, if they fit."""
        return (scores >> shift).astype(np.int64) if shift < 63 or scores.dtype == object else np.minimum(np.sign(scores), 0)

    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    cands = vectors.select(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)).alias("cb"), each(q_blocks).alias("qb"), "vec_id", "v")

    def cells(state: DataFrame) -> DataFrame:
        """Queries with their state, once for each block of candidates."""
        q = queries.join(state, "query_id")
        q = q.withColumn("qb", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)))
        return cands.groupBy("cb", "qb").cogroup(q.withColumn("cb", each(n_blocks)).groupBy("cb", "qb"))

    def histogram(c: pa.Table, q: pa.Table) -> pa.Table:
        out: list[list[np.ndarray]] = [[], [], []]
        if c.num_rows and q.num_rows:
            ids = c["vec_id"].to_numpy()
            for scores, qid, lo, step in zip(_scores(c, q), *(q[n].to_numpy() for n in ("query_id", "lo", "step"))):
                s = key(scores)[ids != qid]
                s = (s[(s >= lo) & (s < lo + step * BINS)] - lo) // step
                n = np.bincount(s, minlength=1)
                full = np.flatnonzero(n)
                for o, x in zip(out, (np.full(len(full), qid), full, n[full])):
                    o.append(x)
        return pa.table({n: pa.array(np.concatenate(o) if o else [], pa.int64()) for n, o in zip(("query_id", "bin", "n"), out)})

    # lo, step: the range of the round is [lo, lo + BINS * step); left: how many of the k lie in it.
    step = 1
    while step * BINS < 2 * limit + 1:
        step *= BINS
    state = queries.select("query_id").distinct().select("query_id", F.lit(-limit).cast("long").alias("lo"), F.lit(step).cast("long").alias("step"), F.lit(k).cast("long").alias("left"))
    while True:
        bins = cells(state).applyInArrow(histogram, "query_id long, bin long, n long").groupBy("query_id", "bin").agg(F.sum("n").alias("n"))
        w = Window.partitionBy("query_id").orderBy(F.desc("bin"))  # at most BINS rows a query
        down = bins.join(state, "query_id").withColumn("to", F.sum("n").over(w))
        # The bin in which the count first reaches what is left; the lowest bin if it never does.
        hit = down.where((F.col("to") - F.col("n") < F.col("left"))).groupBy("query_id").agg(F.min_by(F.struct("lo", "step", "left", "bin", "n", "to"), "bin").alias("s"))
        state = stage(
            hit.select(
                "query_id",
                (F.col("s.lo") + F.col("s.bin") * F.col("s.step")).alias("lo"),
                F.greatest(F.lit(1), F.floor(F.col("s.step") / BINS)).cast("long").alias("step"),
                (F.col("s.left") - (F.col("s.to") - F.col("s.n"))).alias("left"),
            ),
            "topk-state",
        )
        if step == 1:
            break
        step //= BINS

    def keep(c: pa.Table, q: pa.Table) -> pa.Table:
        out: list[list] = [[], [], [], []]
        if c.num_rows and q.num_rows:
            order = np.argsort(c["vec_id"].to_numpy(), kind="stable")
            ids = c["vec_id"].to_numpy()[order]
            for scores, qid, lo, left in zip(_scores(c, q), *(q[n].to_numpy() for n in ("query_id", "lo", "left"))):
                scores, own = scores[order], ids != qid
                keys = key(scores)
                ties = np.flatnonzero((keys == lo) & own)
                if shift:  # the best of them, in order of ids where equal
                    ties = ties[np.argsort(-scores[ties], kind="stable")]
                at = np.concatenate([np.flatnonzero((keys > lo) & own), ties[:left]])
                best = [int(x) for x in scores[at]]
                exact = [(x + offset).to_bytes(width, "big") if shift else b"" for x in best]  # in byte order
                for o, x in zip(out, (np.full(len(at), qid), ids[at], [min(max(x, -LONG - 1), LONG) for x in best], exact)):
                    o.extend(x)
        types = (("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("exact", pa.binary()))
        return pa.table({n: pa.array(o, t) for o, (n, t) in zip(out, types)})

    found = cells(state).applyInArrow(keep, "query_id long, vec_id long, score long, exact binary")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("exact"), "vec_id"))
    return found.select("query_id", rank.alias("rank"), "vec_id", "score").where(F.col("rank") <= k)


def op2_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = integer_vectors(table(spark, sf_dir, "embeddings"))
    return top_k(vectors, vectors.where(F.col("vec_id") % 20 == 0), 20)


ORACLE = {
    "op2_topk": """
with v as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from v q, v c where q.vec_id % 20 = 0 and c.vec_id <> q.vec_id),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 20
"""
}
