"""Filter interaction audit: what each of five filters removes, alone, after others, and as a
fair share.

Every document is reduced to the set of filters that it fails, and the documents are counted by
(part, set). From these counts all 32 coalition removals v(S), the documents that fail a
filter of S, are tabulated per part. The steps of any order are differences of coalitions:
filter f after the filters S removes v(S + f) - v(S). The Shapley values are the solution of the
kernel-weighted least-squares fit of v by a sum of one value per filter, under the constraint
that the values add up to v(all) (efficiency); its normal equations are solved in rationals, so
the values are exact and 120 times a value is a whole number.

Texts never leave their scan: a document sends its four own verdicts and a SHA-256 of its text.
Copies meet by that hash after combining equal (hash, part, labels), so a text that a third
of all documents share is a few rows per task.

Edge cases: a null text is empty; an empty text has no words and fails A only (and E, if an earlier
one is empty); a null source and an empty one are the part ''; a document without an id is
never a copy, makes none, and has no label; repeated rows of an id count each and are no copies
of each other; of several labels of an id 1 wins, a missing one is no loss; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from fractions import Fraction
from math import comb, factorial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmart.llm.common import arrow_rows, ship, table

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
MARKS = b"#$%&*|"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"

_VERDICTS = pa.schema([("doc_id", pa.int64()), ("part", pa.string()), ("own", pa.int32()), ("print", pa.binary())])
_STEPS = pa.schema(
    [("part", pa.string()), ("filter_order", pa.string()), ("step", pa.int32())]
    + [(n, pa.int64()) for n in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")]
)
STEPS_DDL = "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"


def own_verdicts(text: str) -> int:
    """The filters A to D that ``text`` fails, as bits."""
    raw = text.encode()
    words = raw.split()  # splits bytes at U+0020 and U+0009 to U+000D
    capitals = len(raw) - len(raw.translate(None, CAPITALS))
    return (
        (len(words) < 50)
        | (100 * len(set(words)) < 65 * len(words)) << 1
        | (100 * capitals > 5 * len(text)) << 2
        | (len(raw.translate(None, MARKS)) < len(raw)) << 3
    )


def _verdicts(batches: Iterator[dict]) -> Iterator[tuple]:
    for b in batches:
        for doc_id, text, part in zip(*(b[n].to_pylist() for n in ("doc_id", "text", "source"))):
            text = text or ""
            yield doc_id, part or "", own_verdicts(text), hashlib.sha256(text.encode()).digest()


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): how many documents of a part fail exactly the filters of mask,
    by label."""
    one = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0)).alias(c)
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(one("quality"), one("toxic")).withColumn("spread", F.lit(0).cast("long"))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "source").mapInArrow(
        arrow_rows(_verdicts, _VERDICTS, 10_000), "doc_id long, part string, own int, print binary"
    )
    # Rows without an id match no label; ``spread`` deals them over all tasks.
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("print")).otherwise(F.lit(0).cast("long"))
    own = own.withColumn("spread", spread).join(marks, ["doc_id", "spread"], "left").na.fill(0, ["quality", "toxic"])
    keys = ["print", "own", "part", "quality", "toxic"]
    ids = own.groupBy(*keys, "doc_id").agg(F.count("*").alias("n"))
    least = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("least")
    same = ids.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("none"), least)
    # At most four rows of a hash per part here.
    first = F.min("least.doc_id").over(Window.partitionBy("print"))
    original = F.col("none") + F.when(F.col("least.doc_id") == first, F.col("least.n")).otherwise(0)
    split = same.withColumn("original", original).select(
        "part", F.col("quality").alias("good"), "toxic",
        F.explode(F.array(F.struct(F.col("own").alias("mask"), F.col("original").alias("n")), F.struct((F.col("own") + COPY).alias("mask"), (F.col("n") - F.col("original")).alias("n")))).alias("s"),
    )
    return split.groupBy("part", "s.mask", "good", "toxic").agg(F.sum("s.n").alias("n"))


def coalitions(counts: dict[int, int], n: int) -> list[int]:
    """v(S) for every set S of ``n`` filters: the documents that fail at least one of S."""
    return [sum(c for mask, c in counts.items() if mask & s) for s in range(1 << n)]


def solve(rows: list[list[Fraction]]) -> list[Fraction]:
    """The solution of a regular system given as an augmented matrix, by elimination."""
    rows = [list(r) for r in rows]
    for i in range(len(rows)):
        p = next(k for k in range(i, len(rows)) if rows[k][i])
        rows[i], rows[p] = rows[p], rows[i]
        rows[i] = [x / rows[i][i] for x in rows[i]]
        for k in range(len(rows)):
            if k != i and rows[k][i]:
                rows[k] = [x - rows[k][i] * y for x, y in zip(rows[k], rows[i])]
    return [r[-1] for r in rows]


def shapley(v: list[int], n: int) -> list[Fraction]:
    """The values x that minimise sum over S of w(S) * (v(S) - sum of x over S)^2, S neither empty
    nor whole, w(S) = (n - 1) / (comb(n, s) * s * (n - s)), subject to sum of x = v(all): the
    normal equations with the constraint's multiplier."""
    if n == 1:
        return [Fraction(v[-1])]
    weight = [Fraction(0)] + [Fraction(n - 1, comb(n, s) * s * (n - s)) for s in range(1, n)]
    inner = [(s, weight[s.bit_count()]) for s in range(1, (1 << n) - 1)]
    both = lambda i, j: sum((w for s, w in inner if s >> i & 1 and s >> j & 1), Fraction(0))
    normal = [[both(i, j) for j in range(n)] + [Fraction(1), sum((w * v[s] for s, w in inner if s >> i & 1), Fraction(0))] for i in range(n)]
    return solve([*normal, [Fraction(1)] * n + [Fraction(0), Fraction(v[-1])]])[:n]


def steps_of(counts: list[dict[int, int]], filters: str) -> Iterator[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) for
    every order of the filters; counts: by mask of all, good and toxic documents."""
    n, orders = len(filters), factorial(len(filters))
    v, good, toxic = (coalitions(c, n) for c in counts)
    total, everything = sum(counts[0].values()), (1 << n) - 1
    shares = [int(x * orders) for x in shapley(v, n)]  # whole: a sum over all orders
    for order in itertools.permutations(range(n)):
        name, s = "".join(filters[f] for f in order), 0
        for step, f in enumerate(order, 1):
            t = s | 1 << f
            removed = v[t] - v[s]
            yield name, step, total - v[t], removed, v[1 << f] - removed, v[everything] - v[everything ^ 1 << f], good[t] - good[s], toxic[t] - toxic[s], shares[f]
            s = t


def _audit_part(group: pa.Table) -> pa.Table:
    counts: list[dict[int, int]] = [{}, {}, {}]
    for mask, good, toxic, n in zip(*(group[c].to_pylist() for c in ("mask", "good", "toxic", "n"))):
        for at, there in zip(counts, (1, good, toxic)):
            if there:
                at[mask] = at.get(mask, 0) + n
    part = group["part"][0].as_py()
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*((part, *r) for r in steps_of(counts, FILTERS))), _STEPS)], schema=_STEPS)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per part, order of the five filters and step. A part's group has at most 128 rows."""
    ship(docs.sparkSession)
    return failures(docs, labels).groupBy("part").applyInArrow(_audit_part, STEPS_DDL)


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


ORACLE = {
    "op13_filter_audit": r"""
with d as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
first as (select t, min(doc_id) as first_id from d group by t),
l as (select doc_id, max((quality = 1)::int) as good, max((toxic = 1)::int) as toxic from labels group by doc_id),
m as (
  select d.part, coalesce(l.good, 0) as good, coalesce(l.toxic, 0) as toxic,
    (len(words) < 50)::int + 2 * (100 * len(list_distinct(words)) < 65 * len(words))::int
    + 4 * (100 * length(regexp_replace(d.t, '[^A-Z]', '', 'g')) > 5 * length(d.t))::int
    + 8 * regexp_matches(d.t, '[#$%&*|]')::int + 16 * coalesce(d.doc_id > first.first_id, false)::int as mask
  from d join first on d.t = first.t left join l on l.doc_id = d.doc_id),
c as (select part, mask, count(*) as n, sum(good) as g, sum(toxic) as x from m group by all),
f as (select * from (values ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) t(name, bit)),
o as (
  select a.name || b.name || c.name || d.name || e.name as filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] as bits
  from f a, f b, f c, f d, f e where a.bit + b.bit + c.bit + d.bit + e.bit = 31 and a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s as (
  select filter_order, i::int as step, bits[i]::int as bit, coalesce(list_sum(bits[1:i - 1]), 0)::int as before
  from o, range(1, 6) r(i)),
r as (
  select part, filter_order, step, bit,
    sum(case when mask & (before | bit) = 0 then n else 0 end)::bigint as kept,
    sum(case when mask & bit <> 0 and mask & before = 0 then n else 0 end)::bigint as removed,
    sum(case when mask & bit <> 0 and mask & before <> 0 then n else 0 end)::bigint as redundant,
    sum(case when mask = bit then n else 0 end)::bigint as unique_fails,
    sum(case when mask & bit <> 0 and mask & before = 0 then g else 0 end)::bigint as good_lost,
    sum(case when mask & bit <> 0 and mask & before = 0 then x else 0 end)::bigint as toxic_lost
  from c, s group by all)
select part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  sum(removed) over (partition by part, bit)::bigint as shapley from r
"""
}
