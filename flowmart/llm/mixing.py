"""Mixing sources to target weights by weighted fair queueing, in DataFrame operations only.

Each source is a queue: its documents in a shuffled order that depends on ``doc_id`` alone,
served up to ``REPEATS`` times. A word's virtual finish time is the number of its source's words up
to and with it, divided by the source's target; a document finishes with its last word. Serving
all words in the order of their finish times gives every source its share at every moment.

The order is cut once, at the total budget (the whole words of all targets). Virtual time is split into
ranges of 1/``RANGES``; each document adds its words to the ranges that it is served in, and running
totals over the ranges tell where the budget is used up. Words that finish by then are taken: nearly all
documents whole or not at all, and of each source the one document that is being served is taken in
part. ``mix`` range-sorts what is taken by finish time.

The running totals within a source are taken in two levels (4,096 hash buckets per source,
then inside each bucket), so a source that holds a third of all rows is spread over as many
tasks as any other data. A source's documents follow each other without gaps, so all documents together
have at most one entry each and ``HORIZON`` ranges a source more; entries of a range are added up before
the shuffle.

Targets: the budget is shared by weight; a target stops at ``REPEATS`` times its source's
size and the excess is shared again among the others (solved in closed form over the
sources, one row each).

Edge cases: a null source is a source of its own and comes last; null and empty texts have
size 0 and nothing is taken of them; documents with equal ids follow each other; an empty
table gives an empty result; extra columns, whatever their names, are carried in ``mix``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmart.llm.common import shuffle_partitions, stage, table, words_of

WEIGHTS = (5, 2, 1)
#: Budget in tenths of all words, and how often a document may be taken.
BUDGET_TENTHS = 15
REPEATS = 2
#: A sources table of up to this many rows is small enough to broadcast; beyond it Spark decides.
SMALL_SOURCES = 2_000
#: Ranges per unit of virtual time, and the number of ranges that are told apart. The targets add up
#: to the budget, so it is used up by range ``RANGES``; words beyond the horizon share one last range.
RANGES = 1_024
HORIZON = 2 * RANGES


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) from rows of (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source from here on.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (place % len(WEIGHTS) + 1).cast("int"))
    everything = Window.partitionBy()
    w = per.withColumn("w", weight).withColumn("total", F.sum("source_size").over(everything))
    # Fullest queues first: a source is capped if, with all before it capped, its share
    # of what is left reaches its cap.
    big = lambda c: c.cast("decimal(38,0)")
    order = Window.orderBy((big(F.col("source_size")) * 1000 / F.col("w")), F.col("source").asc_nulls_last())
    w = w.withColumn("capped_before", F.coalesce(F.sum(REPEATS * F.col("source_size")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    w = w.withColumn("w_from", F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing)))
    budget10 = F.col("total") * BUDGET_TENTHS
    w = w.withColumn(
        "capped",
        big(10 * REPEATS * F.col("source_size")) * F.col("w_from") <= big(F.col("w")) * (budget10 - 10 * F.col("capped_before")),
    )
    capped_sum = F.coalesce(F.sum(F.when(F.col("capped"), REPEATS * F.col("source_size"))).over(everything), F.lit(0))
    open_w = F.sum(F.when(~F.col("capped"), F.col("w"))).over(everything)
    share = F.col("w") * (F.lit(BUDGET_TENTHS / 10) * F.col("total") - capped_sum) / open_w
    return w.select("source", "source_size", F.when(F.col("capped"), (REPEATS * F.col("source_size")).cast("double")).otherwise(share).alias("target"))


def sizes_of(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size) of every document, written once: all totals are taken from it."""
    size = F.size(words_of(F.col("text"))).cast("long").alias("size")
    return stage(docs.select("doc_id", "source", size), "mixing-sizes")


def source_key() -> Column:
    """The source without nulls, as one key of windows and joins."""
    return F.when(F.col("source").isNull(), F.lit("")).otherwise(F.concat(F.lit("="), "source")).alias("skey")


def keyed(rows: DataFrame) -> DataFrame:
    """Add ``skey``, ``key`` (the shuffled order) and ``bucket``."""
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("key")
    return rows.select("*", source_key(), key).withColumn("bucket", F.substring("key", 1, 3))


def served(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Add ``source_size``, ``target``, ``budget`` (whole words of all targets) and ``before`` (the
    source's words ahead of the document in one round) to rows of (doc_id, source, size, ...)."""
    per_bucket = keyed(sizes).groupBy("skey", "source", "bucket").agg(F.sum("size").alias("n"))
    ahead = F.sum("n").over(Window.partitionBy("skey").orderBy("bucket")) - F.col("n")  # at most 4,096 rows a source
    budget = F.sum(F.floor("target")).over(Window.partitionBy()).alias("budget")  # one row per source
    shares = targets(per_bucket.withColumnRenamed("n", "size")).select(source_key(), "source_size", "target", budget)
    starts = per_bucket.select("skey", "bucket", ahead.alias("bucket_start")).join(shares, "skey")
    starts = starts.select(F.col("skey").alias("b_skey"), F.col("bucket").alias("b_bucket"), "bucket_start", "source_size", "target", "budget")
    before = Window.partitionBy("skey", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = keyed(rows).withColumn("inside", F.sum("size").over(before) - F.col("size"))
    joined = placed.join(starts, (F.col("skey") == F.col("b_skey")) & (F.col("bucket") == F.col("b_bucket")))
    return joined.withColumn("before", F.col("bucket_start") + F.col("inside")).drop("b_skey", "b_bucket", "bucket_start", "inside", "bucket", "skey")


def range_totals(rows: DataFrame) -> DataFrame:
    """(range, words, budget): the words that finish in each range of virtual time, over all
    sources and servings, from rows of ``served``. Range i ends at i / RANGES."""
    finished = lambda i: F.floor(F.col("target") * i / RANGES)  # noqa: E731  the source's words by the end of range i
    servings = F.explode(F.array(*[F.lit(i) for i in range(REPEATS)])).alias("serving")
    items = rows.where("size > 0").select("size", "target", "budget", "before", "source_size", servings)
    items = items.withColumn("begin", F.col("before") + F.col("serving") * F.col("source_size"))
    items = items.withColumn("end", F.col("begin") + F.col("size"))
    place = lambda words: F.least(F.lit(float(HORIZON)), F.floor(words * RANGES / F.col("target"))).cast("int")
    # One range more on both sides: rounding of the quotient must not lose a word.
    first, last = F.greatest(F.lit(1), place(F.col("begin"))), F.least(F.lit(HORIZON), place(F.col("end")) + 1) + 1
    spread = items.select("target", "budget", "begin", "end", F.explode(F.sequence(first, last)).alias("range"))
    upper = F.when(F.col("range") > HORIZON, F.col("end")).otherwise(F.least(F.col("end"), finished(F.col("range"))))
    words = upper - F.greatest(F.col("begin"), finished(F.col("range") - 1))
    return spread.select("range", "budget", words.cast("long").alias("words")).where("words > 0").groupBy("range").agg(F.sum("words").alias("words"), F.max("budget").alias("budget"))


def cut(rows: DataFrame) -> float:
    """The virtual time at which the total budget is used up: the end of the last range up to which the
    running total keeps to it. One row reaches the driver."""
    running = F.sum("words").over(Window.orderBy("range"))  # at most HORIZON + 1 rows
    within = range_totals(rows).select("range", "budget", running.alias("running")).where("running <= budget")
    return (within.agg(F.max("range").alias("last")).first()["last"] or 0) / RANGES


def part(serving: int, end: float) -> Column:
    """Words taken of a document in the given serving (from 0) by the virtual time ``end``."""
    left = F.floor(F.col("target") * F.lit(end)) - serving * F.col("source_size") - F.col("before")
    return F.greatest(F.lit(0), F.least(F.col("size").cast("long"), left)).cast("long")


def shares_taken(docs: DataFrame) -> DataFrame:
    """Per document: its size, its source's size and target, and the words the mix takes."""
    sizes = sizes_of(docs)
    rows = stage(served(sizes, sizes).select("doc_id", "size", "source_size", "target", "budget", "before"), "mixing-served")
    end = cut(rows)
    taken = sum((part(i, end) for i in range(1, REPEATS)), part(0, end))
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


def _with_text(docs: DataFrame, text: Column) -> Column:
    row = F.col("row").withField("text", text)
    if "n_chars" in docs.columns:
        whole = F.col("s.words") == F.col("size")
        row = row.withField("n_chars", F.when(whole, F.col("row.n_chars")).otherwise(F.length(text)).cast(docs.schema["n_chars"].dataType))
    return row


def mix(docs: DataFrame) -> DataFrame:
    """The mixed documents (all columns of ``docs``), globally sorted by virtual finish time. A
    document taken twice is there twice; one that the cut falls into ends with the last word
    that is taken (and ``n_chars``, if there, with it)."""
    sizes = sizes_of(docs)
    end = cut(served(sizes, sizes))
    rows = docs.select("doc_id", "source", F.size(words_of(F.col("text"))).cast("long").alias("size"), F.struct("*").alias("row"))
    serving = F.explode(F.array(*[F.struct(F.lit(i).alias("serving"), part(i, end).alias("words")) for i in range(REPEATS)])).alias("s")
    items = served(rows, sizes).select("row", "key", "doc_id", "size", "before", "source_size", "target", serving).where("s.words > 0")
    finish = (F.col("before") + F.col("size") + F.col("s.serving") * F.col("source_size")) / F.col("target")
    # The first words with the white space between them: cut in front of each word.
    pieces = F.split(F.col("row.text"), r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])")
    blank_first = F.when(F.col("row.text").rlike(r"^[\x20\x09-\x0D]"), 1).otherwise(0)
    start = F.rtrim(F.array_join(F.slice(pieces, F.lit(1), (F.col("s.words") + blank_first).cast("int")), ""))
    text = F.when(F.col("s.words") == F.col("size"), F.col("row.text")).otherwise(start)
    out = items.select(finish.alias("finish"), "key", "doc_id", F.col("s.serving").alias("serving"), _with_text(docs, text).alias("row"))
    out = out.repartitionByRange(shuffle_partitions(docs.sparkSession), "finish", "key").sortWithinPartitions("finish", "key", "doc_id", "serving")
    return out.select("row.*")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shares_taken(table(spark, sf_dir, "documents"))


ORACLE = {
    "op3_mixing": r"""
with d as (
  select doc_id, source, md5(coalesce(doc_id::varchar, '')) as key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, [5, 2, 1][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int] as w, sum(source_size) over () as total from s),
c as (
  select *, coalesce(sum(2 * source_size) over o1, 0) as capped_before, sum(w) over o2 as w_from from w
  window o1 as (order by source_size::double / w, source nulls last rows between unbounded preceding and 1 preceding),
         o2 as (order by source_size::double / w, source nulls last rows between current row and unbounded following)),
k as (select *, 20 * source_size * w_from <= w * (15 * total - 10 * capped_before) as capped from c),
t as (
  select source, source_size, case when capped then (2 * source_size)::double
    else w * (1.5::double * total - coalesce(sum(case when capped then 2 * source_size end) over (), 0)) / sum(case when not capped then w end) over () end as target
  from k),
q as (
  select d.doc_id, d.size, t.source_size, t.target,
         coalesce(sum(d.size) over (partition by d.source order by d.key, d.doc_id, d.size rows between unbounded preceding and 1 preceding), 0) as before
  from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target,
       (greatest(0, least(size, floor(target) - before)) + greatest(0, least(size, floor(target) - source_size - before)))::bigint as taken
from q
"""
}
