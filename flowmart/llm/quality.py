"""Quality rules: fixed base rules, and robust multivariate outliers per language and source, in
DataFrame operations only.

Each document has a vector of transformed statistics: log words, log mean word length, log
symbols per word, share of words equal to the one before, share of lines that repeat another.
(Windows that occur again are the base rules' matter: clean documents have up to the 30 %
allowed there.) Per (lang, source) the location and scatter
are estimated by the minimum covariance determinant: from two starts (median with MAD, and
all rows) concentration steps refit mean and covariance to the 75 % of rows that are nearest by
Mahalanobis distance, and the start with the smaller determinant stays. Documents farther
than ``MAX_DISTANCE2`` from their group's centre are rejected.

Scale: the statistics are computed once, in the scan, and staged (a few numbers per
document). Quantiles are exact counts over fine bins, moments are sums; both are
partially aggregated before the shuffle, so a hot source costs no more than another. Each
group's estimate is shrunk towards the pooled one with ``PRIOR_ROWS`` pseudo-rows and has a
floor on each deviation, which gives every group, however small or uniform, a regular matrix.

Edge cases: null and empty texts have no words and fail the base rules; documents that fail
them take no part in the fit; null languages or sources are groups of their own; repeated
rows are judged alike; an empty table gives an empty result; extra columns are ignored by the
statistics and kept by ``keep_good``.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmart.llm.blocks import BLOCK, ROW, blocked
from flowmart.llm.common import WS, stage, table, words_of

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8

#: Vector components and the least standard deviation that each is given: small enough that each
#: alone can pass MAX_DISTANCE2 within its range.
FLOORS = {"x_length": 0.8, "x_word": 0.06, "x_symbol": 0.05, "x_run": 0.02, "x_lines": 0.08}
#: Share of a group's rows that the estimate is fitted to, and the factor that makes the scatter
#: of that share consistent for normal data in five dimensions.
SUBSET = 0.75
CONSISTENCY = 1.412
C_STEPS = 2
PRIOR_ROWS = 20
#: Squared distance beyond which a document is rejected: a chance of 1.5e-8 for normal data.
MAX_DISTANCE2 = 45.0

X = list(FLOORS)
PAIRS = list(itertools.combinations_with_replacement(range(len(X)), 2))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeat_words() -> Column:
    """Words of column ``words`` inside windows that occur at least twice in it."""
    n = F.size("words")
    windows = F.transform(
        F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*[F.get("hashes", i + k) for k in range(WINDOW)])
    )

    def count(w: Column) -> Column:
        placed = F.array_sort(F.transform(w, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def covered(s: Column) -> Column:
            again = F.filter(
                s, lambda e, k: F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False)) | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False))
            )
            starts = F.array_sort(F.transform(again, lambda e: e["i"]))
            return _let(
                starts,
                lambda p: F.aggregate(
                    F.transform(p, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - at, F.lit(WINDOW)))), F.lit(0), lambda a, b: a + b
                ),
            )

        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_let(placed, covered))

    return F.when(n < WINDOW, F.lit(0)).otherwise(_let(windows, count))


def statistics(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """Per document: the base statistics, ``base_failed`` and the vector, with doc_id, lang, source and
    the columns in ``carry``."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", "source", *carry, text.alias("text"), words_of(F.col("text")).alias("words"))
    rows = rows.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike("[^" + WS[1:]))
    rows = rows.select(
        "doc_id",
        "lang",
        "source",
        *carry,
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        (F.length("text") - F.length(F.regexp_replace("text", r"[#*$%&|<>]", ""))).cast("long").alias("n_symbols"),
        _let(lines, lambda a: F.struct(F.size(a).alias("all"), (F.size(a) - F.size(F.array_distinct(a))).alias("dup"))).alias("lines"),
        F.size(F.filter("hashes", lambda h, i: h == F.get("hashes", i - 1))).alias("n_run_words"),
        _repeat_words().cast("long").alias("n_repeat_words"),
    )
    rows = rows.withColumn("n_dup_lines", F.col("lines.dup").cast("long"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    words = F.greatest(F.col("n_words"), F.lit(1))
    return rows.select(
        "*",
        failed.alias("base_failed"),
        F.log1p("n_words").alias("x_length"),
        F.log1p(F.col("word_chars") / words).alias("x_word"),
        F.log1p(F.col("n_symbols") / words).alias("x_symbol"),
        (F.col("n_run_words") / words).alias("x_run"),
        (F.col("n_dup_lines") / F.greatest(F.col("lines.all"), F.lit(1))).alias("x_lines"),
        F.to_json(F.struct("lang", "source")).alias("g"),
    )


def _quantile(rows: DataFrame, keys: list[str], value: Column, share: float, per_unit: int = 1000) -> DataFrame:
    """(keys, q): the quantile of ``value`` per group, as the upper edge of a bin of width
    1 / ``per_unit``; counted exactly, whatever the order of the rows."""
    bins = rows.groupBy(*keys, F.floor(value * per_unit).alias("bin")).agg(F.count("*").alias("n"))
    w = Window.partitionBy(*keys)
    run = bins.withColumn("to", F.sum("n").over(w.orderBy("bin"))).withColumn("all", F.sum("n").over(w))
    return run.where(F.col("to") >= share * F.col("all")).groupBy(*keys).agg(((F.min("bin") + 1) / per_unit).alias("q"))


def _distance2(rows: DataFrame) -> Column:
    """Squared Mahalanobis distance of rows that carry their group's centre (m0..) and the
    Cholesky factor (l00, l10, ...) of its scatter."""
    y: list[Column] = []
    for i in range(len(X)):
        rest = F.col(X[i]) - F.col(f"m{i}")
        for j in range(i):
            rest = rest - F.col(f"l{i}{j}") * y[j]
        y.append(rest / F.col(f"l{i}{i}"))
    return sum((v * v for v in y[1:]), y[0] * y[0])


def _fit(near: DataFrame) -> DataFrame:
    """(g, start, m.., l.., logdet) from the rows that the estimate of each group is fitted to."""
    sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(X)] + [F.sum(F.col(X[i]) * F.col(X[j])).alias(f"s{i}{j}") for i, j in PAIRS]
    per = near.groupBy("g", "start").agg(F.count("*").alias("h"), *sums)
    every = Window.partitionBy("start")  # one row per group
    names = ["h", *[f"s{i}" for i in range(len(X))], *[f"s{i}{j}" for i, j in PAIRS]]
    per = per.select("*", *[F.sum(c).over(every).alias(f"a_{c}") for c in names])
    n = F.col("h") + PRIOR_ROWS
    mean = lambda p, i: F.col(f"{p}s{i}") / F.col(f"{p}h")
    cov = lambda p, i, j: F.col(f"{p}s{i}{j}") / F.col(f"{p}h") - mean(p, i) * mean(p, j)
    floors = list(FLOORS.values())
    centre = [((F.col("h") * mean("", i) + PRIOR_ROWS * mean("a_", i)) / n).alias(f"m{i}") for i in range(len(X))]
    scatter = [
        (CONSISTENCY * (F.col("h") * cov("", i, j) + PRIOR_ROWS * cov("a_", i, j)) / n + (floors[i] ** 2 if i == j else 0.0)).alias(f"c{i}{j}") for i, j in PAIRS
    ]
    per = per.select("g", "start", *centre, *scatter)
    low: dict[tuple[int, int], Column] = {}
    for j in range(len(X)):
        for i in range(j, len(X)):
            rest = F.col(f"c{j}{i}")
            for k in range(j):
                rest = rest - low[i, k] * low[j, k]
            low[i, j] = F.sqrt(F.greatest(rest, F.lit(floors[i] ** 2 * 1e-3))) if i == j else rest / low[j, j]
    return per.select(
        "g",
        "start",
        *[f"m{i}" for i in range(len(X))],
        *[v.alias(f"l{i}{j}") for (i, j), v in low.items()],
        sum((F.log(low[i, i]) for i in range(1, len(X))), F.log(low[0, 0])).alias("logdet"),
    )


def estimates(stats: DataFrame) -> DataFrame:
    """(g, m.., l..): the minimum-covariance-determinant estimate of every group."""
    fit_rows = stats.where(~F.col("base_failed")).select("g", *X)
    long = fit_rows.select("g", F.posexplode(F.array(*X)).alias("i", "x"))
    median = _quantile(long, ["g", "i"], F.col("x"), 0.5).withColumnRenamed("q", "median")
    spread = _quantile(long.join(median, ["g", "i"]), ["g", "i"], F.abs(F.col("x") - F.col("median")), 0.5)
    robust = median.join(spread, ["g", "i"]).groupBy("g").agg(
        *[F.max(F.when(F.col("i") == i, F.col("median"))).alias(f"med{i}") for i in range(len(X))],
        *[F.max(F.when(F.col("i") == i, 1.4826 * F.col("q"))).alias(f"mad{i}") for i in range(len(X))],
    )
    scaled = [((F.col(x) - F.col(f"med{i}")) / F.greatest(F.col(f"mad{i}"), F.lit(FLOORS[x]))) for i, x in enumerate(X)]
    first = fit_rows.join(stage(robust, "quality-medians"), "g").select("g", *X, sum((s * s for s in scaled[1:]), scaled[0] * scaled[0]).alias("d2"))
    starts = F.explode(F.array(*[F.struct(F.lit(k).alias("start"), d.alias("d2")) for k, d in ((0, F.col("d2")), (1, F.lit(0.0)))])).alias("s")
    ranked = first.select("g", *X, starts).select("g", *X, "s.*")
    fit = None
    for _ in range(C_STEPS + 1):
        limit = _quantile(ranked, ["g", "start"], F.log1p("d2"), SUBSET)
        near = ranked.join(limit, ["g", "start"]).where(F.log1p("d2") <= F.col("q"))
        fit = stage(_fit(near), "quality-fit")  # one row per group and start
        joined = fit_rows.join(fit, "g")
        ranked = joined.select("g", "start", *X, _distance2(joined).alias("d2"))
    cols = [c for c in fit.columns if c not in ("g", "start", "logdet")]
    return fit.groupBy("g").agg(F.min_by(F.struct(*cols), F.struct("logdet", "start")).alias("e")).select("g", "e.*")


def judge(docs: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The statistics of every document with ``distance2`` and ``kept``; ``carry``: columns of ``docs`` that
    go along."""
    stats = stage(statistics(docs, carry), "quality-stats")
    best = stage(estimates(stats), "quality-estimates")
    joined = stats.join(best, "g", "left")
    joined = joined.withColumn("distance2", _distance2(joined))
    return joined.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("distance2") <= MAX_DISTANCE2, F.lit(True)))


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the rejected rows, all columns kept.

    The rows are written once, in buckets of numbered blocks. A block gets the list of its rejected
    row numbers (a block has 2,048 rows at most), so no text is shuffled or sorted."""
    rows = blocked(docs.select(F.struct("*").alias("row")))
    rows = rows.select("row", *[F.col(f"row.{c}").alias(c) for c in ("doc_id", "lang", "source", "text")], F.col(BLOCK).alias("in_block"), F.col(ROW).alias("in_row"))
    bad = judge(rows, ("in_block", "in_row")).where(~F.col("kept")).groupBy("in_block").agg(F.collect_list("in_row").alias("bad"))
    met = rows.select("row", "in_block", "in_row").join(bad.hint("shuffle_hash"), "in_block", "left")
    return met.where(F.col("bad").isNull() | ~F.array_contains("bad", F.col("in_row"))).select("row.*")


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2"
    )
