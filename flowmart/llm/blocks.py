"""Documents in blocks: a written, bucketed copy of a table in which every row belongs to a block
of a bounded number of rows.

Operators that look at every token or byte work per block: a block sends out what it found,
already combined (distinct n-grams with counts, distinct hashes), and gets the verdicts back
by block. The texts are written once; the bucketing lets later passes meet their verdicts
without shuffling the texts again. A key that occurs in a third of all rows is one entry per
block, so it is never a hot group.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowmart.llm.common import made, ship, shuffle_partitions
from flowmart.session import scratch_path

#: Rows per block (a block is what one Python task holds at a time).
BLOCK_ROWS = 2048
BLOCK = "__block"
#: A number for each row of the written table.
ROW = "__row"


def block_of(row: Column, rows: int = BLOCK_ROWS) -> Column:
    return F.shiftright(row, max(0, (rows - 1).bit_length()))


def blocked(docs: DataFrame, rows: int = BLOCK_ROWS) -> DataFrame:
    """``docs`` with columns ``__block`` and ``__row``, written to the shared folder in buckets of
    the block. ``block_of`` gives the block of a row number."""
    spark = docs.sparkSession
    ship(spark)
    path = scratch_path(spark, "blocks")
    name = f"flowmart_blocks_{uuid.uuid4().hex}"
    (
        docs.withColumn(ROW, F.monotonically_increasing_id())
        .withColumn(BLOCK, block_of(F.col(ROW), rows))
        .write.mode("error")
        .bucketBy(shuffle_partitions(spark), BLOCK)
        .option("path", path)
        .option("compression", "zstd")
        .saveAsTable(name)
    )
    made(path)
    return spark.table(name)
