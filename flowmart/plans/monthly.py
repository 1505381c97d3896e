"""Derived tables that are stored by month, each month in the folder of the version that wrote it.

Writing some months puts them into a new version's folder and switches to it; the files of all
other months stay where they are. What a write replaced is removed with the next write, so that
a query that was planned just before still finds its files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowmart.operators import commits

MONTH = "year_month"


class MonthlyTable:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.schema: T.StructType | None = None
        self.months: dict[str, int] = {}
        self.version = 0
        self.replaced: list[str] = []

    def _folder(self, month: str, version: int) -> str:
        return f"{self.path}/version={version}/{MONTH}={month}"

    def write(self, df: DataFrame, months: list[str] | None = None) -> None:
        """Replace ``months`` (None: all) by the rows of ``df``, which has no others; a month without
        rows goes."""
        for folder in self.replaced:
            commits.remove(self.spark, folder)
        self.version += 1
        folder = f"{self.path}/version={self.version}"
        df.write.partitionBy(MONTH).parquet(folder)
        written = [n.split("=", 1)[1] for n in commits.children(self.spark, folder) if n.startswith(f"{MONTH}=")]
        gone = list(self.months) if months is None else [x for x in months if x in self.months]
        self.replaced = [self._folder(x, self.months[x]) for x in gone]
        self.months = {**{k: v for k, v in self.months.items() if k not in gone}, **{x: self.version for x in written}}
        self.schema = T.StructType([f for f in df.schema.fields if f.name != MONTH] + [T.StructField(MONTH, T.StringType())])

    def read(self, months: list[str] | None = None) -> DataFrame:
        folders = [self._folder(k, v) for k, v in sorted(self.months.items()) if months is None or k in months]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        df = self.spark.read.schema(self.schema).option("basePath", self.path).parquet(*folders)
        return df.select(*self.schema.names)


def month_of(epoch: str) -> F.Column:
    return F.date_format(F.timestamp_seconds(F.col(epoch)), "yyyy-MM")
