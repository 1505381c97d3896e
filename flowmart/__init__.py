"""flowmart: a network-flow security data mart written as lazy PySpark DataFrame functions.

Layout
------
sources/    staging readers (CSV, raw lines, the test-table adapter) and the staging schema
functions/  column expressions (classifications, calendar attributes, safe ratios)
operators/  dimension, fact, rollup, quality and sink builders (``f(df, ...) -> DataFrame``)
plans/      the materialised mart and the analytic queries on top of it
streaming/  the incremental hourly rollup (Structured Streaming)
"""

__all__ = ["__version__"]

__version__ = "0.1.0"
