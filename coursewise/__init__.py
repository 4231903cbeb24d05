"""coursewise: course-market analytics as Spark DataFrame operators.

Layers
------
sources/    readers, writers, file routing, load ledger           (S1-S15)
operators/  cleaning, page extraction, staging, marts, serving,
            data-quality checks, trends                             (C, E, D, F, G, V, H)
functions/  column-expression helpers (dates, prices, tiers, keys,
            display formatting)                                     (X1-X19)
plans/      driver-table fixtures, the model build, query registry
streaming/  incremental file loading and the price-alert feed       (S10, G35)

Every operator is ``DataFrame -> DataFrame``; work runs in Spark.
"""

__all__ = ["session"]
