"""Data-quality checks (V1-V5): each returns the offending keys or counts as a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def check_unique(df: DataFrame, cols: list[str]) -> DataFrame:
    """V1: keys that occur more than once, with their row count."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_rows")).filter(F.col("n_rows") > 1)


def check_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """V2: NULL count per column, one aggregate pass, one row per column."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.unpivot([], cols, "column_name", "null_count")


def check_relationship(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """V3: child keys missing from the parent, with the number of child rows (anti join)."""
    pk = parent.select(F.col(parent_key or key).alias(key)).distinct()
    orphans = child.filter(F.col(key).isNotNull()).join(pk, key, "left_anti")
    return orphans.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"))


def check_accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    """V4: values outside the accepted set, with their row count (NULL is not flagged)."""
    return (df.filter(F.col(col).isNotNull() & ~F.col(col).isin(*values))
              .groupBy(col).agg(F.count(F.lit(1)).alias("n_rows")))


def cast_rejects(df: DataFrame, typed: dict[str, tuple[str, object]]) -> DataFrame:
    """V5: per column, rows whose raw text is present but the typed value is NULL.

    ``typed`` maps an output name to (raw column, typed Column).  Blank text
    is treated as missing, not as a reject.
    """
    aggs = []
    for name, (raw, value) in typed.items():
        present = F.col(raw).isNotNull() & (F.trim(F.col(raw).cast("string")) != "")
        aggs.append(F.count_if(present & value.isNull()).alias(name))
    return df.agg(*aggs).unpivot([], list(typed), "column_name", "rejects")
