"""Shared building blocks: best row per key, surrogate ids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursewise.operators.skew import with_range


def top_n_per_key(df: DataFrame, keys: list[str], order: list[Column], n: int = 1,
                  rank_col: str | None = None) -> DataFrame:
    """The first ``n`` rows per key under a total order.

    ``row_number() <= n`` is planned as WindowGroupLimit: a partial limit runs
    before the shuffle, so even a key holding a third of the rows reaches the
    exchange as at most ``n`` rows per map task.  That needs a shuffle to be
    there: take the limit before a join on the same keys, not after it.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    rn = rank_col or "__rn"
    out = df.withColumn(rn, F.row_number().over(w)).filter(F.col(rn) <= n)
    return out if rank_col else out.drop(rn)


def best_row(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key: the first under ``order`` (write the NULL order out)."""
    return top_n_per_key(df, keys, order, 1)


def sequential_ids(df: DataFrame, order_col: str, id_col: str, within: list[str] | None = None) -> DataFrame:
    """Ids 1..n in ascending byte order of a text column over a DISTINCT set (W2), per ``within`` group, NULL last.

    The order is cut into balanced ranges (``skew.with_range``), values are
    numbered within their range, and a range adds the number of values in the
    ranges before it: however alike values are, no task numbers all of them.
    The offsets are one row a range.
    """
    keys = within or []
    rows = with_range(df.withColumn("__last", F.col(order_col).isNull()), [*keys, "__last", order_col], "__range")
    rows = rows.withColumn("__rank", F.row_number().over(
        Window.partitionBy(*keys, "__range").orderBy(F.col(order_col).asc_nulls_last())))
    counts = rows.groupBy(*keys, "__range").agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "__range", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__before"))
    return (rows.join(offsets, [*keys, "__range"])
                .withColumn(id_col, (F.col("__before") + F.col("__rank")).cast("bigint"))
                .drop("__range", "__rank", "__before", "__last"))


def to_output(df: DataFrame) -> DataFrame:
    """Normalise result types: decimals -> double, small ints -> bigint."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.FloatType):
            c = c.cast("double")
        cols.append(c.alias(f.name))
    return df.select(*cols)
