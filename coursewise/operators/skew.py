"""Operations on keys of which a few may hold most of the rows: balanced ranges and lookups.

Everything here is lazy.  What has to be known about the data (where to cut it,
which keys are heavy) is a scalar subquery of bounded size, the same whenever
it is asked again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Ranges that an order is cut into at most; what has to be known about each range is one row.
MAX_RANGES = 1 << 14
#: Keys that the frequency sketch follows, and how many of them can be called heavy.
SKETCH_ITEMS, HEAVY_KEYS = 10_000, 1000
#: Salts for a partition's worth of rows of a heavy key: several, as salts fall on partitions by chance.
FINE = 8
#: Column that, with the key, says where a row lies after ``placed``.
PLACE = "__place"


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def with_range(df: DataFrame, by: list[str], out: str, ranges: int | None = None) -> DataFrame:
    """Add ``out``: the number of the range that a row falls in, in ascending order of ``by`` (nulls first).

    Ranges hold about equally many rows, whatever values are frequent or alike:
    they are cut at the rows with the smallest hashes, a sample that depends on
    the rows only.  Rows that are equal in ``by`` share a range, and whole rows
    that repeat are drawn together: it is meant for rows that mostly differ.
    """
    ranges = min(ranges or 4 * _partitions(df), MAX_RANGES)
    key = F.struct(*(F.col(c) for c in by))
    cuts = (df.select(key.alias("k"), F.xxhash64(*df.columns).alias("h")).orderBy("h", "k").limit(ranges - 1)
              .agg(F.array_sort(F.collect_set("k")).alias("cuts")))
    # how many cuts are not above the row, by halving: 2^14, 2^13, ... are added as long as the cut there is not above
    steps = F.array(*(F.lit(1 << b) for b in range((ranges - 1).bit_length() - 1, -1, -1)))
    rows = df.withColumn("__cuts", cuts.scalar()).withColumn("__key", key)

    def step(at: Column, size: Column) -> Column:
        there = (at + size <= F.size("__cuts")) & (F.try_element_at("__cuts", at + size) <= F.col("__key"))
        return F.when(there, at + size).otherwise(at)

    return rows.withColumn(out, F.aggregate(steps, F.lit(0), step)).drop("__cuts", "__key")


def lag_in_range(df: DataFrame, keys: list[str], time: str, value: str, out: str, ranges: int | None = None) -> DataFrame:
    """Add ``out``: the ``value`` of the row before in time order among rows with the same ``keys`` (nulls first).

    The order by keys and time is cut into balanced ranges, so a key with most
    of the rows is spread over many tasks.  Within a range it is a plain lag;
    the first row of a range takes the last value of the range before, from a
    table of one row a range, if that row has its keys.
    """
    rows = with_range(df, [*keys, time], "__range", ranges)
    key, order = F.struct(*(F.col(c) for c in keys)), [F.col(c).asc_nulls_first() for c in (*keys, time, value)]
    row = F.struct(key.alias("k"), F.col(value).alias("v"))
    before = F.lag(row).over(Window.partitionBy("__range").orderBy(*order))
    place = F.struct(*(F.col(c) for c in (*keys, time, value)))
    ends = rows.groupBy("__range").agg(F.max_by(row, place).alias("__end"))
    ends = ends.select("__range", F.lag("__end").over(Window.orderBy("__range")).alias("__end"))
    found = F.coalesce(F.col("__before"), F.col("__end"))
    return (rows.withColumn("__before", before).join(ends, "__range", "left")
                .withColumn(out, F.when(found["k"].eqNullSafe(key), found["v"])).drop("__range", "__before", "__end"))


def lookup_join(rows: DataFrame, lookup: DataFrame, key: str, how: str = "left") -> DataFrame:
    """``rows`` with the columns of ``lookup`` (one row a key), however many rows a key has.

    Keys with more rows than a partition should hold are found by a frequency
    sketch.  Their rows are dealt out over as many salts as that takes, and
    only their lookup rows are repeated once a salt; rows without a key are
    dealt out too.  All other keys join as they are.
    """
    heavy, parts = _heavy_salts(rows, key), _partitions(rows)
    salts = F.coalesce(F.try_element_at("__heavy", F.col(key)), F.lit(1))
    any_row = F.xxhash64(*rows.columns)
    salted = rows.withColumn("__heavy", heavy.scalar()).withColumn("__salt", F.pmod(any_row, F.when(F.col(key).isNull(), F.lit(parts * FINE)).otherwise(salts)).cast("int"))
    spread = lookup.withColumn("__heavy", heavy.scalar()).withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    return salted.drop("__heavy").join(spread.drop("__heavy"), [key, "__salt"], how).drop("__salt")


def _heavy_salts(rows: DataFrame, key: str) -> DataFrame:
    """One row ``salts``: for each key with more rows than a partition should hold, how many salts they are dealt out over."""
    sketch = rows.agg(F.count(key).alias("n"), F.expr(f"approx_top_k(`{key}`, {HEAVY_KEYS}, {SKETCH_ITEMS})").alias("top"))
    share = F.floor(F.lit(_partitions(rows)) * F.col("x.count") / F.col("n")).cast("int") * FINE
    heavy = sketch.select("n", F.explode("top").alias("x")).select(F.col("x.item").alias("item"), share.alias("salts")).filter("salts >= 1 AND item IS NOT NULL")
    return heavy.agg(F.map_from_entries(F.collect_list(F.struct("item", "salts"))).alias("salts"))


def placed(rows: DataFrame, key: str, within: list[str], seen: DataFrame | None = None) -> DataFrame:
    """``rows`` shuffled once so that those of a key lie together, with ``PLACE``: later steps by key need no other shuffle.

    Rows of a heavy key, and rows without one, are dealt out by ``within``:
    rows that share both lie together always.  A window by key, ``PLACE`` and
    ``within`` stays where the rows are, and a best row by key leaves one row
    a key (a few for a heavy one) before it shuffles.  ``seen`` gives the rows
    that heavy keys are looked for in, if ``rows`` are costly to read twice.
    The partitions are as many as set, never fewer: rows get wider after this.
    """
    heavy = _heavy_salts(rows if seen is None else seen, key)
    salts = F.when(F.col(key).isNull(), F.lit(_partitions(rows) * FINE)).otherwise(F.coalesce(F.try_element_at("__heavy", F.col(key)), F.lit(1)))
    at = F.pmod(F.xxhash64(*within), salts).cast("int")
    return rows.withColumn("__heavy", heavy.scalar()).withColumn(PLACE, at).drop("__heavy").repartition(_partitions(rows), key, PLACE)


def placed_join(rows: DataFrame, lookup: DataFrame, key: str, within: list[str], seen: DataFrame | None = None) -> DataFrame:
    """Inner join on ``key`` that leaves the rows ``placed``; the lookup rows of a heavy key are repeated once a place."""
    heavy = _heavy_salts(rows if seen is None else seen, key)
    places = F.sequence(F.lit(0), F.coalesce(F.try_element_at("__heavy", F.col(key)), F.lit(1)) - 1)
    spread = lookup.withColumn("__heavy", heavy.scalar()).withColumn(PLACE, F.explode(places)).drop("__heavy")
    return placed(rows, key, within, seen).join(spread, [key, PLACE])
