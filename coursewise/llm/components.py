"""Connected components of a link table by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(links: DataFrame, large: bool) -> DataFrame:
    """One star round over (a, b) links with a > b: neighbours move to the smallest node around a centre.

    The smallest neighbour is a partial aggregate, so a centre with many
    links is not gathered in one place; joining it back is a plain equi-join.
    """
    around = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        around = around.union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = around.groupBy("u").agg(F.min("v").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    joined = around.join(least, "u")
    if large:
        moved = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        moved = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).union(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    return moved.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link, root being the smallest node it can reach.

    ``links`` has two columns of one orderable type.  Direction, repeats,
    self-links and links with a null do not matter; no links give no rows.
    Rounds grow with the logarithm of the longest chain; each is written to
    the shared folder, and only a count and a checksum reach the driver.
    """
    a, b = (F.col(c) for c in links.columns)
    now = written(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a > b").distinct(), "links")
    state = None
    while True:
        now = written(_star(_star(now, True), False), "stars")
        got = now.agg(F.count(F.lit(1)), F.sum(F.hash("a", "b").cast("long"))).first()
        if got == state or not got[0]:
            break
        state = got
    roots = now.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return roots.union(roots.select(F.col("root").alias("node"), "root").distinct())
