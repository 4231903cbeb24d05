"""Operator 2: cross-site boilerplate lines by distinct-site spread.

Each line hash gets a HyperLogLog sketch of the sites it occurs on; sketches
of map tasks merge in the aggregation.  Lines whose estimate lies near the
threshold get an exact distinct count; the others are decided by the sketch.
The lines that pass are counted again, exactly, with one site a group of
copies: copies of one text do not make its own lines boilerplate.  Every line
that passes both is cut, however much of a text that is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

MIN_SITES = 10
LG_K = 12
#: Half-width of the exact band, in standard errors of the sketch.
BAND_ERRORS = 5


def text_digest(text: Column) -> Column:
    """What the texts of ``remove_boilerplate`` and their groups of copies are known by."""
    return F.unhex(F.md5(text.cast("binary")))


# Fixed value: white space at a line's ends, by which the same line differs from file to file
BLANKS = " \t\r\x0b\x0c"


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(BLANKS))


def _line_hash(line: Column) -> Column:
    return F.unhex(F.md5(_trimmed(line).cast("binary")))


def boilerplate_lines(lines: DataFrame, min_sites: int = MIN_SITES, lg_k: int = LG_K) -> DataFrame:
    """The hashes of ``lines`` (hash, site) that occur on at least ``min_sites`` sites.

    The hot line is one small sketch a map task before the shuffle.  Estimates
    within ``BAND_ERRORS`` standard errors of the threshold (one site at
    least) are counted exactly from the distinct pairs of those lines, which
    are made distinct before lines meet, so a hot line is a row a site there.
    """
    band = max(1.0, BAND_ERRORS * 1.04 / 2 ** (lg_k / 2) * min_sites)
    spread = lines.groupBy("hash").agg(F.hll_sketch_agg("site", lg_k).alias("sketch"))
    spread = spread.select("hash", F.hll_sketch_estimate("sketch").alias("sites")).where(F.col("sites") >= min_sites - band)
    spread = written(spread, "line_spread")
    near = spread.where(F.col("sites") <= min_sites + band).select("hash")
    pairs = lines.groupBy("hash", "site").agg(F.count(F.lit(1)).alias("rows")).select("hash", "site")
    exact = pairs.join(near, "hash", "left_semi").groupBy("hash").count()
    return spread.where(F.col("sites") > min_sites + band).select("hash").union(exact.where(F.col("count") >= min_sites).select("hash"))


def group_sites(texts: DataFrame, copies: DataFrame) -> DataFrame:
    """(digest, site) from texts (digest, site) and their groups (digest, component): one site for all texts of a group.

    Of a group's sites it is the one with the fewest groups (then the first by
    name), so that a site that copies from all others does not stand for them.
    """
    pairs = written(texts.distinct().join(copies, "digest").select("component", "site").distinct(), "group_sites")
    sizes = written(pairs.groupBy("site").agg(F.count(F.lit(1)).alias("groups")), "site_sizes")
    chosen = pairs.join(sizes, "site").groupBy("component").agg(F.min(F.struct("groups", "site")).alias("least"))
    chosen = written(chosen.select("component", "least.site"), "chosen_sites")
    return written(copies.join(chosen, "component").select("digest", "site"), "text_sites")


def remove_boilerplate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source",
                       min_sites: int = MIN_SITES, lg_k: int = LG_K,
                       count_col: str = "lines_removed", copies: DataFrame | None = None) -> DataFrame:
    """``docs`` with cross-site boilerplate lines cut out of the text, and the number of lines cut.

    A line is a piece between newlines, compared without white space at its
    ends; blank lines are never cut.  ``copies`` (digest, component) are groups
    of copies, each counting as one site (a text under no component counts by
    none); without them the rows of one text are such a group.  Every line
    that is on ``min_sites`` sites then is cut.

    Rows and columns stay as they are (a column named ``count_col`` is
    replaced); a null text stays null, an empty one empty, a null site counts as
    one site of its own.  Very long texts are cut whole, inside their row.
    Rows that repeat id and text are treated alike, and an empty table stays
    empty.
    """
    digest, site = text_digest(F.col(text_col)), F.coalesce(F.col(site_col).cast("string"), F.lit(""))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).alias("id"), digest.alias("digest"))
    lines = docs.select(F.col(id_col).alias("id"), digest.alias("digest"), site.alias("site"),
                        F.posexplode(F.split(F.col(text_col), "\n", -1)).alias("number", "line"))
    lines = lines.where(_trimmed(F.col("line")) != "").select("id", "digest", "site", "number", _line_hash(F.col("line")).alias("hash"))
    flagged = written(boilerplate_lines(lines.select("hash", "site"), min_sites, lg_k), "boilerplate")
    hits = lines.select("id", "digest", "number", "hash").join(flagged, "hash", "left_semi")
    hits = written(hits, "shared_lines")
    # only texts that hold such a line count, and null texts have none; a text's many copies are a row a site before the join
    sited = docs.select(digest.alias("digest"), site.alias("site")).distinct()
    texts = written(sited.join(hits.select("digest").distinct(), "digest", "left_semi"), "text_sites")
    groups = copies.select("digest", "component").distinct() if copies is not None else texts.select("digest", F.col("digest").alias("component")).distinct()
    sites = group_sites(texts, written(groups.where("digest is not null"), "copies"))
    spread = hits.select("hash", "digest").distinct().join(sites, "digest").groupBy("hash", "site").agg(F.count(F.lit(1)).alias("rows"))
    spread = spread.groupBy("hash").count().where(F.col("count") >= min_sites).select("hash")
    hits = hits.join(written(spread, "boilerplate"), "hash", "left_semi")
    cut = hits.groupBy("id", "digest").agg(F.collect_set("number").alias("numbers"))
    cut = written(cut, "cut_lines").withColumnsRenamed({"id": "i", "digest": "d"})
    joined = keyed.join(cut, F.col("id").eqNullSafe(F.col("i")) & F.col("digest").eqNullSafe(F.col("d")), "left")
    text = F.col(f"row.`{text_col}`")

    def cut_out(parts: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col("numbers"))  # in order
        return F.array_join(F.transform(kept, lambda i: F.get(parts, i)), "\n")

    rest = F.get(F.transform(F.array(F.split(text, "\n", -1)), cut_out), F.lit(0))  # split once a text
    columns = [F.when(F.col("numbers").isNull(), text).otherwise(rest).alias(c) if c == text_col else F.col(f"row.`{c}`")
               for c in docs.columns if c != count_col]
    return joined.select(*columns, F.coalesce(F.size("numbers"), F.lit(0)).cast("long").alias(count_col))
