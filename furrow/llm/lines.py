"""Line dedup by site-relative frequency, with DataFrame operations only.

For every site, the share of its pages that hold a line is taken; lines above
``ratio`` are boilerplate of that site and are dropped from its pages.

Shuffled are hashes of lines, pre-counted by task, never texts: the site's
boilerplate (a handful of hashes) is written and joined to the pages, which
Spark does by broadcast while that table is below its broadcast threshold and
by a join that splits hot sites beyond it. A site has fewer than (lines a
page) / ratio such hashes, however many pages it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import Scratch

BLANK = " \t\r\f\v"


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def _key(line: Column) -> Column:
    """A line's identity: its text without blanks at the ends, hashed; null for an empty one."""
    bare = F.btrim(line, F.lit(BLANK))
    return F.when(bare != "", F.xxhash64(bare))


def boilerplate(docs: DataFrame, scratch: Scratch, ratio: float, min_pages: int, host_col: str, text_col: str) -> DataFrame:
    """``(host, keys)``: hashes of the lines that more than ``ratio`` of a site's pages hold, in at least ``min_pages``.

    Pages of a site with equal texts count once.
    """
    keys = F.array_distinct(F.filter(F.transform(_lines(F.col(text_col)), _key), lambda h: h.isNotNull()))
    # a page's own mark (null) is counted with its lines: the number of pages of the site
    pages = (
        docs.where(F.col(text_col).isNotNull())
        .select(F.col(host_col).alias("host"), F.xxhash64(text_col).alias("a"), F.xxhash64(F.lit(1), text_col).alias("b"), keys.alias("keys"))
        .groupBy("host", "a", "b")
        .agg(F.first("keys").alias("keys"))
        .select("host", F.explode(F.array_append("keys", F.lit(None).cast("long"))).alias("h"))
    )
    counts = pages.groupBy("host", "h").agg(F.count("*").alias("n")).where(f"h IS NULL OR n >= {int(min_pages)}")
    counts = scratch.write(counts, "counts")
    total = counts.where("h IS NULL").select(F.col("host").alias("site"), F.col("n").alias("pages"))
    found = (
        counts.where("h IS NOT NULL")
        .join(total, F.col("host").eqNullSafe(F.col("site")))
        .where(F.col("n") > F.lit(ratio) * F.col("pages"))
        .groupBy("host")
        .agg(F.collect_set("h").alias("keys"))
    )
    found = scratch.write(found, "boilerplate")
    scratch.drop("counts")
    return found


def drop_boilerplate(
    docs: DataFrame, ratio: float = 0.02, min_pages: int = 5, host_col: str = "source", text_col: str = "text"
) -> DataFrame:
    """``docs`` with all its columns, its text without boilerplate lines, and ``n_lines``, ``n_dropped`` (long).

    A null host is a site of its own. A null text stays null, with 0 lines; an
    empty text is one blank line. Blank lines are neither counted nor dropped.
    Each repeated row stays. Columns of ``docs`` named n_lines or n_dropped are
    replaced. No rows in, no rows out.
    """
    scratch = Scratch(docs.sparkSession, "lines")
    found = boilerplate(docs, scratch, ratio, min_pages, host_col, text_col).toDF("__host", "__keys")
    docs = docs.drop("n_lines", "n_dropped")
    lines, keys = _lines(F.col(text_col)), F.col("__keys")
    kept = F.filter(lines, lambda x: ~F.coalesce(F.array_contains(keys, _key(x)), F.lit(False)))
    joined = docs.join(found, F.col(host_col).eqNullSafe(F.col("__host")), "left")
    return joined.withColumns(
        {"__kept": F.when(keys.isNotNull(), kept), "n_lines": F.coalesce(F.size(F.when(F.col(text_col).isNotNull(), lines)), F.lit(0)).cast("long")}
    ).select(
        *[F.when(F.col("__kept").isNotNull(), F.array_join("__kept", "\n")).otherwise(F.col(c)).alias(c) if c == text_col else F.col(c) for c in docs.columns],
        F.when(F.col(text_col).isNull(), F.lit(0)).otherwise(F.col("n_lines")).cast("long").alias("n_lines"),
        F.coalesce(F.col("n_lines") - F.size("__kept"), F.lit(0)).cast("long").alias("n_dropped"),
    )
