"""Benchmark decontamination, with DataFrame operations only.

Size-partitioned MinHash containment search: an item with n distinct shingles
is contained to ``threshold`` if at most n - ceil(threshold n) of its shingles
are missing. So of its k = n - ceil(threshold n) + 1 shingles with the smallest
hashes (its bottom-k MinHash signature) at least one is in any document that
holds it, however long the document is. Items are partitioned by size (powers
of two); a partition's k is that of its largest possible item, so no item gets
too short a signature. Documents are probed with the hash of each of their
shingles; any hit makes a candidate pair, and the item's shingles are then
looked up in the document's words themselves.

Hashes of document shingles go no further than the probe table, which Spark
broadcasts while it is below its threshold and joins by a shuffle beyond it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.llm.common import Scratch


def _words(text: Column) -> Column:
    """Lower-cased words joined by single spaces."""
    return F.trim(F.regexp_replace(F.lower(text), "[ \\t-\\r]+", " "))


def _hashes(words: Column, width: int) -> Column:
    """Hash of every run of ``width`` words of an array."""
    runs = F.transform(words, lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, width)]))
    return F.slice(runs, F.lit(1), F.greatest(F.size(words) - F.lit(width - 1), F.lit(0)))


def _shingles(words: Column, width: Column) -> Column:
    last = F.size(words) - width
    return F.array_distinct(F.transform(F.sequence(F.lit(0), last), lambda i: F.array_join(F.slice(words, i + 1, width), " ")))


def signatures(items: DataFrame, width: int, threshold: float, scratch: Scratch) -> DataFrame:
    """Per distinct item: ``item_id, shingles, width, n, probes`` (the signature's hashes)."""
    words = F.split("norm", " ")
    one = items.select(F.col("item_id").cast("long").alias("item_id"), _words(F.col("text")).alias("norm")).where("norm <> ''").distinct()
    one = one.withColumn("width", F.least(F.size(words), F.lit(width))).withColumn("shingles", _shingles(words, F.col("width")))
    one = one.withColumn("n", F.size("shingles"))
    largest = F.pow(F.lit(2), F.floor(F.log2("n")) + 1) - 1  # of the size partition
    k = F.floor(F.lit(round(1 - threshold, 9)) * largest + F.lit(1e-9)).cast("int") + 1
    hashed = F.transform("shingles", lambda s: _of(s, width))
    return scratch.write(one.select("item_id", "shingles", "width", "n", F.slice(F.sort_array(hashed), F.lit(1), k).alias("probes")), "items")


def _of(shingle: Column, width: int) -> Column:
    """The hash that ``_hashes`` gives the words of a shingle."""
    parts = F.split(shingle, " ")
    return F.xxhash64(*[F.get(parts, F.lit(i)) for i in range(width)])


def contained_items(
    docs: DataFrame, items: DataFrame, width: int = 5, threshold: float = 0.8, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``doc_id, item_id, n_shingles, n_found, containment`` of every pair with containment of at least ``threshold``.

    Containment: the share of the item's distinct ``width``-word shingles that
    the document holds. An item of fewer words is one shingle, its whole
    sequence; an item without words is in no document. Null and empty texts
    hold nothing. Rows that repeat a doc_id (or an item_id) give one row for
    the pair, that of the largest containment; a null id is an id of its own.
    Other columns are not read. No documents or no items: no rows.
    """
    scratch = Scratch(docs.sparkSession, "decontam")
    sig = signatures(items, width, threshold, scratch)
    widths = sorted(r[0] for r in sig.select("width").distinct().collect())  # at most ``width`` numbers
    if not widths:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_shingles long, n_found long, containment double")
    text = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).where(F.col("text").isNotNull())
    text = text.withColumn("th", F.xxhash64("text"))
    words = F.split(_words(F.col("text")), " ")
    probes = scratch.write(sig.select(F.explode("probes").alias("h")).distinct(), "probes")
    runs = text.select("doc_id", "th", words.alias("w"))
    hits = runs.select("doc_id", "th", F.explode(F.concat(*[_hashes(F.col("w"), m) for m in widths])).alias("h")).join(probes, "h").distinct()
    pairs = hits.join(sig.select("item_id", F.explode("probes").alias("h")), "h").select("doc_id", "th", "item_id").distinct()
    pairs = scratch.write(pairs.withColumnRenamed("doc_id", "d").withColumnRenamed("th", "t"), "pairs")
    both = text.join(pairs, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("th") == F.col("t")))
    both = both.select("doc_id", F.col("item_id").alias("i"), F.concat(F.lit(" "), _words(F.col("text")), F.lit(" ")).alias("hay"))
    found = both.join(sig.drop("probes"), F.col("i").eqNullSafe(F.col("item_id"))).select(
        "doc_id",
        "item_id",
        F.col("n").cast("long").alias("n_shingles"),
        F.size(F.filter("shingles", lambda s: F.contains(F.col("hay"), F.concat(F.lit(" "), s, F.lit(" "))))).cast("long").alias("n_found"),
    )
    best = found.withColumn("containment", F.col("n_found") / F.col("n_shingles")).where(F.col("n_found") >= F.col("n_shingles") * F.lit(threshold) - F.lit(1e-9))
    return (
        best.groupBy("doc_id", "item_id")
        .agg(F.max_by(F.struct("n_shingles", "n_found", "containment"), F.struct("containment", "n_shingles")).alias("x"))
        .select("doc_id", "item_id", "x.*")
    )


def remove_contaminated(docs: DataFrame, items: DataFrame, width: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs(doc_id, text, ...)`` whose text holds no item; all columns stay. Rows with a null text stay."""
    found = contained_items(
        docs.select(F.struct("doc_id", "text").alias("s")).select(F.xxhash64("s.text").alias("doc_id"), F.col("s.text").alias("text")), items, width, threshold
    )
    # found by the text's hash: each row is judged by its own text, also where doc_ids repeat
    return docs.withColumn("__t", F.xxhash64("text")).join(found.select(F.col("doc_id").alias("__t")).distinct(), "__t", "left_anti").select(*docs.columns)
