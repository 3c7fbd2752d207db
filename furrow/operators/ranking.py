"""Exact ranks, running sums and quantiles without pulling a group into one task.

``Window.partitionBy(g).orderBy(v)`` sends every row of a group to one task, and
``Window.orderBy(v)`` sends the whole table to one task. At scale one group may
hold a third of all rows, so instead:

1. range-partition on ``(group, order...)`` — the sampler splits a large group
   over many partitions — and sort within partitions;
2. cut lineage with a reliable checkpoint, so the partition a row landed in is
   fixed even if an executor is lost and work is recomputed;
3. count rows per ``(partition, group)`` (a table of at most
   ``#groups + #partitions`` rows) and turn the counts into offsets with a
   window over that small table;
4. rank = offset of the block + position of the row inside its partition.

Exact quantiles count equal values first, then pick the values at the needed ranks and interpolate linearly
(``lo + (h - floor(h)) * (hi - lo)`` with ``h = (n - 1) q``, the definition
pandas and DuckDB ``quantile_cont`` use).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from furrow.operators.lookups import join_lookup
from furrow.session import materialize

_POS_BITS = 33
_POS_MASK = (1 << _POS_BITS) - 1


def _cols(xs) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def _block_window(by: list[str]):
    # Runs over the per-(partition, group) block table, never over rows.
    return (Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))).orderBy("__pid")


def _range_sorted(df: DataFrame, by: list[str], order: list) -> DataFrame:
    keys = [*_cols(by), *_cols(order)]
    return materialize(df.repartitionByRange(*keys).sortWithinPartitions(*keys))


def rank_in_group(
    df: DataFrame, by: list[str], order: list, rank_col: str = "rank"
) -> DataFrame:
    """Add a 1-based ``row_number`` within ``by`` ordered by ``order``.

    ``order`` must make rows unique within a group (add a key as tie-breaker),
    otherwise tied rows get an arbitrary but consistent order.
    """
    rp = _range_sorted(df, by, order)
    mid = F.monotonically_increasing_id()
    rp = rp.withColumn("__mid", mid).select(
        "*",
        F.shiftright("__mid", _POS_BITS).alias("__pid"),
        F.col("__mid").bitwiseAND(F.lit(_POS_MASK)).alias("__pos"),
    )
    blocks = rp.groupBy("__pid", *by).agg(
        F.min("__pos").alias("__first"), F.count(F.lit(1)).alias("__n")
    )
    w = _block_window(by)
    blocks = blocks.select(
        "__pid", *by, "__first", (F.sum("__n").over(w) - F.col("__n")).alias("__offset")
    )
    out = join_lookup(rp, blocks, ["__pid", *by])
    out = out.withColumn(
        rank_col, F.col("__offset") + F.col("__pos") - F.col("__first") + F.lit(1)
    )
    return out.drop("__mid", "__pid", "__pos", "__first", "__offset")


def cumulative_sums(
    df: DataFrame, by: list[str], order: list, weights: dict[str, str], suffix: str = "_cum"
) -> DataFrame:
    """Inclusive running sums of ``weights`` within ``by`` ordered by ``order``.

    Same range-partition scheme as :func:`rank_in_group`; the in-partition part
    is a window over ``(partition, group)``, which holds at most one range
    partition of rows.
    """
    rp = _range_sorted(df, by, order).withColumn("__pid", F.spark_partition_id())
    local = (
        Window.partitionBy("__pid", *by)
        .orderBy(*_cols(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rp = rp.select("*", *[F.sum(c).over(local).alias(f"__loc_{c}") for c in weights])
    blocks = rp.groupBy("__pid", *by).agg(*[F.sum(c).alias(f"__tot_{c}") for c in weights])
    w = _block_window(by)
    blocks = blocks.select(
        "__pid",
        *by,
        *[
            F.coalesce(F.sum(f"__tot_{c}").over(w) - F.col(f"__tot_{c}"), F.lit(0)).alias(
                f"__off_{c}"
            )
            for c in weights
        ],
    )
    out = join_lookup(rp, blocks, ["__pid", *by])
    for c, name in weights.items():
        out = out.withColumn(name or f"{c}{suffix}", F.col(f"__off_{c}") + F.col(f"__loc_{c}"))
    return out.drop(
        "__pid", *[f"__loc_{c}" for c in weights], *[f"__off_{c}" for c in weights]
    )


def exact_group_quantiles(
    df: DataFrame,
    by: list[str],
    value: str,
    probs: list[float],
    names: list[str] | None = None,
    count_name: str | None = None,
    weight: str | None = None,
) -> DataFrame:
    """One row per group with exact linear-interpolated quantiles of ``value``.

    NULL and NaN values are skipped (as pandas and SQL do); a group without any
    other value has no row. ``weight``: how many rows a row stands for (a whole number).
    """
    names = names or [f"q{p}" for p in probs]
    times = F.lit(1) if weight is None else F.col(weight)
    base = df.select(*by, F.col(value).cast("double").alias("__v"), times.cast("long").alias("__t")).where(F.col("__v").isNotNull() & ~F.isnan("__v"))
    # equal values are counted first, so what is sorted is one row for each (group, value)
    cum = cumulative_sums(base.groupBy(*by, "__v").agg(F.sum("__t").alias("__w")), by, ["__v"], {"__w": "__c"})
    sizes = cum.groupBy(*by).agg(F.max("__c").alias("__n"))
    both = cum.select(*[F.col(k).alias(f"__b_{k}") for k in by], "__v", "__w", "__c")
    both = both.join(sizes, reduce(lambda a, b: a & b, [F.col(f"__b_{k}").eqNullSafe(F.col(k)) for k in by]))

    def at(rank: Column) -> Column:
        """The value that holds a 0-based rank: the running count reaches past it, without its own rows not."""
        return F.max(F.when((F.col("__c") > rank) & (F.col("__c") - F.col("__w") <= rank), F.col("__v")))

    picks = []
    for i, p in enumerate(probs):
        h = (F.col("__n") - 1).cast("double") * F.lit(float(p))
        picks += [at(F.floor(h)).alias(f"__lo{i}"), at(F.ceil(h)).alias(f"__hi{i}")]
    picked = both.groupBy(*by, "__n").agg(*picks)
    cols = list(by)
    for i, (p, name) in enumerate(zip(probs, names)):
        h = (F.col("__n") - 1).cast("double") * F.lit(float(p))
        lo, hi = F.col(f"__lo{i}"), F.col(f"__hi{i}")
        cols.append((lo + (h - F.floor(h)) * (hi - lo)).alias(name))
    if count_name:
        cols.append(F.col("__n").alias(count_name))
    return picked.select(*cols)
