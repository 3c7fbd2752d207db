"""Joining fitted lookup tables back onto rows.

Lookups come from ``groupBy(key)`` so their size is the number of distinct
keys. We never assume that is small: the lookup is materialised, its row count
checked, and only a lookup under ``max_broadcast_rows`` is broadcast. Above
the limit the join is a plain shuffle join (AQE splits skewed partitions of
the row side, so a hot key does not end up in one task).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.session import materialize

#: Default row limit for broadcasting a fitted lookup table.
MAX_BROADCAST_ROWS = 2_000_000
#: Joins whose values travel as one column afterwards.
BUNDLE = 8


def checked_broadcast(
    lookup: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, already_materialized: bool = False
) -> tuple[DataFrame, bool]:
    """Materialise ``lookup`` and return it with a broadcast hint if it is small.

    Returns ``(lookup, broadcasted)``.
    """
    if not already_materialized:
        lookup = materialize(lookup)
    n = lookup.count()
    if n <= max_rows:
        return F.broadcast(lookup), True
    return lookup, False


def is_small(lookup: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> bool:
    """Row-count check of an already materialised lookup."""
    return lookup.count() <= max_rows


def pack_and_join(df: DataFrame, lookups: list[tuple], extra: list[str] | None = None) -> DataFrame:
    """Left-join many lookups while the row travels as one struct ``__row``.

    ``lookups``: ``(name, [key columns of df], lookup, [key names of the lookup],
    value names, small)``; ``small``: its size was checked and it is broadcast.
    The result has ``__row`` and, for each lookup, a struct ``name`` of its
    values (NULL without a match). NULL keys match NULL keys. All keys travel in one
    column too, and so do the values of every ``BUNDLE`` joins. Each of n joins then copies some
    n / BUNDLE + BUNDLE fields a row, not the whole width and all keys; expand the result with ``select("__row.*", ...)``.
    """
    if not lookups:
        return df.select(F.struct(*[F.col(c) for c in df.columns]).alias("__row"))
    keys = [c.alias(f"k{i}_{j}") for i, (_, cols, *_) in enumerate(lookups) for j, c in enumerate(cols)]
    # in an array of one, read by element_at, as the optimizer would make a column of each field of a struct
    out = df.select(F.struct(*[F.col(c) for c in df.columns]).alias("__row"), F.array(F.struct(*keys)).alias("__keys"))
    held: list[str] = []
    where: dict[str, Column] = {}
    for i, (name, cols, lookup, by, values, small) in enumerate(lookups):
        if len(held) == BUNDLE:
            bundle = f"__b{i}"
            out = out.select(*[c for c in out.columns if c not in held], F.struct(*held).alias(bundle))
            where |= {x: F.col(bundle)[x].alias(x) for x in held}
            held = []
        held.append(name)
        side = lookup.select(*[F.col(k).alias(f"__l{i}_{j}") for j, k in enumerate(by)],
                             F.struct(*[F.col(v) for v in values]).alias(name))
        cond = [F.element_at("__keys", 1)[f"k{i}_{j}"].eqNullSafe(F.col(f"__l{i}_{j}")) for j in range(len(by))]
        out = out.join(F.broadcast(side) if small else side, reduce(lambda a, b: a & b, cond), "left")
    return out.select("__row", *[where.get(name, F.col(name)) for name, *_ in lookups])


def join_lookup(
    df: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    null_safe: bool = True,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    already_materialized: bool = False,
    known_small: bool | None = None,
) -> DataFrame:
    """Left-join ``lookup`` on ``keys``; null keys match null keys when
    ``null_safe`` (pandas ``merge`` on a ``dropna=False`` group-by does).

    ``known_small`` skips the count when the caller already checked the size
    (``True``: broadcast, ``False``: shuffle join). The key columns of the
    result are the row side's.
    """
    if known_small is None:
        small, _ = checked_broadcast(lookup, max_broadcast_rows, already_materialized)
    else:
        small = F.broadcast(lookup) if known_small else lookup
    renamed = small.select(
        *[F.col(k).alias(f"__lk_{k}") for k in keys],
        *[c for c in small.columns if c not in keys],
    )
    if null_safe:
        cond = [df[k].eqNullSafe(renamed[f"__lk_{k}"]) for k in keys]
    else:
        cond = [df[k] == renamed[f"__lk_{k}"] for k in keys]
    joined = df.join(renamed, reduce(lambda a, b: a & b, cond), how)
    return joined.drop(*[f"__lk_{k}" for k in keys])
