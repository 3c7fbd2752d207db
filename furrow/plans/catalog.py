"""Query catalogue over the driver tables: one Spark query per operator plus
the ANSI SQL that DuckDB runs on the same Parquet files as an oracle.

Every query reads whole tables (no id subsets, no row caps) so its work grows
with the data. Computed doubles are rounded to 6 decimals on both sides so
that summation-order noise does not count as a mismatch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

DIGITS = 6


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def round_like_sql(c, digits: int = DIGITS):
    """``round(x * 10^d) / 10^d`` in doubles — what SQL engines do for
    ``round(double, d)``; Spark's own ``round`` rounds the exact decimal value
    of the double, which differs when ``x * 10^d`` sits on a half."""
    scale = float(10**digits)
    scaled = c * F.lit(scale)
    size = F.abs(scaled)
    # half away from zero in plain arithmetic; from 2^52 on a double is whole
    near = F.when(size < F.lit(2.0**52), F.signum(c) * F.floor(size + F.lit(0.5)) + F.lit(0.0)).otherwise(scaled)
    # like SQL engines: keep the input when the scaled value overflows
    return F.when(size < F.lit(float("inf")), near / F.lit(scale)).otherwise(c)


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column to ``DIGITS`` (both sides of the oracle do the same); not at all if that is None."""
    digits = DIGITS
    if digits is None:
        return df
    return df.select(
        *[
            round_like_sql(F.col(f.name), digits).alias(f.name)
            if isinstance(f.dataType, T.DoubleType)
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def r(expr: str, alias: str, digits: int = DIGITS) -> str:
    """SQL: ``round(expr, 6) AS "alias"``."""
    return f'round({expr}, {digits}) AS "{alias}"'


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return load(spark, sf_dir, name)
