"""Null handling and typing helpers (column expressions, no actions).

pandas treats NaN as missing; Spark keeps NaN apart from NULL and counts it in
aggregates. We normalise NaN and +-Inf to NULL where the pandas rules would see
a missing value, and we never let a comparison with NULL leak out as NULL where
pandas would give ``False``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

EPS = 1e-6
MISSING = "Missing"


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def categorical_key(c) -> Column:
    """B1: NULL -> ``"Missing"``, everything else as string."""
    return F.coalesce(col_(c).cast("string"), F.lit(MISSING))


def pandas_str(c) -> Column:
    """``astype(str)`` of a pandas object column: a missing value prints ``"nan"``."""
    return F.coalesce(col_(c).cast("string"), F.lit("nan"))


def safe_divide(n, d, eps: float = EPS) -> Column:
    """B2: ``n / ((d == 0 -> NULL) + eps)``; eps is added to non-zero ``d`` too.
    NULL where the sum is exactly 0 (NumPy gives an infinity, cleaned to missing later)."""
    return F.try_divide(col_(n), F.nullif(col_(d), F.lit(0.0)) + F.lit(eps))


def nan_to_null(c) -> Column:
    x = col_(c)
    return F.when(~F.isnan(x), x)


def inf_to_null(c) -> Column:
    """+-Inf (and NaN) -> NULL."""
    x = col_(c)
    return F.when(~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))), x)


def to_numeric(c) -> Column:
    """Strings that do not parse become NULL (``pd.to_numeric(errors='coerce')``)."""
    return F.expr(f"try_cast(`{c}` as double)") if isinstance(c, str) else c.try_cast("double")


def is_numeric_type(dt: T.DataType) -> bool:
    return isinstance(dt, (T.NumericType, T.BooleanType))


def resolve_columns(df: DataFrame, id_col: str | None = "id") -> tuple[list[str], list[str]]:
    """(numeric, categorical) column lists from the schema, id excluded."""
    num, cat = [], []
    for f in df.schema.fields:
        if f.name == id_col:
            continue
        (num if is_numeric_type(f.dataType) else cat).append(f.name)
    return num, cat


def normalise_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """NaN and +-Inf -> NULL on floating columns (one projection)."""
    floats = {
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.DoubleType, T.FloatType))
        and (columns is None or f.name in columns)
    }
    return df.select(*[inf_to_null(c).alias(c) if c in floats else F.col(c) for c in df.columns])


def align_columns(df: DataFrame, columns: list[str], default: float = 0.0) -> DataFrame:
    """Add absent columns as ``default`` and project in the given order."""
    have = set(df.columns)
    return df.select(
        *[F.col(c) if c in have else F.lit(default).alias(c) for c in columns]
    )
