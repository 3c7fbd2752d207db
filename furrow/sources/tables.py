"""Reading, writing and stacking tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.functions.nulls import align_columns
from furrow.sources import artifacts

CORRUPT = "_corrupt_record"
REASON = "reason"


def _as_schema(schema: T.StructType | str) -> T.StructType:
    return T.StructType.fromDDL(schema) if isinstance(schema, str) else schema


def read_table(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
               fmt: str | None = None) -> DataFrame:
    """A1: Parquet or CSV (header) with an explicit schema when given.

    A missing path raises (Spark's ``PATH_NOT_FOUND``), as the original does.
    With a schema, CSV values that do not fit it are NULL; :func:`read_checked`
    keeps such rows apart.
    """
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        return reader.option("header", True).csv(path)
    return reader.format(fmt).load(path)


def _misfit(raw: DataFrame, f: T.StructField) -> Column:
    """Why a row's value does not fit a column, or NULL."""
    if f.name not in raw.columns:
        return F.lit(None if f.nullable else f"{f.name} is missing").cast("string")
    value = F.col(f"`{f.name}`")
    bad = F.when(value.isNotNull() & value.try_cast(f.dataType).isNull(),
                 F.concat(F.lit(f"{f.name} is no {f.dataType.simpleString()}: "), value.cast("string")))
    return bad if f.nullable else F.when(value.isNull(), F.lit(f"{f.name} is missing")).otherwise(bad)


def read_checked(spark: SparkSession, path: str, schema: T.StructType | str, fmt: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A1: ``(rows, quarantine)``: the rows that fit the schema, with its types, and those that do not.

    A row does not fit if a value cannot be cast to its column's type, a column
    that may not be NULL is, or (CSV) it has another number of fields. The
    quarantine holds the row as it was read (CSV: as text) and all its reasons.
    Columns of the file that the schema lacks are left out, columns that the file
    lacks are NULL. CSV columns are taken by position, as the header is skipped. A
    missing path raises. Both parts are lazy reads of the same files.
    """
    schema = _as_schema(schema)
    fmt = fmt or ("csv" if path.endswith(".csv") else "parquet")
    if fmt == "csv":
        text = T.StructType([*(T.StructField(f.name, T.StringType()) for f in schema.fields), T.StructField(CORRUPT, T.StringType())])
        raw = spark.read.schema(text).option("header", True).option("enforceSchema", True).option("mode", "PERMISSIVE").option(
            "columnNameOfCorruptRecord", CORRUPT).csv(path)
        whole = F.when(F.col(CORRUPT).isNotNull(), F.lit("another number of fields"))
    else:
        raw = spark.read.format(fmt).load(path)
        whole = F.lit(None).cast("string")
    reasons = F.array_compact(F.array(whole, *[_misfit(raw, f) for f in schema.fields]))
    judged = raw.withColumn(REASON, F.array_join(reasons, "; "))
    fitting = judged.where(F.col(REASON) == "").select(*[
        (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in raw.columns else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in schema.fields])
    return fitting, judged.where(F.col(REASON) != "")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver tables, ``{sf_dir}/{name}.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def union_sources(frames: dict[str, DataFrame], tag: str = "Source") -> DataFrame:
    """Stack frames by column name (absent columns NULL) with a source tag."""
    out = None
    for name, df in frames.items():
        d = df.withColumn(tag, F.lit(name))
        out = d if out is None else out.unionByName(d, allowMissingColumns=True)
    return out


def write_features(df: DataFrame, path: str, columns: dict | None = None, overwrite: bool = True) -> None:
    """Parquet data with a manifest of its schema and of named column lists (instead of pickles), published in one step."""
    known = set(df.columns)
    if absent := [c for names in (columns or {}).values() for c in names if c not in known]:
        raise ValueError(f"columns that the table lacks: {absent}")
    artifacts.publish(df.sparkSession, path, "features", lambda folder: df.write.parquet(f"{folder}/data"),
                      {"schema": json.loads(df.schema.json()), "schema_hash": artifacts.schema_hash(df.schema), "columns": columns or {}}, overwrite)


def read_features(spark: SparkSession, path: str, columns: list[str] | None = None) -> tuple[DataFrame, dict]:
    """The table as it was written and its column lists; ``columns`` (B8): these in this order, absent ones as 0.0.

    The stored schema is enforced: a table whose files have another one is refused.
    """
    found = artifacts.manifest(spark, path, "features")
    data = f"{path.rstrip('/')}/data"
    artifacts.check_schema(spark.read.parquet(data).schema, found["schema_hash"], path)
    df = spark.read.schema(T.StructType.fromJson(found["schema"])).parquet(data)
    return align_columns(df, columns) if columns is not None else df, found["columns"]


def write_submission(df: DataFrame, id_col: str, label_col: str, path: str) -> DataFrame:
    """``id, label`` CSV with a header; returns the counts per label of what was written."""
    out = df.select(id_col, label_col)
    out.write.mode("overwrite").option("header", True).csv(path)
    return read_submission(out.sparkSession, path, out.schema).groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))


def read_submission(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A submission as it was written; a row that does not fit the schema is an error, not a NULL."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def prediction_log_sink(df: DataFrame, path: str, batch_id: int | str) -> None:
    """Append a batch of scored rows to the log, each with the UTC time of the append.

    A batch has a folder of its own, so the same ``batch_id`` again replaces
    what it wrote before instead of doubling it. :func:`read_prediction_log` reads all of them.
    """
    df.withColumn("timestamp", F.current_timestamp()).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch_id={batch_id}")


def read_prediction_log(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The log's rows with ``timestamp`` and ``batch_id`` (text); ``schema``: that of the scored rows. No log yet: no rows."""
    whole = T.StructType([*_as_schema(schema).fields, T.StructField("timestamp", T.TimestampType()), T.StructField("batch_id", T.StringType())])
    if not artifacts.exists(spark, path):
        return spark.createDataFrame([], whole)
    return spark.read.schema(whole).parquet(path)
