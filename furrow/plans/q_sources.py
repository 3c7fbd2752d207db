"""Catalogue: what is written is read back (A1, A6, A7, B8), and constant columns of a growing table."""

from __future__ import annotations

from pyspark.sql import functions as F

from furrow.operators.impute import constant_columns
from furrow.plans.catalog import register, rounded, t
from furrow.session import scratch_path
from furrow.sources.tables import read_checked, read_features, read_submission, write_features, write_submission


def _as_text(spark, sf):
    """Events as a text table in which every 50th value is no number, every 70th time is none, and every 90th id is missing."""
    e = t(spark, sf, "events")
    i = F.col("event_id")
    return e.select(
        F.when(i % 90 != 7, i.cast("string")).alias("event_id"),
        F.when(i % 70 == 3, "soon").otherwise(F.col("ts").cast("string")).alias("ts"),
        "event_type",
        F.when(i % 50 == 0, F.concat(F.col("value").cast("string"), F.lit(" EUR"))).otherwise(F.col("value").cast("string")).alias("value"),
        i.cast("string").alias("line"),
    )


_SCHEMA = "event_id bigint not null, ts timestamp_ntz, event_type string, value double, line bigint"

_CHECKED_SQL = """SELECT event_id AS line, concat_ws('; ', CASE WHEN event_id % 90 = 7 THEN 'event_id is missing' END,
    CASE WHEN event_id % 70 = 3 THEN 'ts is no timestamp_ntz: soon' END, CASE WHEN event_id % 50 = 0 THEN 'value is no double: ' END) AS reason,
    CASE WHEN event_id % 90 <> 7 AND event_id % 70 <> 3 AND event_id % 50 <> 0 THEN value END AS value FROM events"""


def _checked(spark, sf, fmt: str):
    path = scratch_path(spark, f"checked.{fmt}")
    _as_text(spark, sf).write.format(fmt).option("header", True).save(path)
    rows, bad = read_checked(spark, path, _SCHEMA, fmt)
    # the value itself is left out of the reason, as engines print numbers differently
    reason = F.regexp_replace("reason", "no double: .* EUR", "no double: ")
    return rounded(rows.select("line", F.lit("").alias("reason"), "value").unionByName(
        bad.select(F.col("line").cast("long").alias("line"), reason.alias("reason"), F.lit(None).cast("double").alias("value"))))


@register("read_checked_csv", _CHECKED_SQL)
def q_read_checked_csv(spark, sf):
    """A1: a CSV table read with its schema: the rows that fit, and those that do not with their reasons."""
    return _checked(spark, sf, "csv")


@register("read_checked_parquet", _CHECKED_SQL)
def q_read_checked_parquet(spark, sf):
    """A1: the same from Parquet files of text columns."""
    return _checked(spark, sf, "parquet")


@register("features_round_trip", """SELECT CAST(o_totalprice AS DOUBLE) AS o_totalprice, o_orderkey, CAST(0.0 AS DOUBLE) AS absent, o_orderstatus FROM orders""")
def q_features_round_trip(spark, sf):
    """A6 + B8: a feature table written with its schema, read back in the order asked for, with an absent column as 0.0."""
    path = scratch_path(spark, "features")
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    write_features(o, path, {"numeric": ["o_totalprice"], "categorical": ["o_orderstatus"]})
    return read_features(spark, path, ["o_totalprice", "o_orderkey", "absent", "o_orderstatus"])[0]


@register("submission_round_trip", """SELECT o_orderkey, CASE WHEN o_totalprice >= 350000 THEN 'High' WHEN o_totalprice >= 150000 THEN 'Medium' ELSE 'Low' END AS label FROM orders""")
def q_submission_round_trip(spark, sf):
    """Ids and labels written as CSV and read back."""
    path = scratch_path(spark, "submission")
    label = F.when(F.col("o_totalprice") >= 350000, "High").when(F.col("o_totalprice") >= 150000, "Medium").otherwise("Low")
    write_submission(t(spark, sf, "orders").withColumn("label", label), "o_orderkey", "label", path)
    return read_submission(spark, path, "o_orderkey bigint, label string")


_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@register("constant_columns", "WITH f AS (SELECT * FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority IS NOT NULL)\n" + "\nUNION ALL\n".join(
    f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) = 1 AS dropped FROM f" for c in _ORDER_COLUMNS))
def q_constant_columns(spark, sf):
    """Which columns of the finished orders have one value only, from all of their rows."""
    found = constant_columns(t(spark, sf, "orders").where("o_orderstatus = 'F' AND o_orderpriority IS NOT NULL"), _ORDER_COLUMNS)
    return spark.createDataFrame([(c, c in found) for c in _ORDER_COLUMNS], "column string, dropped boolean")
