"""Catalogue: the streaming jobs over ``events`` as a file stream (K1-K3),
read back from their Parquet sinks. Oracles are the batch forms."""

from __future__ import annotations

from pyspark.sql import functions as F

from furrow.operators.monitor import error_rate_of, quantile_of, rate_of
from furrow.plans import q_eval  # noqa: F401  the batch forms' SQL
from furrow.plans.catalog import ORACLE, register, rounded, t
from furrow.streaming.jobs import buckets_to_table, drift_stream, drift_windows, file_stream, monitor_buckets, monitor_to_table, run_to_table, score_stream


def _events_stream(spark, sf):
    schema = t(spark, sf, "events").schema
    # a glob, so the single Parquet file of the driver tables is a valid stream source
    return file_stream(spark, f"{sf.rstrip('/')}/events.parq*", schema)


@register(
    "score_stream",
    """WITH lk AS (SELECT event_type, avg(value) AS mean, stddev_samp(value) AS std FROM events GROUP BY event_type)
SELECT e.event_id, e.event_type, round((e.value - lk.mean) / nullif(lk.std, 0), 6) AS z,
       CASE WHEN (e.value - lk.mean) / nullif(lk.std, 0) > 1.0 THEN 'High' WHEN (e.value - lk.mean) / nullif(lk.std, 0) < -1.0 THEN 'Low'
            ELSE 'Medium' END AS predicted_class
FROM events e LEFT JOIN lk ON e.event_type = lk.event_type""",
)
def q_score_stream(spark, sf):
    """K1: events scored as they stream in, against statistics fitted on the table."""
    fitted = t(spark, sf, "events").groupBy("event_type").agg(F.avg("value").alias("mean"),
                                                            F.stddev_samp("value").alias("std"))
    scored = score_stream(_events_stream(spark, sf), fitted, "event_type", "value", "event_id")
    return rounded(run_to_table(scored, "score-stream"))


@register(
    "monitor_stream",
    """WITH w AS (SELECT epoch_us(ts) // 3600000000 * 3600 AS window_start, event_type FROM events)
SELECT CAST(window_start AS BIGINT) AS window_start, CAST(window_start + 3600 AS BIGINT) AS window_end,
       count(*) AS events, CAST(sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS BIGINT) AS errors
FROM w GROUP BY window_start""",
)
def q_monitor_stream(spark, sf):
    """K2: hourly event and error counts with a 10-minute watermark, windows
    still open when the input ends included."""
    s = _events_stream(spark, sf)
    return monitor_to_table(s, "ts", "1 hour", "10 minutes", F.col("event_type") == "error")[0]


@register("drift_stream")
def q_drift_stream(spark, sf):
    """K3: per-micro-batch drift of event values and types against the first
    week; the stream holds what follows it."""
    cut = F.lit("2024-01-08 00:00:00").cast("timestamp_ntz")
    ref = t(spark, sf, "events").where(F.col("ts") < cut)
    later = _events_stream(spark, sf).where(F.col("ts") >= cut)
    return rounded(drift_stream(later, ref, ["value"], ["event_type"]))


def _live(spark, sf, slide_s: int):
    """The state of the monitored stream: counts by slide bucket, event type and value."""
    counts = monitor_buckets(_events_stream(spark, sf), "ts", slide_s, "10 minutes", F.col("event_type"), F.col("value"), F.col("event_type") == "error")
    return buckets_to_table(counts)[0]


@register("stream_pred_counts", ORACLE["pred_counts"])
def q_stream_pred_counts(spark, sf):
    """K2 + J4: running count per class, from the stream's state."""
    return _live(spark, sf, 60).groupBy(F.col("kind").alias("event_type")).agg(F.sum("events").alias("count"))


@register("stream_sliding_rate", ORACLE["sliding_rate"])
def q_stream_sliding_rate(spark, sf):
    """K2 + J5: events per second over 1-minute windows sliding by 5 s, from the stream's state."""
    return rounded(rate_of(_live(spark, sf, 5), 60, 5))


@register("stream_sliding_p95", ORACLE["sliding_p95"])
def q_stream_sliding_p95(spark, sf):
    """K2 + J6: exact p95 over 5-minute windows sliding by 1 minute, from the stream's state."""
    return rounded(quantile_of(_live(spark, sf, 60), 0.95, 300, 60))


@register("stream_sliding_errors", ORACLE["sliding_errors"])
def q_stream_sliding_errors(spark, sf):
    """K2 + J7: error share over 5-minute windows sliding by 1 minute, from the stream's state."""
    return rounded(error_rate_of(_live(spark, sf, 60), 300, 60))


@register("drift_windows")
def q_drift_windows(spark, sf):
    """K3: drift of every closed day of the stream against the first week."""
    cut = F.lit("2024-01-08 00:00:00").cast("timestamp_ntz")
    ref = t(spark, sf, "events").where(F.col("ts") < cut)
    later = _events_stream(spark, sf).where(F.col("ts") >= cut)
    return rounded(drift_windows(later, ref, ["value"], ["event_type"], "ts", "1 day", "10 minutes")[0])
