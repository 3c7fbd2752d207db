"""Sliding-window monitoring over an event log.

Windows follow Spark's ``window(ts, length, slide)``: starts on the slide grid
from the epoch, ``[start, start + length)``. Counts and rates are decomposable,
so rows are first counted per slide bucket (one partial aggregation) and only
the bucket counts are expanded into the ``length / slide`` windows that contain
them — the data that is expanded and shuffled is one row per busy bucket, not
one row per event and window. Quantiles are not decomposable: rows are expanded
and the exact distributed quantile runs with the window as the group, so a
burst window is still split over many tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from furrow.operators.ranking import exact_group_quantiles


def predictions_by_class(df: DataFrame, col: str) -> DataFrame:
    """Count per predicted class."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))


def epoch_micros(df: DataFrame, ts: str) -> Column:
    """Microseconds since the epoch. ``TIMESTAMP_NTZ`` is read as a UTC wall
    clock without going through the session time zone."""
    if isinstance(df.schema[ts].dataType, T.TimestampNTZType):
        return F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{ts}`)")
    return F.expr(f"unix_micros(`{ts}`)")


def _bucket(df: DataFrame, ts: str, slide_s: int) -> Column:
    return F.floor(epoch_micros(df, ts) / F.lit(slide_s * 1_000_000)).cast("long")


def _expand(buckets: DataFrame, length_s: int, slide_s: int) -> DataFrame:
    """Each bucket's row once for every window that holds the bucket, with the window's start."""
    if length_s % slide_s:
        raise ValueError("length must be a multiple of slide")
    last = F.lit(length_s // slide_s - 1)
    out = buckets.select("*", F.explode(F.sequence(F.lit(0), last)).alias("j"))
    return out.withColumn("window_start", ((F.col("b") - F.col("j")) * F.lit(slide_s)).cast("long")).drop("j")


def windows_of(buckets: DataFrame, length_s: int, slide_s: int, sums: list[str]) -> DataFrame:
    """``window_start, window_end`` (epoch seconds) and ``sums``, added up from counts ``b, *sums`` of slide buckets.
    Several rows of a bucket add up."""
    per = buckets.groupBy("b").agg(*[F.sum(c).alias(c) for c in sums])
    out = _expand(per, length_s, slide_s).groupBy("window_start").agg(*[F.sum(c).cast("long").alias(c) for c in sums])
    return out.withColumn("window_end", F.col("window_start") + F.lit(length_s))


def rate_of(buckets: DataFrame, length_s: int, slide_s: int) -> DataFrame:
    """J5 from ``b, events``."""
    c = windows_of(buckets, length_s, slide_s, ["events"])
    return c.select("window_start", "window_end", "events", (F.col("events") / F.lit(float(length_s))).alias("rate"))


def error_rate_of(buckets: DataFrame, length_s: int, slide_s: int) -> DataFrame:
    """J7 from ``b, events, errors``; a window with a row has events, so the share is defined."""
    c = windows_of(buckets, length_s, slide_s, ["events", "errors"])
    return c.select("window_start", "window_end", "events", "errors", (F.col("errors") / F.col("events")).alias("error_rate"))


def quantile_of(buckets: DataFrame, q: float, length_s: int, slide_s: int, name: str = "p95") -> DataFrame:
    """J6 from ``b, value, events``: exact over the values as they are given; what is expanded and sorted is a
    row for each bucket and different value. A window whose values are all missing has no row."""
    counted = buckets.groupBy("b", "value").agg(F.sum("events").alias("events"))
    out = exact_group_quantiles(_expand(counted, length_s, slide_s), ["window_start"], "value", [q], names=[name], count_name="events", weight="events")
    return out.withColumn("window_end", F.col("window_start") + F.lit(length_s))


def sliding_counts(
    df: DataFrame, ts: str, length_s: int, slide_s: int, flag: Column | None = None
) -> DataFrame:
    """Counts per sliding window: ``window_start, window_end`` (epoch seconds),
    ``events`` and, with ``flag``, ``flagged``."""
    return windows_of(_counted(df, ts, slide_s, flag, "flagged"), length_s, slide_s, ["events"] if flag is None else ["events", "flagged"])


def _counted(df: DataFrame, ts: str, slide_s: int, flag: Column | None = None, name: str = "errors") -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("events")]
    if flag is not None:
        aggs.append(F.sum(F.when(flag, 1).otherwise(0)).cast("long").alias(name))
    return df.groupBy(_bucket(df, ts, slide_s).alias("b")).agg(*aggs)


def sliding_rate(df: DataFrame, ts: str, length_s: int = 60, slide_s: int = 5) -> DataFrame:
    """Events per second over a trailing window."""
    return rate_of(_counted(df, ts, slide_s), length_s, slide_s)


def sliding_error_rate(df: DataFrame, ts: str, is_error: Column, length_s: int = 300, slide_s: int = 60) -> DataFrame:
    """Share of rows matching ``is_error`` per window."""
    return error_rate_of(_counted(df, ts, slide_s, is_error), length_s, slide_s)


def sliding_quantile(df: DataFrame, ts: str, value: str, q: float = 0.95, length_s: int = 300,
                     slide_s: int = 60, name: str = "p95") -> DataFrame:
    """Exact quantile of ``value`` per sliding window; equal values of a bucket are counted before they are expanded."""
    counted = df.groupBy(_bucket(df, ts, slide_s).alias("b"), F.col(value).cast("double").alias("value")).agg(F.count(F.lit(1)).alias("events"))
    return quantile_of(counted, q, length_s, slide_s, name)


def log_bin(value: Column, relative_error: float) -> Column:
    """The middle of the value's logarithmic bin: within ``relative_error`` of it, at most a few thousand
    different ones between 1e-9 and 1e9. Smaller sizes become 0; NULL, NaN and infinities are NULL."""
    v = value.cast("double")
    gamma = (1 + relative_error) / (1 - relative_error)
    size = F.abs(v)
    middle = F.lit(2.0 / (gamma + 1.0)) * F.pow(F.lit(gamma), F.ceil(F.log(size) / F.log(F.lit(gamma))))
    return F.when(F.isnan(v) | (size == float("inf")), None).when(size < 1e-9, 0.0).when(v.isNotNull(), F.signum(v) * middle)
