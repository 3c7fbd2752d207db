"""Streams that stop and go on, late rows, open windows, repeated batches."""

import datetime as dt

from pyspark.sql import functions as F

import pytest

from furrow.operators import monitor as mon
from furrow.operators.drift import column_drift
from furrow.streaming.jobs import (
    buckets_to_table,
    drift_stream,
    drift_windows,
    file_stream,
    monitor_buckets,
    monitor_to_table,
    run_by_batch,
    run_to_table,
    score_stream,
)

SCHEMA = "id long, ts timestamp, kind string, value double"
T0 = dt.datetime(2024, 1, 1)


def put(spark, path, rows, name):
    data = [(i, T0 + dt.timedelta(minutes=m), k, float(i)) for i, m, k in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{path}/{name}")


def stream(spark, path):
    return file_stream(spark, f"{path}/*", spark.createDataFrame([], SCHEMA).schema, max_files=1)


def test_restart_loses_and_repeats_nothing(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    put(spark, src, [(1, 0, "a"), (2, 1, "a")], "f1")
    assert run_to_table(stream(spark, src), "s", path=out).count() == 2
    put(spark, src, [(3, 2, "a")], "f2")
    got = run_to_table(stream(spark, src), "s", path=out)
    assert sorted(r.id for r in got.collect()) == [1, 2, 3]


def test_open_windows_and_late_rows(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    put(spark, src, [(1, 0, "ok"), (2, 50, "error"), (3, 200, "ok")], "f1")
    error = F.col("kind") == "error"
    args = ("ts", "1 hour", "10 minutes", error)
    got, late = monitor_to_table(stream(spark, src), *args, path=out)
    assert late == 0 and sorted((r.events, r.errors) for r in got.collect()) == [(1, 0), (2, 1)]
    put(spark, src, [(4, 5, "ok"), (5, 210, "error")], "f2")  # the first is three hours late
    got, late = monitor_to_table(stream(spark, src), *args, path=out)
    assert late == 1 and sorted((r.events, r.errors) for r in got.collect()) == [(2, 1), (2, 1)]


def test_a_batch_run_again_is_there_once(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    put(spark, src, [(1, 0, "a")], "f1")
    run_by_batch(stream(spark, src), "s", "append", out, f"{tmp_path}/ck1")
    got, _ = run_by_batch(stream(spark, src), "s", "append", out, f"{tmp_path}/ck2")  # the same batch 0 again
    assert got.count() == 1


def test_drift_stream_reports_every_batch(spark, tmp_path):
    src = f"{tmp_path}/in"
    put(spark, src, [(i, i, "a") for i in range(20)], "f1")
    put(spark, src, [(i + 500, i, "b") for i in range(20)], "f2")
    ref = spark.createDataFrame([(float(i), "a") for i in range(20)], "value double, kind string")
    got = drift_stream(stream(spark, src), ref, ["value"], ["kind"], path=f"{tmp_path}/out").collect()
    drifted = {(r.batch_id, r.column): r.drifted for r in got}
    assert len(drifted) == 4 and sum(drifted.values()) == 2


def live(spark, src, out, slide=60, delay="10 minutes", **more):
    counts = monitor_buckets(stream(spark, src), "ts", slide, delay, F.col("kind"), F.col("value"), F.col("kind") == "error", **more)
    return buckets_to_table(counts, path=out)


def test_sliding_monitors_equal_batch_after_a_restart(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    kinds = ["ok", "error", None]
    files = [[(100 * k + i, 10 * k + i, kinds[(i + k) % 3]) for i in range(15)] for k in range(4)]
    for k in range(2):
        put(spark, src, files[k], f"f{k}")
    live(spark, src, out)
    for k in range(2, 4):
        put(spark, src, [*files[k], *files[k][:3]], f"f{k}")
    buckets, late = live(spark, src, out)
    assert late == 0
    whole = spark.read.parquet(f"{src}/*")
    rows = lambda df: sorted(map(tuple, df.select(sorted(df.columns)).collect()), key=str)
    assert rows(mon.rate_of(buckets, 300, 60)) == rows(mon.sliding_rate(whole, "ts", 300, 60))
    assert rows(mon.error_rate_of(buckets, 300, 60)) == rows(mon.sliding_error_rate(whole, "ts", F.col("kind") == "error", 300, 60))
    assert rows(mon.quantile_of(buckets, 0.95, 300, 60)) == rows(mon.sliding_quantile(whole, "ts", "value", 0.95, 300, 60))
    counted = buckets.groupBy(F.col("kind")).agg(F.sum("events").alias("count"))
    assert rows(counted) == rows(mon.predictions_by_class(whole, "kind"))
    with pytest.raises(ValueError):
        mon.rate_of(buckets, 100, 60)


def test_late_rows_of_more_batches_than_progress_is_kept_for(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    conf = {"spark.sql.shuffle.partitions": "1", "spark.sql.streaming.numRecentProgressUpdates": "3"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        put(spark, src, [(0, 5000, "ok")], "f000")
        put(spark, src, [(1, 6000, "ok")], "f001")  # the watermark has passed 4990 from here on
        base = spark.createDataFrame([(i, T0 + dt.timedelta(minutes=i % 50), "ok", float(i)) for i in range(2, 14)], SCHEMA)
        base.repartitionByRange(12, "id").write.parquet(f"{src}/late")  # a late row in each of 12 micro-batches, more than progress is kept for
        _, late = live(spark, src, out)
        assert late == 12
        put(spark, src, [(500, 1, "ok")], "g0")  # and one in a second run
        buckets, late = live(spark, src, out)
        assert late == 13 and buckets.agg(F.sum("events")).first()[0] == 2
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_binned_values_keep_their_relative_error(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    put(spark, src, [(i, i // 500, "a") for i in range(-1000, 1000)], "f")
    buckets, _ = live(spark, src, out, relative_error=0.01)
    exact = {r.window_start: r.p95 for r in mon.sliding_quantile(spark.read.parquet(f"{src}/*"), "ts", "value", 0.95, 300, 60).collect()}
    got = {r.window_start: r.p95 for r in mon.quantile_of(buckets, 0.95, 300, 60).collect()}
    assert got.keys() == exact.keys() and all(got[w] == pytest.approx(exact[w], rel=0.02, abs=0.02) for w in exact)
    odd = spark.createDataFrame([(float("nan"),), (float("inf"),), (None,), (0.0,), (-1e-12,), (-3.0,)], "v double")
    assert [r[0] for r in odd.select(mon.log_bin(F.col("v"), 0.01)).collect()][:5] == [None, None, None, 0.0, 0.0]


def test_empty_streams_give_empty_tables(spark, tmp_path):
    src = f"{tmp_path}/in"
    spark.createDataFrame([], SCHEMA).write.parquet(f"{src}/f")
    buckets, late = live(spark, src, f"{tmp_path}/a")
    assert buckets.count() == 0 and late == 0
    assert monitor_to_table(stream(spark, src), "ts", "1 hour", "1 minute", F.lit(False), path=f"{tmp_path}/b")[0].count() == 0
    ref = spark.createDataFrame([(1.0, "a")], "value double, kind string")
    assert drift_windows(stream(spark, src), ref, ["value"], ["kind"], "ts", "1 hour", "1 minute", path=f"{tmp_path}/c")[0].count() == 0


def test_keys_without_spread_are_medium(spark):
    lookup = spark.createDataFrame([("flat", 5.0, 0.0), ("one", 5.0, None), ("wide", 5.0, 1.0)], "kind string, mean double, std double")
    rows = spark.createDataFrame([(1, "flat", 5.0), (2, "flat", 9.0), (3, "one", 5.0), (4, "wide", 9.0), (5, "none", 1.0), (6, "wide", None)],
                                 "id long, kind string, value double")
    got = {r.id: (r.z, r.predicted_class) for r in score_stream(rows, lookup, "kind", "value", "id").collect()}
    assert got == {1: (None, "Medium"), 2: (None, "Medium"), 3: (None, "Medium"), 4: (4.0, "High"), 5: (None, "Medium"), 6: (None, "Medium")}


def test_drift_of_closed_windows_equals_batch(spark, tmp_path):
    src, out = f"{tmp_path}/in", f"{tmp_path}/out"
    ref = spark.createDataFrame([(float(i), "ab"[i % 2], i) for i in range(40)], "value double, kind string, other int")

    def run():
        return drift_windows(stream(spark, src), ref, ["value"], ["kind"], "ts", "1 hour", "10 minutes", path=out)

    put(spark, src, [(i, i, "a") for i in range(50)], "f1")
    put(spark, src, [(i + 30, 60 + i, "b") for i in range(50)], "f2")  # closes the first hour
    run()
    put(spark, src, [(i, 125 + i, "a" if i % 2 else None) for i in range(30)], "f3")  # closes the second
    put(spark, src, [(1, 300, "a"), (777, 3, "a")], "f4")  # closes the third; one row is late
    put(spark, src, [(2, 301, "a")], "f5")
    got, late = run()
    assert late == 2  # that row is one of each column's counts
    whole = spark.read.parquet(f"{src}/*").where("id <> 777")
    found = {}
    for r in got.collect():
        found.setdefault(r.window_start, {})[r["column"]] = r
    starts = [int(T0.replace(tzinfo=dt.timezone.utc).timestamp()) + 3600 * k for k in range(3)]
    assert sorted(found) == starts
    for w in starts:
        part = whole.where((F.unix_seconds("ts") >= w) & (F.unix_seconds("ts") < w + 3600))
        want = {r["column"]: r for r in column_drift(ref, part, ["value"], ["kind"]).collect()}
        for c, r in want.items():
            mine = found[w][c].asDict()
            assert all(mine[k] == (pytest.approx(v, abs=1e-12) if isinstance(v, float) else v) for k, v in r.asDict().items()), (w, c)
