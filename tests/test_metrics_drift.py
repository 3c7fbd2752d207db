import numpy as np
import pandas as pd

from furrow.operators.drift import column_drift, dataset_drift, drift_decision
from furrow.operators.metrics import argmax_class, average_arrays, confusion, gate, per_class, summary
from pyspark.sql import functions as F


def test_metrics_against_definitions(spark):
    y = [0, 0, 1, 1, 2, 2, 2, 0]
    p = [0, 1, 1, 1, 2, 0, 2, 0]
    df = spark.createDataFrame(list(zip(y, p)), "y int, p int")
    s = summary(df, "y", "p", [0, 1, 2]).first()
    rec = [2 / 3, 1.0, 2 / 3]
    assert abs(s["balanced_accuracy"] - np.mean(rec)) < 1e-12
    pc = per_class(df, "y", "p", [0, 1, 2]).orderBy("c").toPandas()
    assert np.allclose(pc["precision"], [2 / 3, 2 / 3, 1.0])


def test_gate_strict_margin_and_argmax_ties(spark):
    df = spark.createDataFrame([(0, 0, 0), (1, 1, 1)], "y int, a int, b int")
    g = gate(df, "y", "a", "b", [0, 1], focus=1).first()
    assert g["delta_balanced_accuracy"] == 0.0 and g["decision"] == "HOLD champion" and g["agreement_rate"] == 1.0
    t = spark.createDataFrame([([0.4, 0.4, 0.2], [0.2, 0.4, 0.4])], "a array<double>, b array<double>")
    row = t.select(argmax_class("a").alias("x"), argmax_class(average_arrays(["a", "b"])).alias("e")).first()
    assert row["x"] == 0 and row["e"] == 1


def test_drift_of_table_with_itself_is_zero(spark):
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"v": rng.normal(size=2000), "c": rng.choice(list("abc"), 2000)})
    df = spark.createDataFrame(pdf)
    d = column_drift(df, df, ["v"], ["c"]).toPandas()
    assert (d["statistic"].abs() < 1e-12).all() and not d["drifted"].any()
    ds = dataset_drift(column_drift(df, df, ["v"], ["c"])).first()
    assert ds["dataset_drift"] is False
    assert drift_decision(dataset_drift(column_drift(df, df, ["v"], ["c"])), None).first()["exit_code"] == 0


def test_ks_matches_numpy(spark):
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=700).round(2), rng.normal(0.3, size=500).round(2)
    ref = spark.createDataFrame([(float(x),) for x in a], "v double")
    cur = spark.createDataFrame([(float(x),) for x in b], "v double")
    d = column_drift(ref, cur, ["v"], [], numeric_method="ks").first()
    grid = np.union1d(a, b)
    ks = np.max(np.abs(np.searchsorted(np.sort(a), grid, "right") / len(a) -
                       np.searchsorted(np.sort(b), grid, "right") / len(b)))
    assert abs(d["ks_stat"] - ks) < 1e-12


def test_missing_and_unknown_predictions_count_as_misses(spark):
    rows = [(0, 0), (1, 1), (1, None), (0, 7), (1, 1), (None, 1)]
    df = spark.createDataFrame(rows, "y int, p int")
    pc = {r.c: r for r in per_class(df, "y", "p", [0, 1]).collect()}
    assert pc[0].support == 2 and pc[0].recall == 0.5 and pc[1].support == 3 and abs(pc[1].recall - 2 / 3) < 1e-12
    assert abs(pc[1].precision - 2 / 3) < 1e-12  # the row without a label was predicted as 1
    cells = {(r.y, r.pred): r.n for r in confusion(df, "y", "p", [0, 1]).collect()}
    assert sum(cells.values()) == len(rows) and cells[1, None] == 1 and cells[0, None] == 1 and cells[None, 1] == 1
    s = summary(df, "y", "p", [0, 1]).first()
    assert abs(s.balanced_accuracy - (0.5 + 2 / 3) / 2) < 1e-12
    g = gate(df.withColumn("best", F.col("y")), "y", "best", "p", [0, 1], focus=1).first()
    assert g.champion_balanced_accuracy == 1.0 and g.decision == "HOLD champion" and g.holdout_rows == 6


def test_silent_sensor_is_reported_as_drift(spark):
    ref = spark.createDataFrame([(float(i), "a", None) for i in range(50)], "v double, c string, e double")
    cur = spark.createDataFrame([(None, None, float("nan")), (float("nan"), None, None), (float("inf"), None, None)], "v double, c string, e double")
    for method in ("wasserstein", "ks"):
        d = {r.column: r for r in column_drift(ref, cur, ["v", "e"], ["c"], numeric_method=method).collect()}
        assert set(d) == {"v", "e", "c"}
        assert d["v"].drifted and d["v"].missing_cur == 1.0 and d["v"].missing_ref == 0.0 and d["v"].statistic is None
        assert d["c"].drifted and not d["e"].drifted and d["e"].missing_ref == 1.0
    ds = dataset_drift(column_drift(ref, cur, ["v", "e"], ["c"])).first()
    assert ds.n_columns == 3 and ds.n_drifted == 2 and ds.dataset_drift


def test_missing_verdict_fails(spark):
    gate_row = spark.createDataFrame([("PROMOTE challenger",)], "decision string")
    none = spark.createDataFrame([(None,)], "dataset_drift boolean")
    assert drift_decision(none, gate_row).first().verdict == "FAILED"
    yes = spark.createDataFrame([(True,)], "dataset_drift boolean")
    assert drift_decision(yes, gate_row).first().verdict == "ACT"
    assert drift_decision(yes, None).first().verdict == "FAILED"


def test_wasserstein_psi_and_chi_square_match_numpy(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=400).round(1), rng.normal(0.5, 2, size=300).round(1)
    ca, cb = rng.choice(list("abc"), 400), rng.choice(list("abd"), 300)
    ref = spark.createDataFrame(list(zip(a.tolist(), ca.tolist())), "v double, c string")
    cur = spark.createDataFrame(list(zip(b.tolist(), cb.tolist())), "v double, c string")
    d = {r.column: r for r in column_drift(ref, cur, ["v"], ["c"]).collect()}
    grid = np.union1d(a, b)
    fa, fb = (np.searchsorted(np.sort(x), grid, "right") / len(x) for x in (a, b))
    assert abs(d["v"].wasserstein_norm - np.sum(np.abs(fa - fb)[:-1] * np.diff(grid)) / a.std()) < 1e-9
    below = np.searchsorted(np.sort(a), grid, "left")
    bins = np.minimum(10 * below // len(a), 9)
    p, q = (np.array([np.isin(x, grid[bins == k]).mean() for k in np.unique(bins)]) for x in (a, b))
    pe, qe = np.where(p > 0, p, 1e-4), np.where(q > 0, q, 1e-4)
    assert abs(d["v"].psi - np.sum((qe - pe) * np.log(qe / pe))) < 1e-9
    obs = np.array([[np.sum(x == k) for k in "abcd"] for x in (ca, cb)], float)
    exp = obs.sum(0) * obs.sum(1, keepdims=True) / obs.sum()
    assert abs(d["c"].chi_square - np.sum((obs - exp) ** 2 / exp)) < 1e-9
