"""Catalogue: ensembling, metrics, gate, drift and monitoring.

Two rule-based "models" score ``orders`` (true class = order status), so the
metric operators run on real predictions without a trained model.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from furrow.operators.drift import column_drift, dataset_drift, drift_decision
from furrow.operators.metrics import (
    argmax_class,
    average_arrays,
    confusion,
    evaluate_models,
    gate,
)
from furrow.operators.monitor import (
    predictions_by_class,
    sliding_error_rate,
    sliding_quantile,
    sliding_rate,
)
from furrow.plans.catalog import register, rounded, t

CLASSES = [0, 1, 2]
NAMES = {0: "Low", 1: "Medium", 2: "High"}

_BASE_SQL = """
WITH s AS (
  SELECT o_orderkey,
    CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 ELSE 2 END AS y,
    CASE WHEN year(o_orderdate) <= 1997 THEN 3.0 ELSE 1.0 END AS a0,
    CASE WHEN year(o_orderdate) >= 1999 THEN 3.0 ELSE 1.0 END AS a1,
    CASE WHEN year(o_orderdate) = 1998 THEN 2.0 ELSE 1.0 END AS a2,
    1.0 + o_totalprice / 500000.0 AS b0,
    CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 2.0 ELSE 1.0 END AS b1,
    1.5 AS b2
  FROM orders),
p AS (
  SELECT o_orderkey, y,
    a0 / (a0 + a1 + a2) AS pa0, a1 / (a0 + a1 + a2) AS pa1, a2 / (a0 + a1 + a2) AS pa2,
    b0 / (b0 + b1 + b2) AS pb0, b1 / (b0 + b1 + b2) AS pb1, b2 / (b0 + b1 + b2) AS pb2
  FROM s),
e AS (SELECT *, (pa0 + pb0) / 2.0 AS e0, (pa1 + pb1) / 2.0 AS e1, (pa2 + pb2) / 2.0 AS e2 FROM p),
base AS (
  SELECT o_orderkey, y, e0, e1, e2,
    CASE WHEN pa0 >= pa1 AND pa0 >= pa2 THEN 0 WHEN pa1 >= pa2 THEN 1 ELSE 2 END AS champion,
    CASE WHEN pb0 >= pb1 AND pb0 >= pb2 THEN 0 WHEN pb1 >= pb2 THEN 1 ELSE 2 END AS challenger,
    CASE WHEN e0 >= e1 AND e0 >= e2 THEN 0 WHEN e1 >= e2 THEN 1 ELSE 2 END AS ensemble
  FROM e)
"""


def scored_orders(spark, sf):
    """Two probability models, their mean (H6) and argmax classes (H7)."""
    o = t(spark, sf, "orders")
    yr = F.year("o_orderdate")
    a = [F.when(yr <= 1997, 3.0).otherwise(1.0), F.when(yr >= 1999, 3.0).otherwise(1.0),
         F.when(yr == 1998, 2.0).otherwise(1.0)]
    b = [1.0 + F.col("o_totalprice") / 500000.0,
         F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), 2.0).otherwise(1.0), F.lit(1.5)]

    def norm(xs):
        total = xs[0] + xs[1] + xs[2]
        return F.array(*[x / total for x in xs])

    s = o.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", 0).when(F.col("o_orderstatus") == "O", 1).otherwise(2).alias("y"),
        norm(a).alias("pa"), norm(b).alias("pb"),
    )
    s = s.withColumn("pe", average_arrays(["pa", "pb"]))
    return s.select("o_orderkey", "y", "pe", argmax_class("pa").alias("champion"),
                    argmax_class("pb").alias("challenger"), argmax_class("pe").alias("ensemble"))


@register(
    "ensemble_argmax",
    _BASE_SQL + "SELECT o_orderkey, round(e0, 6) AS p_low, round(e1, 6) AS p_medium, round(e2, 6) AS p_high, "
    "ensemble AS predicted FROM base",
)
def q_ensemble_argmax(spark, sf):
    """H6 + H7: mean of two models' probability vectors, first-max class."""
    s = scored_orders(spark, sf)
    return rounded(s.select("o_orderkey", F.col("pe")[0].alias("p_low"), F.col("pe")[1].alias("p_medium"),
                            F.col("pe")[2].alias("p_high"), F.col("ensemble").alias("predicted")))


@register(
    "confusion",
    _BASE_SQL + """, g AS (SELECT a.c AS y, b.c AS pred FROM (VALUES (0), (1), (2)) a(c), (VALUES (0), (1), (2)) b(c)),
cnt AS (SELECT y, ensemble AS pred, count(*) AS n FROM base GROUP BY 1, 2),
f AS (SELECT g.y, g.pred, coalesce(cnt.n, 0) AS n FROM g LEFT JOIN cnt ON g.y = cnt.y AND g.pred = cnt.pred)
SELECT CAST(y AS INTEGER) AS y, CAST(pred AS INTEGER) AS pred, n,
  round(CASE WHEN sum(n) OVER (PARTITION BY y) > 0 THEN n / sum(n) OVER (PARTITION BY y) ELSE 0.0 END, 6) AS share
FROM f""",
)
def q_confusion(spark, sf):
    """H8: confusion counts and row-normalised shares of the ensemble."""
    return rounded(confusion(scored_orders(spark, sf), "y", "ensemble", CLASSES))


_METRICS_SQL = _BASE_SQL + """,
lg AS (SELECT 'champion' AS model, y, champion AS pred FROM base UNION ALL
       SELECT 'challenger', y, challenger FROM base UNION ALL SELECT 'ensemble', y, ensemble FROM base),
cls AS (SELECT * FROM (VALUES (0, 'low'), (1, 'medium'), (2, 'high')) v(c, cn)),
pc AS (SELECT m.model, cls.c, cls.cn,
         (SELECT count(*) FROM lg WHERE lg.model = m.model AND lg.y = cls.c AND lg.pred = cls.c) AS tp,
         (SELECT count(*) FROM lg WHERE lg.model = m.model AND lg.y = cls.c) AS support,
         (SELECT count(*) FROM lg WHERE lg.model = m.model AND lg.pred = cls.c) AS predicted
       FROM (SELECT DISTINCT model FROM lg) m CROSS JOIN cls),
pm AS (SELECT *, CASE WHEN predicted > 0 THEN tp / predicted ELSE 0.0 END AS prec,
              CASE WHEN support > 0 THEN tp / support ELSE 0.0 END AS rec FROM pc),
pf AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END AS f1 FROM pm)
"""


@register(
    "class_metrics",
    _METRICS_SQL + """
SELECT model, 'oof_balanced_accuracy' AS metric,
       round(sum(CASE WHEN support > 0 THEN rec ELSE 0.0 END) / sum(CASE WHEN support > 0 THEN 1 ELSE 0 END), 6) AS value
FROM pf GROUP BY model
UNION ALL SELECT model, 'macro_f1', round(avg(f1), 6) FROM pf GROUP BY model
UNION ALL SELECT model, 'weighted_f1', round(sum(f1 * support) / sum(support), 6) FROM pf GROUP BY model
UNION ALL SELECT model, cn || '_precision', round(prec, 6) FROM pf
UNION ALL SELECT model, cn || '_recall', round(rec, 6) FROM pf
UNION ALL SELECT model, cn || '_f1', round(f1, 6) FROM pf""",
)
def q_class_metrics(spark, sf):
    """H9 + H10: the metrics report (balanced accuracy, macro/weighted F1,
    per-class precision/recall/F1) for both models and their ensemble."""
    s = scored_orders(spark, sf)
    rep = evaluate_models(s, "y", {"champion": "champion", "challenger": "challenger", "ensemble": "ensemble"},
                          CLASSES, NAMES)
    return rounded(rep)


@register(
    "gate",
    _METRICS_SQL + """,
side AS (SELECT model,
           sum(CASE WHEN support > 0 THEN rec ELSE 0.0 END) / sum(CASE WHEN support > 0 THEN 1 ELSE 0 END) AS ba,
           avg(f1) AS mf1, max(CASE WHEN c = 2 THEN rec END) AS hr FROM pf GROUP BY model)
SELECT round(ch.ba, 6) AS champion_balanced_accuracy, round(ch.mf1, 6) AS champion_macro_f1,
       round(ch.hr, 6) AS champion_focus_recall,
       round(cl.ba, 6) AS challenger_balanced_accuracy, round(cl.mf1, 6) AS challenger_macro_f1,
       round(cl.hr, 6) AS challenger_focus_recall,
       (SELECT count(*) FROM base) AS holdout_rows,
       round((SELECT avg(CASE WHEN champion = challenger THEN 1.0 ELSE 0.0 END) FROM base), 6) AS agreement_rate,
       round(cl.ba - ch.ba, 6) AS delta_balanced_accuracy, 0.001 AS promote_margin,
       CASE WHEN cl.ba - ch.ba > 0.001 THEN 'PROMOTE challenger' ELSE 'HOLD champion' END AS decision
FROM side ch, side cl WHERE ch.model = 'champion' AND cl.model = 'challenger'""",
)
def q_gate(spark, sf):
    """champion/challenger comparison and the strict-margin decision."""
    return rounded(gate(scored_orders(spark, sf), "y", "champion", "challenger", CLASSES, focus=2))


# ---- drift ---------------------------------------------------------------------
_DRIFT_NUM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_DRIFT_CAT = ["l_returnflag", "l_linestatus"]
_CUT = "TIMESTAMP '1998-01-01'"


def _drift_frames(spark, sf):
    li = t(spark, sf, "lineitem")
    cut = F.lit("1998-01-01").cast("timestamp")
    return li.where(F.col("l_shipdate") < cut), li.where(F.col("l_shipdate") >= cut)


_DRIFT_SQL = f"""
WITH r AS (SELECT * FROM lineitem WHERE l_shipdate < {_CUT}), c AS (SELECT * FROM lineitem WHERE l_shipdate >= {_CUT}),
nl AS ({" UNION ALL ".join(f"SELECT '{x}' AS col, CAST({x} AS DOUBLE) AS v, 1 AS is_ref FROM r UNION ALL SELECT '{x}', CAST({x} AS DOUBLE), 0 FROM c" for x in _DRIFT_NUM)}),
ncnt AS (SELECT col, v, sum(is_ref) AS n_ref, sum(1 - is_ref) AS n_cur FROM nl WHERE v IS NOT NULL GROUP BY col, v),
ntot AS (SELECT col, sum(n_ref) AS tot_ref, sum(n_cur) AS tot_cur FROM ncnt GROUP BY col),
ncum AS (SELECT col, v, sum(n_ref) OVER (PARTITION BY col ORDER BY v) AS c_ref,
                sum(n_cur) OVER (PARTITION BY col ORDER BY v) AS c_cur,
                lead(v) OVER (PARTITION BY col ORDER BY v) AS nv FROM ncnt),
nd AS (SELECT ncum.col, abs(c_ref / tot_ref - c_cur / tot_cur) AS diff, coalesce(nv - v, 0.0) AS gap, tot_ref, tot_cur
       FROM ncum JOIN ntot ON ncum.col = ntot.col),
nb AS (SELECT ncum.col, least(floor(10 * (c_ref - n_ref) / tot_ref), 9) AS b, sum(n_ref) / any_value(tot_ref) AS p,
              sum(n_cur) / any_value(tot_cur) AS q
       FROM (SELECT ncum.*, ncnt.n_ref, ncnt.n_cur FROM ncum JOIN ncnt ON ncum.col = ncnt.col AND ncum.v = ncnt.v) ncum
       JOIN ntot ON ncum.col = ntot.col GROUP BY 1, 2),
npsi AS (SELECT col, sum((CASE WHEN q > 0 THEN q ELSE 0.0001 END - CASE WHEN p > 0 THEN p ELSE 0.0001 END)
              * ln(CASE WHEN q > 0 THEN q ELSE 0.0001 END / CASE WHEN p > 0 THEN p ELSE 0.0001 END)) AS psi FROM nb GROUP BY col),
nmiss AS (SELECT col, avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) FILTER (is_ref = 1) AS mr,
                 avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) FILTER (is_ref = 0) AS mc FROM nl GROUP BY col),
nsd AS (SELECT col, stddev_pop(v) AS s FROM nl WHERE is_ref = 1 GROUP BY col),
num AS (SELECT nd.col, any_value(tot_ref) AS n_ref, any_value(tot_cur) AS n_cur, max(diff) AS ks,
               sum(diff * gap) / any_value(nsd.s) AS wn,
               1.358 * sqrt((any_value(tot_ref) + any_value(tot_cur)) / (any_value(tot_ref) * any_value(tot_cur))) AS crit
        FROM nd JOIN nsd ON nd.col = nsd.col GROUP BY nd.col),
cl AS ({" UNION ALL ".join(f"SELECT '{x}' AS col, CAST({x} AS VARCHAR) AS v, 1 AS is_ref FROM r UNION ALL SELECT '{x}', CAST({x} AS VARCHAR), 0 FROM c" for x in _DRIFT_CAT)}),
ccnt AS (SELECT col, v, sum(is_ref) AS n_ref, sum(1 - is_ref) AS n_cur FROM cl WHERE v IS NOT NULL GROUP BY col, v),
ctot AS (SELECT col, sum(n_ref) AS tot_ref, sum(n_cur) AS tot_cur FROM ccnt GROUP BY col),
cmiss AS (SELECT col, avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) FILTER (is_ref = 1) AS mr,
                 avg(CASE WHEN v IS NULL THEN 1.0 ELSE 0.0 END) FILTER (is_ref = 0) AS mc FROM cl GROUP BY col),
cp AS (SELECT ccnt.col, n_ref / tot_ref AS p, n_cur / tot_cur AS q, n_ref AS o1, n_cur AS o2,
              (n_ref + n_cur) * tot_ref / (tot_ref + tot_cur) AS e1, (n_ref + n_cur) * tot_cur / (tot_ref + tot_cur) AS e2
       FROM ccnt JOIN ctot ON ccnt.col = ctot.col),
cat AS (SELECT col,
          sqrt(greatest(0.0, 0.5 * sum(CASE WHEN p > 0 THEN p * ln(p / ((p + q) / 2.0)) ELSE 0.0 END)
                           + 0.5 * sum(CASE WHEN q > 0 THEN q * ln(q / ((p + q) / 2.0)) ELSE 0.0 END))) AS js,
          sum((CASE WHEN q > 0 THEN q ELSE 0.0001 END - CASE WHEN p > 0 THEN p ELSE 0.0001 END)
              * ln(CASE WHEN q > 0 THEN q ELSE 0.0001 END / CASE WHEN p > 0 THEN p ELSE 0.0001 END)) AS psi,
          sum((o1 - e1) * (o1 - e1) / e1 + (o2 - e2) * (o2 - e2) / e2) AS chi
        FROM cp GROUP BY col),
cd AS (
  SELECT num.col AS "column", 'numeric' AS kind, 'wasserstein' AS method, wn AS statistic, 0.1 AS threshold,
         coalesce(wn >= 0.1, false) AS drifted, mr AS missing_ref, mc AS missing_cur,
         ks AS ks_stat, wn AS wasserstein_norm, CAST(NULL AS DOUBLE) AS js_distance, psi, CAST(NULL AS DOUBLE) AS chi_square
  FROM num JOIN npsi ON num.col = npsi.col JOIN nmiss ON num.col = nmiss.col
  UNION ALL
  SELECT cat.col, 'categorical', 'jensenshannon', js, 0.1, js >= 0.1, mr, mc, NULL, NULL, js, psi, chi
  FROM cat JOIN cmiss ON cat.col = cmiss.col)
"""


@register(
    "column_drift",
    _DRIFT_SQL + "SELECT \"column\", kind, method, round(statistic, 6) AS statistic, round(threshold, 6) AS threshold, "
    "drifted, round(missing_ref, 6) AS missing_ref, round(missing_cur, 6) AS missing_cur, round(ks_stat, 6) AS ks_stat, round(wasserstein_norm, 6) AS wasserstein_norm, "
    "round(js_distance, 6) AS js_distance, round(psi, 6) AS psi, round(chi_square, 6) AS chi_square FROM cd",
)
def q_column_drift(spark, sf):
    """Per-column drift of lineitem shipped from 1998 against before."""
    ref, cur = _drift_frames(spark, sf)
    return rounded(column_drift(ref, cur, _DRIFT_NUM, _DRIFT_CAT))


_DATASET_SQL = (_DRIFT_SQL + ", ds AS (SELECT count(*) AS n_columns, CAST(sum(CASE WHEN drifted THEN 1 ELSE 0 END) AS BIGINT) "
                "AS n_drifted FROM cd) ")


@register(
    "dataset_drift",
    _DATASET_SQL + "SELECT n_columns, n_drifted, round(n_drifted / n_columns, 6) AS share, "
    "n_drifted / n_columns >= 0.5 AS dataset_drift FROM ds",
)
def q_dataset_drift(spark, sf):
    """Drifted-column share and the dataset verdict (share >= 0.5)."""
    ref, cur = _drift_frames(spark, sf)
    return rounded(dataset_drift(column_drift(ref, cur, _DRIFT_NUM, _DRIFT_CAT)))


_SIDE_SQL = """,
side AS (SELECT model,
           sum(CASE WHEN support > 0 THEN rec ELSE 0.0 END) / sum(CASE WHEN support > 0 THEN 1 ELSE 0 END) AS ba,
           avg(f1) AS mf1, max(CASE WHEN c = 2 THEN rec END) AS hr FROM pf GROUP BY model),
gd AS (SELECT CASE WHEN cl.ba - ch.ba > 0.001 THEN 'PROMOTE challenger' ELSE 'HOLD champion' END AS decision
       FROM side ch, side cl WHERE ch.model = 'champion' AND cl.model = 'challenger')"""


@register(
    "drift_decision",
    _METRICS_SQL + _SIDE_SQL + _DATASET_SQL.replace("WITH r AS", ", r AS", 1)
    + """, dd AS (SELECT n_drifted / n_columns >= 0.5 AS d FROM ds)
SELECT d AS drift, CASE WHEN d THEN gd.decision END AS decision,
       CASE WHEN NOT d THEN 0 WHEN gd.decision LIKE 'PROMOTE%' THEN 2 ELSE 3 END AS exit_code,
       CASE WHEN NOT d THEN 'OK' WHEN gd.decision LIKE 'PROMOTE%' THEN 'ACT' ELSE 'INVESTIGATE' END AS verdict
FROM dd, gd""",
)
def q_drift_decision(spark, sf):
    """Verdict from the dataset drift and the gate's decision (the gate of
    the two order models says HOLD, so drift would mean INVESTIGATE)."""
    ref, cur = _drift_frames(spark, sf)
    d = dataset_drift(column_drift(ref, cur, _DRIFT_NUM, _DRIFT_CAT))
    g = gate(scored_orders(spark, sf), "y", "champion", "challenger", CLASSES, focus=2)
    return drift_decision(d, g)


# ---- monitoring ----------------------------------------------------------------
@register("pred_counts", "SELECT event_type, count(*) AS count FROM events GROUP BY event_type")
def q_pred_counts(spark, sf):
    """Count per class label (event type stands in for the predicted class)."""
    return predictions_by_class(t(spark, sf, "events"), "event_type")


@register(
    "sliding_rate",
    """WITH b AS (SELECT epoch_us(ts) // 5000000 AS b, count(*) AS n FROM events GROUP BY 1),
w AS (SELECT (b - j) * 5 AS window_start, n FROM b, range(0, 12) t(j))
SELECT CAST(window_start AS BIGINT) AS window_start, CAST(window_start + 60 AS BIGINT) AS window_end,
       CAST(sum(n) AS BIGINT) AS events, round(sum(n) / 60.0, 6) AS rate FROM w GROUP BY window_start""",
)
def q_sliding_rate(spark, sf):
    """Events per second over 1-minute windows sliding by 5 s."""
    return rounded(sliding_rate(t(spark, sf, "events"), "ts", 60, 5))


@register(
    "sliding_p95",
    """WITH w AS (SELECT (epoch_us(ts) // 60000000 - j) * 60 AS window_start, value FROM events, range(0, 5) t(j))
SELECT CAST(window_start AS BIGINT) AS window_start, round(quantile_cont(value, 0.95), 6) AS p95,
       count(*) AS events, CAST(window_start + 300 AS BIGINT) AS window_end FROM w GROUP BY window_start""",
)
def q_sliding_p95(spark, sf):
    """Exact p95 of event value over 5-minute windows sliding by 1 minute."""
    return rounded(sliding_quantile(t(spark, sf, "events"), "ts", "value", 0.95, 300, 60))


@register(
    "sliding_errors",
    """WITH b AS (SELECT epoch_us(ts) // 60000000 AS b, count(*) AS n,
                  sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS e FROM events GROUP BY 1),
w AS (SELECT (b - j) * 60 AS window_start, n, e FROM b, range(0, 5) t(j))
SELECT CAST(window_start AS BIGINT) AS window_start, CAST(window_start + 300 AS BIGINT) AS window_end,
       CAST(sum(n) AS BIGINT) AS events, CAST(sum(e) AS BIGINT) AS errors, round(sum(e) / sum(n), 6) AS error_rate
FROM w GROUP BY window_start""",
)
def q_sliding_errors(spark, sf):
    """Error share over 5-minute windows sliding by 1 minute."""
    e = t(spark, sf, "events")
    return rounded(sliding_error_rate(e, "ts", F.col("event_type") == "error", 300, 60))
