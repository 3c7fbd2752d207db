"""Catalogue: group statistics, quantiles, lookups, shares, profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from furrow.operators.groups import (
    correlation_long,
    density_curve,
    describe_table,
    distribution_profile,
    group_quantiles,
    group_stats,
    histogram,
    merge_sketches,
    quantile_sketches,
    sketch_quantiles,
    value_share,
)
from furrow.operators.impute import fill_from_values, medians
from furrow.operators.lookups import join_lookup
from furrow.plans.catalog import r, register, rounded, t

_SQL_STAT = {
    "mean": "avg({c})",
    "std": "stddev_samp({c})",
    "count": "count({c})",
    "nunique": "count(DISTINCT {c})",
    "median": "quantile_cont({c}, 0.5)",
    "min": "min({c})",
    "max": "max({c})",
}
_INT_STATS = {"count", "nunique"}


def group_stats_sql(table: str, key: str, cols: list[str], stats: list[str], ratios: bool) -> str:
    items = []
    for c in cols:
        for s in stats:
            items.append(f'{_SQL_STAT[s].format(c=c)} AS "FE_{key}_{c}_{s}"')
    inner = f"SELECT {key}, {', '.join(items)} FROM {table} GROUP BY {key}"
    outs = []
    for c in cols:
        for s in stats:
            n = f"FE_{key}_{c}_{s}"
            outs.append(f'g."{n}"' if s in _INT_STATS else r(f'g."{n}"', n))
    if ratios:
        for c in cols:
            cnt, nun, sd = (f'g."FE_{key}_{c}_{s}"' for s in ("count", "nunique", "std"))
            outs.append(r(f"{cnt} / (NULLIF({nun}, 0) + 1e-6)", f"FE_{key}_{c}_count_per_nunique"))
            outs.append(r(f"{sd} / (NULLIF({cnt}, 0) + 1e-6)", f"FE_{key}_{c}_std_per_count"))
    return f"WITH g AS ({inner})", outs


_GS_COLS = ["l_quantity", "l_extendedprice"]
_GS_STATS = ["mean", "std", "count", "nunique", "median", "min", "max"]
_cte, _outs = group_stats_sql("lineitem", "l_returnflag", _GS_COLS, _GS_STATS, True)
GROUP_STATS_SQL = (
    f"{_cte} SELECT l.l_orderkey, l.l_linenumber, l.l_returnflag, {', '.join(_outs)} "
    "FROM lineitem l LEFT JOIN g ON l.l_returnflag IS NOT DISTINCT FROM g.l_returnflag"
)


@register("group_stats", GROUP_STATS_SQL)
def q_group_stats(spark, sf):
    """F1 + F3 + B2: lineitem stats by return flag joined back to every row."""
    li = t(spark, sf, "lineitem")
    lk = group_stats(li, "l_returnflag", _GS_COLS, _GS_STATS, ratios=True)
    rows = li.select("l_orderkey", "l_linenumber", "l_returnflag")
    return rounded(join_lookup(rows, lk, ["l_returnflag"]))


_PCTS = [10, 25, 50, 75, 90]
GROUP_QUANTILES_SQL = (
    "WITH g AS (SELECT l_linestatus, "
    + ", ".join(
        f'quantile_cont(l_extendedprice, {p / 100!r}) AS "FE_l_linestatus_l_extendedprice_q{p}"' for p in _PCTS
    )
    + " FROM lineitem GROUP BY l_linestatus) "
    "SELECT l.l_orderkey, l.l_linenumber, l.l_linestatus, "
    + ", ".join(r(f'g."FE_l_linestatus_l_extendedprice_q{p}"', f"FE_l_linestatus_l_extendedprice_q{p}") for p in _PCTS)
    + " FROM lineitem l LEFT JOIN g ON l.l_linestatus IS NOT DISTINCT FROM g.l_linestatus"
)


@register("group_quantiles", GROUP_QUANTILES_SQL)
def q_group_quantiles(spark, sf):
    """exact p10..p90 of extended price per line status, joined back."""
    li = t(spark, sf, "lineitem")
    lk = group_quantiles(li, "l_linestatus", "l_extendedprice", _PCTS)
    rows = li.select("l_orderkey", "l_linenumber", "l_linestatus")
    return rounded(join_lookup(rows, lk, ["l_linestatus"]))


APPLY_LOOKUP_SQL = """
WITH lk AS (
  SELECT o_custkey, avg(o_totalprice) AS hist_mean, count(o_totalprice) AS hist_count,
         max(o_totalprice) AS hist_max
  FROM orders WHERE o_orderdate < TIMESTAMP '1997-01-01' GROUP BY o_custkey),
med AS (SELECT quantile_cont(hist_mean, 0.5) AS m_mean, quantile_cont(hist_count, 0.5) AS m_count,
               quantile_cont(hist_max, 0.5) AS m_max FROM lk)
SELECT c.c_custkey, c.c_mktsegment,
       round(coalesce(lk.hist_mean, med.m_mean), 6) AS hist_mean,
       round(coalesce(CAST(lk.hist_count AS DOUBLE), med.m_count), 6) AS hist_count,
       round(coalesce(lk.hist_max, med.m_max), 6) AS hist_max,
       CASE WHEN lk.o_custkey IS NULL THEN 1 ELSE 0 END AS unseen
FROM customer c LEFT JOIN lk ON c.c_custkey = lk.o_custkey CROSS JOIN med
"""


@register("apply_lookup_unseen", APPLY_LOOKUP_SQL)
def q_apply_lookup_unseen(spark, sf):
    """Customer order-history lookup fitted on orders before 1997,
    applied to all customers; unseen customers get the fitted medians."""
    orders = t(spark, sf, "orders").where(F.col("o_orderdate") < F.lit("1997-01-01").cast("timestamp"))
    lk = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.avg("o_totalprice").alias("hist_mean"),
        F.count("o_totalprice").cast("double").alias("hist_count"),
        F.max("o_totalprice").alias("hist_max"),
        F.lit(0).alias("unseen"),
    )
    fill = medians(lk, ["hist_mean", "hist_count", "hist_max"])
    cust = t(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    out = join_lookup(cust, lk, ["c_custkey"], null_safe=False)
    out = fill_from_values(out, fill).fillna({"unseen": 1})
    return rounded(out)


@register(
    "class_share",
    "SELECT o_orderstatus, count(*) AS count, "
    "round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS percent FROM orders GROUP BY o_orderstatus",
)
def q_class_share(spark, sf):
    """count and share per order status."""
    return rounded(value_share(t(spark, sf, "orders"), ["o_orderstatus"]))


_DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DESCRIBE_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count({c}) AS count, CAST(count(*) - count({c}) AS BIGINT) AS nulls, "
    f"round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, "
    f"round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50, "
    f"round(quantile_cont({c}, 0.75), 6) AS q75, round(max({c}), 6) AS max FROM lineitem"
    for c in _DESC_COLS
)


@register("describe", DESCRIBE_SQL)
def q_describe(spark, sf):
    """describe() of lineitem numerics with exact quartiles and null counts."""
    return rounded(describe_table(t(spark, sf, "lineitem"), _DESC_COLS))


_CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
CORR_SQL = " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS corr FROM lineitem"
    for i, a in enumerate(_CORR_COLS)
    for b in _CORR_COLS[i + 1:]
)


@register("correlation", CORR_SQL)
def q_correlation(spark, sf):
    """F8: pairwise Pearson correlation among lineitem numerics."""
    return rounded(correlation_long(t(spark, sf, "lineitem"), _CORR_COLS))


PROFILE_SQL = """
WITH q AS (
  SELECT p_type, quantile_cont(p_retailprice, 0.0) AS min, quantile_cont(p_retailprice, 0.25) AS q1,
         quantile_cont(p_retailprice, 0.5) AS median, quantile_cont(p_retailprice, 0.75) AS q3,
         quantile_cont(p_retailprice, 1.0) AS max
  FROM part GROUP BY p_type),
f AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM q)
SELECT f.p_type, count(p.p_retailprice) AS n, round(avg(p.p_retailprice), 6) AS mean,
       CAST(sum(CASE WHEN p.p_retailprice < f.lower_fence OR p.p_retailprice > f.upper_fence THEN 1 ELSE 0 END) AS BIGINT) AS outliers,
       round(min(CASE WHEN p.p_retailprice >= f.lower_fence THEN p.p_retailprice END), 6) AS whisker_low,
       round(max(CASE WHEN p.p_retailprice <= f.upper_fence THEN p.p_retailprice END), 6) AS whisker_high,
       round(any_value(f.min), 6) AS min, round(any_value(f.q1), 6) AS q1, round(any_value(f.median), 6) AS median,
       round(any_value(f.q3), 6) AS q3, round(any_value(f.max), 6) AS max, round(any_value(f.iqr), 6) AS iqr,
       round(any_value(f.lower_fence), 6) AS lower_fence, round(any_value(f.upper_fence), 6) AS upper_fence
FROM part p JOIN f ON p.p_type = f.p_type GROUP BY f.p_type
"""


@register("histogram_profile", PROFILE_SQL)
def q_histogram_profile(spark, sf):
    """box-plot summary, whiskers and outlier counts of part price per type."""
    out = distribution_profile(t(spark, sf, "part"), "p_retailprice", ["p_type"])
    return rounded(out.withColumn("outliers", F.col("outliers").cast("long")))


@register(
    "histogram",
    "SELECT o_orderstatus, CAST(CASE WHEN o_totalprice < 0 THEN 0 WHEN o_totalprice >= 500000 THEN 21 "
    "ELSE floor(20.0 * (o_totalprice - 0.0) / 500000.0) + 1 END AS BIGINT) AS bucket, count(*) AS count "
    "FROM orders GROUP BY ALL",
)
def q_histogram(spark, sf):
    """20 equal-width buckets of order price per status."""
    h = histogram(t(spark, sf, "orders"), "o_totalprice", ["o_orderstatus"], 0.0, 500000.0, 20)
    return h.withColumn("bucket", F.col("bucket").cast("long"))


DENSITY_SQL = """WITH b AS (SELECT l_returnflag, CAST(l_quantity AS DOUBLE) AS v FROM lineitem WHERE l_quantity IS NOT NULL),
s0 AS (SELECT l_returnflag, count(v) AS n, stddev_samp(v) * power(CAST(count(v) AS DOUBLE), -0.2) AS bw, min(v) AS least, max(v) AS most FROM b GROUP BY 1),
s AS (SELECT l_returnflag, n, bw, least - 3 * bw AS lo, most + 3 * bw AS hi, ((most + 3 * bw) - (least - 3 * bw)) / 2048 AS step FROM s0 WHERE least < most),
p AS (SELECT b.l_returnflag, (v - lo) / step AS p FROM b JOIN s USING (l_returnflag)),
e AS (SELECT l_returnflag, edge, sum(w) AS w FROM (
    SELECT l_returnflag, floor(p) AS edge, 1 - (p - floor(p)) AS w FROM p UNION ALL SELECT l_returnflag, floor(p) + 1, p - floor(p) FROM p) GROUP BY 1, 2)
SELECT l_returnflag, CAST(j AS INTEGER) AS point, round(lo + j * ((hi - lo) / 199), 6) AS x,
    round(sum(w * exp(-0.5 * power((j * ((hi - lo) / 199) - edge * step) / bw, 2))) / (any_value(n) * any_value(bw) * sqrt(2 * pi())), 6) AS density
FROM s JOIN e USING (l_returnflag), range(0, 200) g(j) GROUP BY l_returnflag, j, lo, hi"""


@register("density_curve", DENSITY_SQL)
def q_density_curve(spark, sf):
    """density of the quantity of each return flag on 200 points."""
    return rounded(density_curve(t(spark, sf, "lineitem"), "l_quantity", ["l_returnflag"]))


@register("group_quantiles_sketch")
def q_group_quantiles_sketch(spark, sf):
    """F2, fast mode: p10..p90 of extended price per line status, from sketches of each status and year that are merged."""
    li = t(spark, sf, "lineitem").withColumn("year", F.year("l_shipdate"))
    parts = quantile_sketches(li, ["l_linestatus", "year"], "l_extendedprice")
    whole = merge_sketches(parts, ["l_linestatus"])
    return sketch_quantiles(whole, ["l_linestatus"], [p / 100 for p in _PCTS], [f"q{p}" for p in _PCTS])
