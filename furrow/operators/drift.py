"""Data drift between a reference and a current frame.

The per-column tests of the original come from an external library; the
statistics here are our own choice, following that library's defaults for
large data: numeric columns use the 1-Wasserstein distance divided by the
reference standard deviation (drift at >= 0.1) or, on request, the two-sample
KS statistic against its 5 % asymptotic critical value; categorical columns use
the Jensen-Shannon distance (natural log, drift at >= 0.1). The other
statistics are reported next to it: PSI (numeric columns over ten bins of equal
share of the reference) and the chi-square of the two rows of counts.

NULL, NaN and infinite values are missing values. Every requested column is in
the report, with its missing shares; a column with values on one side only has
drifted, one without any has not.

Both CDFs come from value counts per ``(column, value)`` followed by the
distributed running sums of :mod:`furrow.operators.ranking`, so a column with
billions of distinct values is never sorted in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from furrow.functions.nulls import inf_to_null
from furrow.operators.lookups import join_lookup
from furrow.operators.ranking import cumulative_sums

KS_C_ALPHA_05 = 1.358  # sqrt(-ln(0.05 / 2) / 2)
PSI_EPS = 0.0001


def _long(ref: DataFrame, cur: DataFrame, cols: list[str], numeric: bool) -> DataFrame:
    def value(c: str):
        return inf_to_null(F.col(c).cast("double")) if numeric else F.col(c).cast("string")

    def side(df: DataFrame, is_ref: int) -> DataFrame:
        vals = [F.struct(F.lit(c).alias("column"), value(c).alias("value")) for c in cols]
        return df.select(F.explode(F.array(*vals)).alias("s"), F.lit(is_ref).alias("is_ref")).select(
            "s.column", "s.value", "is_ref")

    return side(ref, 1).unionByName(side(cur, 0))


def _counts(long: DataFrame) -> DataFrame:
    """Rows per (column, value) on both sides; the missing ones under a NULL value."""
    return long.groupBy("column", "value").agg(
        F.sum("is_ref").cast("long").alias("n_ref"), F.sum(1 - F.col("is_ref")).cast("long").alias("n_cur")
    )


def _totals(counts: DataFrame, cols: list[str]) -> DataFrame:
    """Per requested column: rows with a value and shares of rows without, on both sides."""
    has = F.col("value").isNotNull()
    seen = counts.groupBy("column").agg(
        F.sum(F.when(has, F.col("n_ref")).otherwise(0)).alias("tot_ref"),
        F.sum(F.when(has, F.col("n_cur")).otherwise(0)).alias("tot_cur"),
        F.sum("n_ref").alias("rows_ref"), F.sum("n_cur").alias("rows_cur"),
    )
    asked = counts.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    full = asked.join(F.broadcast(seen), "column", "left").fillna(0)  # one row a column
    return full.select(
        "column", "tot_ref", "tot_cur",
        F.try_divide(F.col("rows_ref") - F.col("tot_ref"), F.col("rows_ref")).alias("missing_ref"),
        F.try_divide(F.col("rows_cur") - F.col("tot_cur"), F.col("rows_cur")).alias("missing_cur"),
    )


def _verdict(measured) -> Column:
    """A column with values on one side only has drifted; without any, it has not."""
    one = (F.col("n_ref") > 0) != (F.col("n_cur") > 0)
    return F.when(one, True).otherwise(F.coalesce(measured, F.lit(False)))


def _psi(p, q):
    pe = F.when(p > 0, p).otherwise(PSI_EPS)
    qe = F.when(q > 0, q).otherwise(PSI_EPS)
    return (qe - pe) * F.log(qe / pe)


def numeric_drift(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: ``n_ref, n_cur, missing_ref, missing_cur, ks_stat, ks_critical, wasserstein_norm, psi``."""
    return _numeric(_counts(_long(ref, cur, cols, numeric=True)), cols)


def _numeric(every: DataFrame, cols: list[str]) -> DataFrame:
    totals = _totals(every, cols)
    counts = every.where(F.col("value").isNotNull())
    cum = cumulative_sums(counts, ["column"], ["value"], {"n_ref": "c_ref", "n_cur": "c_cur"})
    cum = join_lookup(cum, totals, ["column"], known_small=True)  # one row a column
    share = lambda c, tot: F.try_divide(F.col(c), F.col(tot))
    after = F.abs(share("c_ref", "tot_ref") - share("c_cur", "tot_cur"))
    before = F.abs(F.try_divide(F.col("c_ref") - F.col("n_ref"), F.col("tot_ref"))
                   - F.try_divide(F.col("c_cur") - F.col("n_cur"), F.col("tot_cur")))
    # the integral of the gap between the CDFs, summed by parts: no neighbour is needed
    per = cum.groupBy("column").agg(
        F.max(after).alias("ks_stat"), F.sum(F.col("value") * (before - after)).alias("wasserstein"),
        F.try_divide(F.sum(F.col("n_ref") * F.col("value")), F.sum("n_ref")).alias("mean"),
    )
    # the reference's spread around its mean, in a second sum over the counts
    spread = join_lookup(counts, per.select("column", "mean"), ["column"], known_small=True).groupBy("column").agg(
        F.sqrt(F.try_divide(F.sum(F.col("n_ref") * F.pow(F.col("value") - F.col("mean"), 2)), F.sum("n_ref"))).alias("ref_std"))
    decile = F.least(F.floor(F.try_divide(10 * (F.col("c_ref") - F.col("n_ref")), F.col("tot_ref"))), F.lit(9))
    bins = cum.groupBy("column", decile.alias("bin"), "tot_ref", "tot_cur").agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur"))
    psi = bins.groupBy("column").agg(F.sum(_psi(share("n_ref", "tot_ref"), share("n_cur", "tot_cur"))).alias("psi"))
    out = totals
    for part in (per.drop("mean"), spread, psi):
        out = join_lookup(out, part, ["column"], known_small=True)
    n_ref, n_cur = F.col("tot_ref"), F.col("tot_cur")
    both = (n_ref > 0) & (n_cur > 0)
    crit = F.lit(KS_C_ALPHA_05) * F.sqrt(F.try_divide(n_ref + n_cur, n_ref * n_cur))
    return out.select(
        "column", n_ref.alias("n_ref"), n_cur.alias("n_cur"), "missing_ref", "missing_cur",
        F.when(both, F.col("ks_stat")).alias("ks_stat"), crit.alias("ks_critical"),
        F.when(both & (F.col("ref_std") > 0), F.col("wasserstein") / F.col("ref_std")).alias("wasserstein_norm"),
        F.when(both, F.col("psi")).alias("psi"),
    )


def categorical_drift(ref: DataFrame, cur: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: ``n_ref, n_cur, missing_ref, missing_cur, js_distance, psi, chi_square``."""
    return _categorical(_counts(_long(ref, cur, cols, numeric=False)), cols)


def _categorical(every: DataFrame, cols: list[str]) -> DataFrame:
    totals = _totals(every, cols)
    c = join_lookup(every.where(F.col("value").isNotNull()), totals, ["column"], known_small=True)
    p = F.try_divide(F.col("n_ref"), F.col("tot_ref"))
    q = F.try_divide(F.col("n_cur"), F.col("tot_cur"))
    m = (p + q) / 2.0
    kl_p = F.when(p > 0, p * F.log(p / m)).otherwise(0.0)
    kl_q = F.when(q > 0, q * F.log(q / m)).otherwise(0.0)
    rows = F.col("tot_ref") + F.col("tot_cur")
    both = F.col("n_ref") + F.col("n_cur")
    cell = lambda n, tot: F.try_divide(F.pow(F.col(n) - both * F.col(tot) / rows, 2), both * F.col(tot) / rows)
    per = c.groupBy("column").agg(
        F.sum(kl_p).alias("kl_p"), F.sum(kl_q).alias("kl_q"), F.sum(_psi(p, q)).alias("psi"),
        F.sum(cell("n_ref", "tot_ref") + cell("n_cur", "tot_cur")).alias("chi_square"),
    )
    out = join_lookup(totals, per, ["column"], known_small=True)
    ok = (F.col("tot_ref") > 0) & (F.col("tot_cur") > 0)
    js = F.sqrt(F.greatest(F.lit(0.0), 0.5 * F.col("kl_p") + 0.5 * F.col("kl_q")))
    return out.select("column", F.col("tot_ref").alias("n_ref"), F.col("tot_cur").alias("n_cur"), "missing_ref", "missing_cur",
                      F.when(ok, js).alias("js_distance"), F.when(ok, F.col("psi")).alias("psi"),
                      F.when(ok, F.col("chi_square")).alias("chi_square"))


def column_drift(
    ref: DataFrame,
    cur: DataFrame,
    numeric: list[str],
    categorical: list[str],
    threshold: float = 0.1,
    numeric_method: str = "wasserstein",
) -> DataFrame:
    """One row per requested column: ``column, kind, method, statistic,
    threshold, drifted``, the missing shares and the other statistics.

    ``numeric_method``: ``wasserstein`` (at ``threshold``) or ``ks`` (at its
    critical value), whatever the size.
    """
    if numeric_method not in ("wasserstein", "ks"):
        raise ValueError("numeric_method is wasserstein or ks")
    return _report(numeric_drift(ref, cur, numeric) if numeric else None,
                   categorical_drift(ref, cur, categorical) if categorical else None, threshold, numeric_method)


def _report(nd: DataFrame | None, cd: DataFrame | None, threshold: float, numeric_method: str) -> DataFrame:
    none = F.lit(None).cast("double")
    parts = []
    if nd is not None:
        if numeric_method == "ks":
            statistic, limit = F.col("ks_stat"), F.col("ks_critical")
            measured = statistic > limit
        else:
            statistic, limit = F.col("wasserstein_norm"), F.lit(threshold)
            measured = statistic >= limit
        parts.append(nd.select(
            "column", F.lit("numeric").alias("kind"), F.lit(numeric_method).alias("method"), statistic.alias("statistic"),
            limit.alias("threshold"), _verdict(measured).alias("drifted"), "missing_ref", "missing_cur",
            "ks_stat", "wasserstein_norm", none.alias("js_distance"), "psi", none.alias("chi_square"),
        ))
    if cd is not None:
        parts.append(cd.select(
            "column", F.lit("categorical").alias("kind"), F.lit("jensenshannon").alias("method"),
            F.col("js_distance").alias("statistic"), F.lit(threshold).alias("threshold"),
            _verdict(F.col("js_distance") >= threshold).alias("drifted"), "missing_ref", "missing_cur",
            none.alias("ks_stat"), none.alias("wasserstein_norm"), "js_distance", "psi", "chi_square",
        ))
    return reduce(lambda a, b: a.unionByName(b), parts)


def value_counts(df: DataFrame, numeric: list[str], categorical: list[str], by: list[Column]) -> DataFrame:
    """Rows ``*by, kind, column, number, text, n``: how often each column has each value, missing ones under NULL.
    ``number`` holds those of numeric columns, ``text`` those of the others."""
    cells = [F.struct(F.lit("numeric").alias("kind"), F.lit(c).alias("column"), inf_to_null(F.col(c).cast("double")).alias("number"),
                      F.lit(None).cast("string").alias("text")) for c in numeric]
    cells += [F.struct(F.lit("categorical").alias("kind"), F.lit(c).alias("column"), F.lit(None).cast("double").alias("number"),
                       F.col(c).cast("string").alias("text")) for c in categorical]
    long = df.withColumn("__s", F.explode(F.array(*cells)))
    return long.groupBy(*by, F.col("__s.kind").alias("kind"), F.col("__s.column").alias("column"), F.col("__s.number").alias("number"),
                        F.col("__s.text").alias("text")).agg(F.count(F.lit(1)).alias("n"))


def drift_of_counts(ref: DataFrame, cur: DataFrame, numeric: list[str], categorical: list[str], windows: list[int],
                    threshold: float = 0.1, numeric_method: str = "wasserstein") -> DataFrame:
    """J1 of several windows at once, from counts: ``window_start``, then the columns of :func:`column_drift`.

    ``ref``: :func:`value_counts` of the reference; ``cur``: those of the windows, with ``window_start``, which
    are listed in ``windows``. The reference's counts are repeated for each of them.
    """
    at = F.col("window_start").cast("string")
    starts = F.array(*[F.lit(w).cast("long") for w in windows]).cast("array<long>")
    both = ref.withColumn("window_start", F.explode(starts)).select("window_start", "kind", "column", "number", "text", F.col("n").alias("n_ref"), F.lit(0).alias("n_cur")).unionByName(
        cur.select("window_start", "kind", "column", "number", "text", F.lit(0).alias("n_ref"), F.col("n").alias("n_cur")))

    def side(kind: str, value: str, cols: list[str]):
        if not cols:
            return None
        # each window's column is a column of its own: its start, a bar, its name
        every = both.where(F.col("kind") == kind).groupBy(F.concat(at, F.lit("|"), "column").alias("column"), F.col(value).alias("value")).agg(
            F.sum("n_ref").cast("long").alias("n_ref"), F.sum("n_cur").cast("long").alias("n_cur"))
        names = [f"{w}|{c}" for w in windows for c in cols]
        return (_numeric if kind == "numeric" else _categorical)(every, names)

    report = _report(side("numeric", "number", numeric), side("categorical", "text", categorical), threshold, numeric_method)
    start = F.substring_index("column", "|", 1).cast("long")
    name = F.expr("substring(`column`, instr(`column`, '|') + 1)")
    return report.select(start.alias("window_start"), name.alias("column"), *[c for c in report.columns if c != "column"])


def dataset_drift(col_drift: DataFrame, share_threshold: float = 0.5) -> DataFrame:
    """Drifted column count, share, and the verdict ``share >= threshold``."""
    return col_drift.agg(
        F.count(F.lit(1)).alias("n_columns"),
        F.sum(F.col("drifted").cast("int")).cast("long").alias("n_drifted"),
    ).select(
        "n_columns", "n_drifted",
        F.try_divide(F.col("n_drifted"), F.col("n_columns")).alias("share"),
        (F.try_divide(F.col("n_drifted"), F.col("n_columns")) >= share_threshold).alias("dataset_drift"),
    )


# Exit-code contract of the drift loop (fixed values).
LOOP_OK, LOOP_FAILED, LOOP_ACT, LOOP_INVESTIGATE = 0, 1, 2, 3


def drift_decision(drift: DataFrame | None, gate: DataFrame | None) -> DataFrame:
    """OK (0) without drift; with drift ACT (2) on PROMOTE, INVESTIGATE (3)
    on HOLD; FAILED (1) when the drift verdict or, with drift, the gate is
    missing. The gate is only consulted when there is drift."""
    if drift is None or "dataset_drift" not in drift.columns:
        raise ValueError("drift metric missing: cannot decide (the job failed)")
    if gate is None:
        dec = drift.select("dataset_drift", F.lit(None).cast("string").alias("decision"))
    else:
        dec = join_lookup(drift.withColumn("__one", F.lit(1)),
                          gate.select(F.lit(1).alias("__one"), "decision"), ["__one"]).drop("__one")
    code = (
        F.when(F.col("dataset_drift").isNull(), LOOP_FAILED)
        .when(~F.col("dataset_drift"), LOOP_OK)
        .when(F.col("decision").isNull(), LOOP_FAILED)
        .when(F.col("decision").startswith("PROMOTE"), LOOP_ACT)
        .otherwise(LOOP_INVESTIGATE)
    )
    verdict = F.element_at(F.create_map(*[F.lit(x) for kv in {0: "OK", 1: "FAILED", 2: "ACT",
                                                               3: "INVESTIGATE"}.items() for x in kv]), code)
    return dec.select(F.col("dataset_drift").alias("drift"),
                      F.when(F.col("dataset_drift"), F.col("decision")).alias("decision"),
                      code.alias("exit_code"), verdict.alias("verdict"))
