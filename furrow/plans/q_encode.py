"""Catalogue: encodings, target encoding, sampling, imputation and small
source operators (A2-A5, A8, B4-B9, E4, E5, E10-E12, G1-G5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from furrow.functions import crosses
from furrow.functions.nulls import inf_to_null, to_numeric
from furrow.operators.encoders import (
    anchor_combos,
    count_encode,
    fit_frequency_rank,
    fit_sorted_codes,
)
from furrow.operators.impute import drop_constant, fill_combined
from furrow.operators.target import (
    TargetEncoder,
    TargetGlobals,
    class_counts,
    effective_splits,
    stratified_folds,
    target_encode_oof,
)
from furrow.plans import irrigation as irr
from furrow.plans.catalog import r, register, rounded, t
from furrow.plans.field_view import ROLE_SQL, field_rows
from furrow.sources.sampling import (
    drop_duplicates,
    label_map,
    portable_hash,
    sample_exact,
    stratified_sample_exact,
)
from furrow.sources.tables import union_sources

CAT = irr.BASE_CATEGORICAL_COLS
GROUPS = [*irr.CROSS_PAIRS, *irr.CROSS_TRIPLETS]
CROSS_NAMES = ["__".join(g) for g in GROUPS]


def _q(c):
    return f'"{c}"'


def _nan_key(c):
    return f"coalesce(CAST({_q(c)} AS VARCHAR), 'nan')"


# ---- E4 -----------------------------------------------------------------------
def _count_encode_sql() -> str:
    sep = " || '__' || "
    cross_items = ", ".join(f"{sep.join(_nan_key(c) for c in g)} AS {_q('__'.join(g))}" for g in GROUPS)
    cols = [*CAT, *CROSS_NAMES]
    joins, outs = [], []
    for i, c in enumerate(cols):
        joins.append(
            f"LEFT JOIN (SELECT {_q(c)} AS v, count(*) AS n FROM x WHERE split = 'train' AND {_q(c)} IS NOT NULL "
            f"GROUP BY {_q(c)}) j{i} ON x.{_q(c)} = j{i}.v"
        )
        outs.append(f"CAST(coalesce(j{i}.n, 0) AS FLOAT) AS {_q('ce_' + c)}")
    return (f"{ROLE_SQL}, x AS (SELECT *, {cross_items} FROM field) "
            f"SELECT x.id, {', '.join(outs)} FROM x {' '.join(joins)}")


@register("count_encode", _count_encode_sql())
def q_count_encode(spark, sf):
    """E3 + E4: 14 crosses plus the 8 categories, frequency fitted on the train
    split and applied to all rows (unseen -> 0)."""
    f = field_rows(spark, sf)
    f = f.select("*", *crosses.nway_crosses(GROUPS))
    cols = [*CAT, *CROSS_NAMES]
    out = count_encode(f.where(F.col("split") == "train"), f, cols)
    return out.select("id", *[f"ce_{c}" for c in cols])


# ---- E5 -----------------------------------------------------------------------
_FR_COLS = ["Irrigation_Type", "Region", "Crop_Type"]
_FR_MIN = 250


def _freq_rank_sql() -> str:
    ctes, outs = [], []
    for i, c in enumerate(_FR_COLS):
        ctes.append(
            f"m{i} AS (SELECT v, row_number() OVER (ORDER BY n DESC, v) - 1 AS code FROM "
            f"(SELECT {_q(c)} AS v, count(*) AS n FROM field WHERE split = 'train' AND {_q(c)} IS NOT NULL "
            f"GROUP BY {_q(c)}) WHERE n >= {_FR_MIN})"
        )
        outs.append(f"CAST(coalesce((SELECT code FROM m{i} WHERE m{i}.v = field.{_q(c)}), "
                    f"(SELECT count(*) FROM m{i})) AS INTEGER) AS {_q(c)}")
    return f"{ROLE_SQL}, {', '.join(ctes)} SELECT id, {', '.join(outs)} FROM field"


@register("frequency_rank", _freq_rank_sql())
def q_frequency_rank(spark, sf):
    """E5: frequency-rank codes (values seen >= 250 times on train), in place."""
    f = field_rows(spark, sf)
    enc = fit_frequency_rank(f.where(F.col("split") == "train"), _FR_COLS, _FR_MIN)
    return enc.transform(f.select("id", *_FR_COLS), _FR_COLS, replace=True)


# ---- E10-E12 --------------------------------------------------------------------
def _sorted_codes_sql(unseen: str, with_anchors: bool) -> str:
    ctes, outs, joins = [], [], []
    for i, c in enumerate(CAT):
        key = f"coalesce(CAST({_q(c)} AS VARCHAR), 'Missing')"
        ctes.append(f"m{i} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS code FROM "
                    f"(SELECT DISTINCT {key} AS v FROM field WHERE split = 'train'))")
        default = "-1" if unseen == "minus_one" else f"(SELECT count(*) FROM m{i})"
        joins.append(f"LEFT JOIN m{i} ON {key.replace(_q(c), 'field.' + _q(c))} = m{i}.v")
        code = f"CAST(coalesce(m{i}.code, {default}) AS INTEGER)"
        name = f"{c}_factorized" if with_anchors else c
        outs.append(f"{code} AS {_q(name)}")
        if with_anchors:
            for a in irr.ANCHOR_NUMERIC_COLS:
                outs.append(r(f"CAST({code} AS DOUBLE) * 1000.0 + field.{_q(a)}", f"{c}_{a}_combo"))
    return f"{ROLE_SQL}, {', '.join(ctes)} SELECT field.id, {', '.join(outs)} FROM field {' '.join(joins)}"


@register("factorize", _sorted_codes_sql("minus_one", True))
def q_factorize(spark, sf):
    """E10 + E11: sorted codes of the filled categories fitted on train
    (unseen -> -1) and the 32 ``code * 1000 + anchor`` combos."""
    f = field_rows(spark, sf)
    enc = fit_sorted_codes(f.where(F.col("split") == "train"), CAT, unseen="minus_one")
    coded = enc.transform(f, CAT, suffix="_factorized")
    names = [f"{c}_factorized" for c in CAT]
    return rounded(coded.select("id", *[x for c in names for x in
                                        [F.col(c), *anchor_combos(coded, [c], irr.ANCHOR_NUMERIC_COLS)]]))


@register("label_encode", _sorted_codes_sql("size", False))
def q_label_encode(spark, sf):
    """Alphabetical label codes fitted on train, unseen -> number of classes."""
    f = field_rows(spark, sf)
    enc = fit_sorted_codes(f.where(F.col("split") == "train"), CAT, unseen="size")
    return enc.transform(f.select("id", *CAT), CAT, replace=True)


# ---- G1-G5 --------------------------------------------------------------------
_TE_KEYS = ["lang", "source", "lang_source"]
_TR_SQL = """
WITH tr AS (
  SELECT d.doc_id, d.lang, d.source, d.lang || '__' || d.source AS lang_source, l.quality AS y
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
k AS (SELECT greatest(2, least(5, min(c))) AS k FROM (SELECT count(*) AS c FROM tr GROUP BY y)),
f AS (SELECT tr.*, CAST((row_number() OVER (PARTITION BY y ORDER BY doc_id) - 1) % (SELECT k FROM k) AS INTEGER) AS fold
      FROM tr),
g AS (SELECT avg(y) AS gm, CASE WHEN count(y) > 1 THEN stddev_samp(y) ELSE 0.0 END AS gs,
             avg(CASE WHEN y = 0 THEN 1.0 ELSE 0.0 END) AS r0, avg(CASE WHEN y = 1 THEN 1.0 ELSE 0.0 END) AS r1 FROM f)
"""


def _te_stat_sql(n, s, q, c0, c1, key):
    nd, sd, qd = f"CAST({n} AS DOUBLE)", f"CAST({s} AS DOUBLE)", f"CAST({q} AS DOUBLE)"
    var = f"(({qd} - {sd} * {sd} / {nd}) / ({nd} - 1.0))"
    return [
        r(f"coalesce(CASE WHEN {n} > 0 THEN {sd} / {nd} END, g.gm)", f"TE_{key}_target_mean"),
        r(f"coalesce(CASE WHEN {n} > 1 THEN sqrt(greatest({var}, 0.0)) END, g.gs)", f"TE_{key}_target_std"),
        r(f"coalesce(CASE WHEN {n} > 0 THEN {nd} END, 1.0)", f"TE_{key}_target_count"),
        r(f"coalesce(CASE WHEN {n} > 0 THEN CAST({c0} AS DOUBLE) / {nd} END, g.r0)", f"TE_{key}_class_0_rate"),
        r(f"coalesce(CASE WHEN {n} > 0 THEN CAST({c1} AS DOUBLE) / {nd} END, g.r1)", f"TE_{key}_class_1_rate"),
    ]


def _oof_sql() -> str:
    ctes, joins, outs = [], [], []
    for i, kname in enumerate(_TE_KEYS):
        ctes.append(
            f"s{i} AS (SELECT {kname} AS kv, fold, count(*) AS n, sum(y) AS s, sum(y * y) AS q, "
            f"sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS c0, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS c1 "
            f"FROM f GROUP BY {kname}, fold), "
            f"t{i} AS (SELECT kv, sum(n) AS n, sum(s) AS s, sum(q) AS q, sum(c0) AS c0, sum(c1) AS c1 "
            f"FROM s{i} GROUP BY kv)"
        )
        joins.append(f"JOIN s{i} ON s{i}.kv = f.{kname} AND s{i}.fold = f.fold JOIN t{i} ON t{i}.kv = f.{kname}")
        outs += _te_stat_sql(*[f"(t{i}.{c} - s{i}.{c})" for c in ("n", "s", "q", "c0", "c1")], kname)
    return f"{_TR_SQL}, {', '.join(ctes)} SELECT f.doc_id, f.fold, {', '.join(outs)} FROM f CROSS JOIN g {' '.join(joins)}"


def _labeled_docs(spark, sf):
    d = t(spark, sf, "documents").select("doc_id", "lang", "source")
    lab = t(spark, sf, "labels").select("doc_id", F.col("quality").alias("y"))
    tr = d.join(lab, "doc_id", "inner")
    return tr.withColumn("lang_source", F.concat_ws("__", "lang", "source"))


@register("target_encode_oof", _oof_sql())
def q_target_encode_oof(spark, sf):
    """Stratified folds (k = max(2, min(5, smallest class))), out-of-fold
    mean/std/count/class rates for lang, source and their cross."""
    tr = _labeled_docs(spark, sf)
    k = effective_splits(class_counts(tr, "y"), 5)
    tr = stratified_folds(tr, "y", k, "doc_id", seed=None)
    g = TargetGlobals.fit(tr, "y")
    out = target_encode_oof(tr, _TE_KEYS, "y", "fold", g)
    te = [c for c in out.columns if c.startswith("TE_")]
    return rounded(out.select("doc_id", "fold", *te))


def _full_sql() -> str:
    ctes, joins, outs = [], [], []
    for i, kname in enumerate(_TE_KEYS):
        ctes.append(
            f"t{i} AS (SELECT {kname} AS kv, count(*) AS n, sum(y) AS s, sum(y * y) AS q, "
            f"sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS c0, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS c1 "
            f"FROM f GROUP BY {kname})"
        )
        joins.append(f"LEFT JOIN t{i} ON t{i}.kv = a.{kname}")
        outs += _te_stat_sql(*[f"t{i}.{c}" for c in ("n", "s", "q", "c0", "c1")], kname)
    return (f"{_TR_SQL}, a AS (SELECT doc_id, lang, source, lang || '__' || source AS lang_source FROM documents), "
            f"{', '.join(ctes)} SELECT a.doc_id, {', '.join(outs)} FROM a CROSS JOIN g {' '.join(joins)}")


@register("target_encode_full", _full_sql())
def q_target_encode_full(spark, sf):
    """Statistics from all labeled documents applied to every document;
    unseen keys and unlabeled-only keys fall back to the global values."""
    tr = _labeled_docs(spark, sf)
    enc = TargetEncoder.fit(tr, _TE_KEYS, "y")
    docs = t(spark, sf, "documents").select("doc_id", "lang", "source").withColumn(
        "lang_source", F.concat_ws("__", "lang", "source"))
    out = enc.transform(docs)
    return rounded(out.select("doc_id", *[c for c in out.columns if c.startswith("TE_")]))


# ---- A2-A5, A8 -------------------------------------------------------------------
@register("dedupe", "SELECT DISTINCT lang, source, text FROM documents")
def q_dedupe(spark, sf):
    """A2: full-row dedupe of (lang, source, text) over whole texts."""
    return drop_duplicates(t(spark, sf, "documents").select("lang", "source", "text"))


_SAMPLE_N = 1500
_HASH = "((o_orderkey * 2654435761 + 42) % 4294967296)"


@register(
    "stratified_sample",
    f"""
WITH c AS (SELECT o_orderstatus AS k, count(*) AS cnt FROM orders GROUP BY 1),
tt AS (SELECT sum(cnt) AS tot FROM c),
q AS (SELECT k, CAST({_SAMPLE_N} * cnt AS DOUBLE) / tot AS raw FROM c, tt),
rr AS (SELECT k, raw, floor(raw) AS base, row_number() OVER (ORDER BY raw - floor(raw) DESC, k) AS pos FROM q),
quota AS (SELECT k, base + CASE WHEN pos <= {_SAMPLE_N} - (SELECT sum(base) FROM rr) THEN 1 ELSE 0 END AS quota FROM rr),
ranked AS (SELECT o_orderkey, o_orderstatus, o_totalprice,
                  row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_HASH}, o_orderkey) AS rn FROM orders)
SELECT o_orderkey, o_orderstatus, o_totalprice FROM ranked JOIN quota ON ranked.o_orderstatus = quota.k
WHERE rn <= quota
""",
)
def q_stratified_sample(spark, sf):
    """A3: exactly 1500 orders with status shares kept (largest remainder)."""
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return stratified_sample_exact(o, "o_orderstatus", _SAMPLE_N, "o_orderkey",
                                   order=portable_hash("o_orderkey", 42))


@register(
    "sample_exact",
    f"SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders ORDER BY {_HASH}, o_orderkey LIMIT 500",
)
def q_sample_exact(spark, sf):
    """A4: an exact 500-row sample in a seeded hash order."""
    o = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return sample_exact(o, 500, "o_orderkey", order=portable_hash("o_orderkey", 42))


@register(
    "label_map",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 1 WHEN 'P' THEN 2 END AS status_code "
    "FROM orders",
)
def q_label_map(spark, sf):
    """A5: string label -> integer code (unknown -> NULL)."""
    o = t(spark, sf, "orders")
    return o.select("o_orderkey", label_map("o_orderstatus", {"F": 0, "O": 1, "P": 2}).alias("status_code"))


@register(
    "union_sources",
    "SELECT c_custkey AS key, c_acctbal AS acctbal, c_mktsegment, 'customer' AS \"Source\" FROM customer "
    "UNION ALL SELECT s_suppkey, s_acctbal, NULL, 'supplier' FROM supplier",
)
def q_union_sources(spark, sf):
    """Stack two tables by column name with a source tag."""
    c = t(spark, sf, "customer").select(F.col("c_custkey").alias("key"), F.col("c_acctbal").alias("acctbal"),
                                        "c_mktsegment")
    s = t(spark, sf, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_acctbal").alias("acctbal"))
    return union_sources({"customer": c, "supplier": s})


# ---- B4-B9 ----------------------------------------------------------------------
@register(
    "impute_median",
    """
WITH j AS (SELECT d.doc_id AS id, d.lang, d.source, CAST(d.n_chars AS DOUBLE) AS n_chars,
                  CAST(l.quality AS DOUBLE) AS quality, CAST(l.toxic AS DOUBLE) AS toxic
           FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
m AS (SELECT quantile_cont(n_chars, 0.5) AS mn, quantile_cont(quality, 0.5) AS mq,
             quantile_cont(toxic, 0.5) AS mt FROM j)
SELECT id, coalesce(lang, 'Missing') AS lang, coalesce(source, 'Missing') AS source,
       round(coalesce(n_chars, m.mn), 6) AS n_chars, round(coalesce(quality, m.mq), 6) AS quality,
       round(coalesce(toxic, m.mt), 6) AS toxic
FROM j CROSS JOIN m
""",
)
def q_impute_median(spark, sf):
    """B3 + B4: numeric -> median of the frame, categorical -> ``"Missing"``,
    on documents left-joined with their (partial) labels."""
    d = t(spark, sf, "documents").select(F.col("doc_id").alias("id"), "lang", "source",
                                         F.col("n_chars").cast("double").alias("n_chars"))
    lab = t(spark, sf, "labels").select(F.col("doc_id").alias("id"), F.col("quality").cast("double").alias("quality"),
                                        F.col("toxic").cast("double").alias("toxic"))
    return rounded(fill_combined(d.join(lab, "id", "left"), id_col="id"))


@register(
    "to_numeric",
    "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_value, "
    "TRY_CAST(event_type AS DOUBLE) AS type_as_number, "
    "CASE WHEN isinf(value * 1e306) THEN NULL ELSE round(value * 1e306, 6) END AS inf_cleaned FROM events",
)
def q_to_numeric(spark, sf):
    """B6 + B7: coerce strings to numbers (bad -> NULL) and +-Inf/NaN -> NULL."""
    e = t(spark, sf, "events")
    k = F.get_json_object("props", "$.k")
    grown = F.col("value") * F.lit(1e306)  # overflows to +Inf above ~179.8
    return rounded(e.select("event_id", to_numeric(k).alias("k_value"),
                            to_numeric(F.col("event_type")).alias("type_as_number"),
                            inf_to_null(grown).alias("inf_cleaned")))


@register("drop_constant", "SELECT n_nationkey, n_name FROM nation")
def q_drop_constant(spark, sf):
    """Drop columns constant in the 'test' frame (nations of one region)."""
    nation = t(spark, sf, "nation")
    test = nation.where(F.col("n_regionkey") == 1)
    train, _, _ = drop_constant(nation, test)
    return train
