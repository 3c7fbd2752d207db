"""Catalogue: row-wise features (B2, C1-C8, D1-D7, E1-E3, E6-E9) on the
irrigation-role view of the driver tables."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from furrow.functions import bands, crosses
from furrow.functions.nulls import safe_divide
from furrow.functions.scalar import spec_columns, spec_sql
from furrow.operators.bands import quantile_band
from furrow.operators.impute import column_max, medians
from furrow.plans import irrigation as irr
from furrow.plans.catalog import r, register, rounded, t
from furrow.plans.field_view import ROLE_SQL, field_rows

NUM = irr.BASE_NUMERICAL_COLS
CAT = irr.BASE_CATEGORICAL_COLS


def _q(c: str) -> str:
    return f'"{c}"'


def _sql_select(items: list[str], extra_cte: str = "", src: str = "field") -> str:
    return f"{ROLE_SQL}{extra_cte} SELECT id, {', '.join(items)} FROM {src}"


def _round_items(spec_items: list[str]) -> list[str]:
    """Wrap rendered ``CAST(x AS DOUBLE) AS "n"`` items in round(.., 6)."""
    out = []
    for it in spec_items:
        expr, alias = it.rsplit(" AS ", 1)
        if expr.endswith("AS DOUBLE)"):
            out.append(f"round({expr}, 6) AS {alias}")
        else:
            out.append(it)
    return out


# ---- B2 ---------------------------------------------------------------------
@register(
    "safe_ratio",
    "SELECT l_orderkey, l_linenumber, "
    + r("l_extendedprice / (NULLIF(l_discount, 0) + 1e-6)", "price_per_discount") + ", "
    + r("l_quantity / (NULLIF(l_tax, 0) + 1e-6)", "qty_per_tax")
    + " FROM lineitem",
)
def q_safe_ratio(spark, sf):
    """B2: ratios with zero denominators -> NULL, eps added otherwise."""
    li = t(spark, sf, "lineitem")
    return rounded(li.select(
        "l_orderkey", "l_linenumber",
        safe_divide("l_extendedprice", "l_discount").alias("price_per_discount"),
        safe_divide("l_quantity", "l_tax").alias("qty_per_tax"),
    ))


# ---- D1-D4 ------------------------------------------------------------------
def _demand_spec():
    return irr.ordinal_spec() + irr.interaction_spec() + irr.domain_spec()


INTERACTION_SQL = _sql_select(
    _round_items(spec_sql(_demand_spec(), params={"demand_median": None}))
).replace(
    "CAST(NULL AS DOUBLE)", "(SELECT quantile_cont(dm, 0.5) FROM dmd)"
).replace(
    " SELECT id,",
    ", dmd AS (SELECT \"Temperature_C\" * (1.0 + \"Sunlight_Hours\" / 12.0) + \"Wind_Speed_kmh\" * 0.35"
    " - \"Humidity\" * 0.08 AS dm FROM field) SELECT id,",
    1,
)


@register("interaction_exprs", INTERACTION_SQL)
def q_interaction_exprs(spark, sf):
    """D1 + D2 + D3 + D4: ordinals, 16 interactions, 14 water-balance columns;
    the critical-moisture flag uses the fitted median of climate demand."""
    f = field_rows(spark, sf)
    demand = f.select(*spec_columns(irr.climate_demand_sql()))
    med = medians(demand, ["Climate_Demand_Index"])["Climate_Demand_Index"]
    return rounded(f.select("id", *spec_columns(_demand_spec(), params={"demand_median": med})))


@register("agronomy_exprs", _sql_select(_round_items(spec_sql(irr.agronomy_spec(), irr.SHORT))))
def q_agronomy_exprs(spark, sf):
    """Vapour pressure, ET0, crop demand and balance columns."""
    f = field_rows(spark, sf)
    return rounded(f.select("id", *spec_columns(irr.agronomy_spec(), irr.SHORT)))


@register("expression_library", _sql_select(_round_items(spec_sql(irr.expression_library_spec(), irr.SHORT))))
def q_expression_library(spark, sf):
    """The 111-column expression library."""
    f = field_rows(spark, sf)
    return rounded(f.select("id", *spec_columns(irr.expression_library_spec(), irr.SHORT)))


@register("formula_score", _sql_select(spec_sql(irr.formula_spec())))
def q_formula_score(spark, sf):
    """Rule score, 3-way prediction, distance to the low boundary."""
    return field_rows(spark, sf).select("id", *spec_columns(irr.formula_spec()))


@register(
    "above_median_flag",
    "WITH m AS (SELECT quantile_cont(o_totalprice, 0.5) AS med FROM orders) "
    "SELECT o_orderkey, CAST(CASE WHEN o_orderstatus = 'O' AND o_totalprice > m.med THEN 1 ELSE 0 END AS TINYINT) "
    "AS above_median_flag FROM orders CROSS JOIN m",
)
def q_above_median_flag(spark, sf):
    """A flag against a fitted median (the median is a scalar literal)."""
    o = t(spark, sf, "orders")
    med = medians(o, ["o_totalprice"])["o_totalprice"]
    flag = F.when((F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > F.lit(med)), 1).otherwise(0)
    return o.select("o_orderkey", flag.cast("tinyint").alias("above_median_flag"))


# ---- C1, C3 -----------------------------------------------------------------
def cut_sql(col: str, edges, labels=None, include_lowest=False, missing="nan") -> str:
    arms = []
    for i in range(len(edges) - 1):
        lo, hi = float(edges[i]), float(edges[i + 1])
        lo_s = "'-Infinity'::DOUBLE" if lo == float("-inf") else repr(lo)
        hi_s = "'Infinity'::DOUBLE" if hi == float("inf") else repr(hi)
        op = ">=" if (i == 0 and include_lowest) else ">"
        val = f"'{labels[i]}'" if labels else str(i)
        arms.append(f"WHEN {_q(col)} {op} {lo_s} AND {_q(col)} <= {hi_s} THEN {val}")
    tail = f" ELSE '{missing}'" if labels else ""
    return f"CASE {' '.join(arms)}{tail} END"


@register(
    "cut_bands",
    _sql_select([f"{cut_sql('Soil_pH', irr.PH_BAND_EDGES, irr.PH_BAND_LABELS)} AS \"Soil_pH_Band\"",
                 f"{cut_sql('Humidity', [0, 30, 60, 90], ['Dry', 'Mid', 'Wet'])} AS \"Humidity_Band\""]),
)
def q_cut_bands(spark, sf):
    """Right-closed bands with labels; outside or missing -> ``"nan"``."""
    f = field_rows(spark, sf)
    return f.select(
        "id",
        bands.cut("Soil_pH", irr.PH_BAND_EDGES, irr.PH_BAND_LABELS).alias("Soil_pH_Band"),
        bands.cut("Humidity", [0, 30, 60, 90], ["Dry", "Mid", "Wet"]).alias("Humidity_Band"),
    )


@register(
    "fixed_bins",
    _sql_select([f"CAST({cut_sql(c, e, None, True)} AS FLOAT) AS \"{c}_bin\"" for c, e in irr.FIXED_BIN_EDGES.items()]),
)
def q_fixed_bins(spark, sf):
    """Integer bin codes (first bin closed), outside -> NULL, float32."""
    f = field_rows(spark, sf)
    return f.select("id", *[bands.fixed_bins(c, e).alias(f"{c}_bin") for c, e in irr.FIXED_BIN_EDGES.items()])


# ---- C2 ---------------------------------------------------------------------
_QB_LABELS = ["Low", "Medium", "High", "Very_High"]
QUANTILE_BAND_SQL = f"""
WITH rk AS (
  SELECT c_custkey, c_acctbal,
         CASE WHEN c_acctbal IS NULL THEN NULL ELSE row_number() OVER (PARTITION BY c_acctbal IS NULL ORDER BY c_acctbal, c_custkey) END AS rn,
         count(c_acctbal) OVER () AS n
  FROM customer),
b AS (SELECT *, least(4, n) AS k FROM rk)
SELECT c_custkey,
  CASE WHEN n <= 1 THEN 'Acct_Single' WHEN rn IS NULL THEN 'nan'
       ELSE list_extract({_QB_LABELS!r}, CAST(greatest(1, ((rn - 1) * k + n - 2) // (n - 1)) AS INTEGER)) END AS acct_band
FROM b
"""


@register("quantile_band", QUANTILE_BAND_SQL)
def q_quantile_band(spark, sf):
    """rank(method=first) + qcut into 4 bands, exact, without a global window."""
    cust = t(spark, sf, "customer")
    banded = quantile_band(cust, "c_acctbal", _QB_LABELS, "Acct", id_col="c_custkey", out="acct_band")
    return banded.select("c_custkey", "acct_band")


# ---- C4-C8 ------------------------------------------------------------------
def _sql_round_even(x: str, d: int) -> str:
    return f"round_even({x}, 0)" if d == 0 else f"(round_even({x} * {float(10**d)!r}, 0) / {float(10**d)!r})"


def _sql_pmod(a: str, n: str) -> str:
    return f"(CASE WHEN fmod({a}, {n}) < 0 THEN fmod(fmod({a}, {n}) + {n}, {n}) ELSE fmod({a}, {n}) END)"


def _round_digit_sql() -> list[str]:
    items = []
    for c, ps in irr.ROUNDING_PLAN.items():
        for p in ps:
            items.append(f'{_sql_round_even(_q(c), p)} AS "{c}_round_{p}"')
    for c, kmax in irr.DIGIT_SOURCES.items():
        for k in range(1, kmax + 1):
            m = _sql_pmod(f"{_q(c)} * {float(10**k)!r}", "10.0")
            items.append(f'CAST(trunc(coalesce(CASE WHEN isnan({m}) THEN NULL ELSE {m} END, -1.0)) AS SMALLINT) AS "{c}_digit_{k}"')
        d1 = _sql_pmod(f"{_q(c)} * 10.0", "10.0")
        d2 = _sql_pmod(f"{_q(c)} * 100.0", "10.0")
        t1 = f"CAST(trunc(coalesce({d1}, -1.0)) AS SMALLINT)"
        t2 = f"CAST(trunc(coalesce({d2}, -1.0)) AS SMALLINT)"
        items.append(f'CAST(({t1} + 1) * 11 + ({t2} + 1) AS SMALLINT) AS "{c}_digit_pair_1_2"')
    return items


def round_digit_columns():
    cols = []
    for c, ps in irr.ROUNDING_PLAN.items():
        for p in ps:
            cols.append(bands.round_half_even(c, p).alias(f"{c}_round_{p}"))
    for c, kmax in irr.DIGIT_SOURCES.items():
        for k in range(1, kmax + 1):
            cols.append(bands.decimal_digit(c, k).alias(f"{c}_digit_{k}"))
        cols.append(bands.digit_pair_code(bands.decimal_digit(c, 1), bands.decimal_digit(c, 2))
                    .alias(f"{c}_digit_pair_1_2"))
    return cols


@register("round_digits", _sql_select(_round_digit_sql()))
def q_round_digits(spark, sf):
    """C4 + C5: half-even rounding and decimal digits (missing -> -1)."""
    return rounded(field_rows(spark, sf).select("id", *round_digit_columns()))


def _positional_sql() -> list[str]:
    items = []
    for c in irr.SECOND_NUM_COLS:
        for k in irr.DIGIT_POSITIONS:
            p = repr(float(10.0**k))
            q = f"round(({_q(c)} - {_sql_pmod(_q(c), p)}) / {p})"
            items.append(f'CAST(trunc({_sql_pmod(q, "10.0")}) AS TINYINT) AS "{c}_digit{k}"')
    return items


@register("positional_digits")  # DuckDB's fmod is not C fmod: checked against NumPy in tests
def q_positional_digits(spark, sf):
    """``x // 10**k % 10`` for k = -4..3 on the 11 numerics (88 columns)."""
    f = field_rows(spark, sf)
    return f.select("id", *[bands.positional_digit(c, k).alias(f"{c}_digit{k}")
                            for c in irr.SECOND_NUM_COLS for k in irr.DIGIT_POSITIONS])


@register(
    "decimal_split",
    _sql_select([it for c in irr.SECOND_NUM_COLS for it in (
        f'round(floor({_q(c)}), 6) AS "{c}_int"', f'round({_q(c)} - floor({_q(c)}), 6) AS "{c}_dec"')]),
)
def q_decimal_split(spark, sf):
    """Integer part and fraction of the 11 numerics."""
    f = field_rows(spark, sf)
    return rounded(f.select("id", *[x for c in irr.SECOND_NUM_COLS for x in (
        bands.decimal_int(c).alias(f"{c}_int"), bands.decimal_frac(c).alias(f"{c}_dec"))]))


def _round_range_sql() -> str:
    items = []
    for c in irr.SECOND_NUM_COLS:
        d = (f"CASE WHEN (SELECT max({_q(c)}) FROM field WHERE split = 'train') < 10 THEN 3 "
             f"WHEN (SELECT max({_q(c)}) FROM field WHERE split = 'train') < 100 THEN 2 ELSE 1 END")
        items.append(
            f"round(CASE {d} WHEN 3 THEN {_sql_round_even(_q(c), 3)} WHEN 2 THEN {_sql_round_even(_q(c), 2)} "
            f"ELSE {_sql_round_even(_q(c), 1)} END, 6) AS {_q(c)}"
        )
    return _sql_select(items)


@register("round_by_range", _round_range_sql())
def q_round_by_range(spark, sf):
    """Each numeric rounded to 3/2/1 decimals by its max on the train split."""
    f = field_rows(spark, sf)
    mx = column_max(f.where(F.col("split") == "train"), irr.SECOND_NUM_COLS)
    return rounded(f.select("id", *[bands.round_by_max(c, mx[c]).alias(c) for c in irr.SECOND_NUM_COLS]))


# ---- E1-E3, E6-E9 -------------------------------------------------------------
def _key_sql(c: str, missing="Missing") -> str:
    return f"coalesce(CAST({_q(c)} AS VARCHAR), '{missing}')"


def _cross_sql(cols, missing="Missing") -> str:
    return " || '__' || ".join(_key_sql(c, missing) for c in cols)


@register(
    "ordinal_encode",
    _sql_select(spec_sql(irr.ordinal_spec())),
)
def q_ordinal_encode(spark, sf):
    """Stage and season ordinals (unknown/missing -> -1)."""
    return field_rows(spark, sf).select("id", *spec_columns(irr.ordinal_spec()))


@register(
    "cross_features",
    _sql_select([f'{_cross_sql([a, b])} AS "{n}"' for n, a, b in irr.CROSS_COMBOS]),
)
def q_cross_features(spark, sf):
    """The 7 named category combos (missing side -> ``"Missing"``)."""
    return field_rows(spark, sf).select("id", *crosses.named_crosses(irr.CROSS_COMBOS))


@register(
    "pairwise_crosses",
    _sql_select([f'{_cross_sql([a, b])} AS "{a}_{b}_Pair"' for a, b in combinations(CAT, 2)]),
)
def q_pairwise_crosses(spark, sf):
    """All 28 category pairs."""
    return field_rows(spark, sf).select("id", *crosses.pairwise_crosses(CAT))


@register(
    "nway_crosses",
    _sql_select([f'{_cross_sql(list(g), "nan")} AS "{"__".join(g)}"'
                 for g in [*irr.CROSS_PAIRS, *irr.CROSS_TRIPLETS]]),
)
def q_nway_crosses(spark, sf):
    """10 pairs + 4 triplets, missing spelled ``"nan"``."""
    return field_rows(spark, sf).select("id", *crosses.nway_crosses([*irr.CROSS_PAIRS, *irr.CROSS_TRIPLETS]))


def _missing_sql() -> list[str]:
    items, code = [], []
    for i, c in enumerate(CAT):
        flag = f"CASE WHEN {_q(c)} IS NULL THEN 1.0 ELSE 0.0 END"
        items.append(f'{flag} AS "{c}_is_missing"')
        for a in irr.ANCHOR_NUMERIC_COLS:
            items.append(f'round(({flag}) * 1000.0 + {_q(a)}, 6) AS "{c}_missing_{a}"')
        code.append(f"({flag}) * {float(2**i)!r}")
    items.append(f'{" + ".join(code)} AS "Missing_Pattern_Code"')
    allc = [*NUM, *CAT]
    items.append(f'CAST({" + ".join(f"(CASE WHEN {_q(c)} IS NULL THEN 1 ELSE 0 END)" for c in allc)} AS DOUBLE) '
                 'AS "Missing_Count"')
    return items


@register("missingness", _sql_select(_missing_sql()))
def q_missingness(spark, sf):
    """Per-category flags, flag*1000 + anchor, bit pattern, NULL count."""
    f = field_rows(spark, sf)
    return rounded(f.select("id", *crosses.missing_features(CAT, irr.ANCHOR_NUMERIC_COLS),
                            crosses.missing_count([*NUM, *CAT]).alias("Missing_Count")))
