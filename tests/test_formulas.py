"""The row-wise formulas (D1-D3, D5-D7) against numbers worked out by hand, and the expression
library against what its column names say. Nothing here is rendered from the specs."""

import math

import pytest

from furrow.functions.scalar import spec_columns
from furrow.plans import irrigation as irr

ROLES = irr.SHORT
SCHEMA = ", ".join([f"{c} double" for c in irr.SHORT.values()] + ["Crop_Growth_Stage string", "Season string", "Mulching_Used string", "id int"])
GOOD = {"T": 20.0, "RH": 50.0, "R": 100.0, "W": 15.0, "SM": 40.0, "PI": 10.0, "SH": 6.0, "OC": 1.0, "EC": 2.0, "FA": 5.0, "PH": 7.0}
ROWS = [
    {**GOOD},
    {**GOOD, "T": 0.0, "FA": 0.0, "RH": 0.0},  # zero denominators
    {**GOOD, "T": -12.5, "SM": -3.0, "R": 0.0, "W": -2.0, "EC": -0.5},  # negatives
    {**GOOD, "T": None, "SM": None},
    {**GOOD, "R": None, "W": None, "PH": None},
    dict.fromkeys(GOOD),
    {**GOOD, "T": 41.0, "RH": 12.0, "R": 20.0, "W": 120.0, "SM": 8.0, "PI": 0.0, "SH": 11.0, "FA": 0.3},
]


def frame(spark, rows=ROWS, stage="Flowering", season="Zaid", mulch="Yes"):
    data = [tuple(r[k] for k in ROLES) + (stage, season, mulch, i) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def run(df, spec, roles=None, params=None):
    return [r.asDict() for r in df.select("id", *spec_columns(spec, roles, params)).orderBy("id").collect()]


def same(found, want, rel=1e-9):
    for name, value in want.items():
        assert found[name] == (None if value is None else pytest.approx(value, rel=rel, abs=1e-12)), name


def test_ordinals_by_hand(spark):
    rows = [("Sowing", "Kharif"), ("Vegetative", "Rabi"), ("Flowering", "Zaid"), ("Harvest", None), (None, "zaid"), ("Other", "")]
    df = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "Crop_Growth_Stage string, Season string, id int")
    found = run(df, irr.ordinal_spec())
    assert [r["Crop_Growth_Stage_Ordinal"] for r in found] == [0, 1, 2, 3, -1, -1]
    assert sorted(r["Season_Ordinal"] for r in found[:3]) == [0, 1, 2] and [r["Season_Ordinal"] for r in found[3:]] == [-1, -1, -1]


def test_interactions_by_hand(spark):
    found = run(frame(spark), irr.interaction_spec())
    same(found[0], {
        "Moisture_to_Temperature": 1.9999999000000050, "Rainfall_to_Temperature": 4.9999997500000125, "Prev_Irrigation_to_Area": 1.99999960000008,
        "Rainfall_to_Area": 19.9999960000008, "Rain_plus_Irrigation": 110, "Water_Availability_Index": 21.99999560000088,
        "Evaporation_Pressure": 60.00012, "Dryness_Index": 1.200002375999952, "Conductivity_pH_Interaction": 14, "Carbon_Moisture_Interaction": 40,
        "Wind_Sunlight_Interaction": 90, "Temp_Humidity_Interaction": 10, "Rainfall_per_Humidity": 1.9999999600000008, "Moisture_Deficit": 60,
        "Heat_Load": 15, "Irrigation_Gap": 90}, rel=1e-8)
    assert len(found[0]) == 17
    same(found[1], {"Moisture_to_Temperature": None, "Rainfall_to_Area": None, "Water_Availability_Index": None, "Rainfall_per_Humidity": None,
                    "Evaporation_Pressure": 0, "Heat_Load": 0, "Rain_plus_Irrigation": 110})
    same(found[2], {"Moisture_to_Temperature": -3 / (-12.5 + 1e-6), "Rainfall_to_Temperature": 0, "Moisture_Deficit": 103, "Irrigation_Gap": -10,
                    "Conductivity_pH_Interaction": -3.5, "Dryness_Index": -12.5 * 6 * 0.500001 / (7 + 1e-6)})
    same(found[3], {"Moisture_to_Temperature": None, "Evaporation_Pressure": None, "Dryness_Index": None, "Moisture_Deficit": None, "Rainfall_to_Area": 19.9999960000008})
    assert all(v is None for k, v in found[5].items() if k != "id")


def test_water_balance_by_hand(spark):
    spec = irr.domain_spec(with_ordinals=True)
    found = run(frame(spark), spec, params={"demand_median": 30.0})
    stress = 31.25 / 140.000001
    same(found[0], {
        "Effective_Rainfall": 90, "Irrigation_Supply": 100, "Climate_Demand_Index": 31.25, "Net_Water_Balance": 68.75, "Water_Stress_Index": stress,
        "Moisture_Recharge_Ratio": 100 / 41.000001, "Field_Size_Stress": 156.25 / 101.000001, "Salinity_Stress_Index": 1.000002, "pH_Deviation": 0.5,
        "Soil_Buffer_Score": 1 / 3.500001, "Canopy_Demand_Index": 93.75, "High_Stress_Flag": 0, "Moisture_Critical_Flag": 0})
    by = {s: run(frame(spark, [GOOD], season=s), spec, params={"demand_median": 30.0})[0]["Seasonal_Water_Pressure"] for s in ("Kharif", "Rabi", "Zaid")}
    assert sorted(by.values()) == [pytest.approx(k * stress) for k in (1, 2, 3)]
    # strong wind leaves a quarter of the rain; dry, hot soil is critical and stressed
    same(found[6], {"Effective_Rainfall": 5, "Irrigation_Supply": 5, "Climate_Demand_Index": 41 * (23 / 12) + 42 - 0.96, "High_Stress_Flag": 1, "Moisture_Critical_Flag": 1})
    same(run(frame(spark), spec, params={"demand_median": 1000.0})[6], {"Moisture_Critical_Flag": 0})
    # a comparison with a missing value is no, a sum with one is missing
    same(found[4], {"Effective_Rainfall": None, "Net_Water_Balance": None, "pH_Deviation": None, "Soil_Buffer_Score": None, "High_Stress_Flag": 0, "Moisture_Critical_Flag": 0})
    same(found[5], {"Water_Stress_Index": None, "Canopy_Demand_Index": None, "High_Stress_Flag": 0, "Moisture_Critical_Flag": 0})
    assert len(found[0]) == 15


def test_formula_score_by_hand(spark):
    def score(stage, mulch, **changes):
        r = run(frame(spark, [{**GOOD, "T": 25.0, "W": 5.0, "R": 500.0, **changes}], stage=stage, mulch=mulch), irr.formula_spec())[0]
        return r["formula_score"], r["formula_pred"], r["dist_to_low_boundary"]

    assert score("Flowering", "No") == (0, 0, 0)
    assert score("Harvest", "Yes") == (-3, 0, 3)
    assert score("Sowing", "No", SM=24.9) == (0, 0, 0)
    assert score("Flowering", "Yes", SM=24.9, R=299.0) == (3, 1, 3)
    assert score("Flowering", "No", SM=24.9, R=299.0) == (4, 2, 4)
    assert score("Flowering", "No", SM=24.9, R=299.0, T=31.0, W=11.0) == (6, 2, 6)
    assert score("Flowering", "No", SM=25.0, R=300.0, T=30.0, W=10.0) == (0, 0, 0)  # bounds are outside
    assert score(None, None, SM=None, R=None, T=None, W=11.0) == (1, 1, 1)


def test_agronomy_by_hand(spark):
    found = run(frame(spark), irr.agronomy_spec(), irr.SHORT)
    assert len(found[0]) == 19
    es = 0.6108 * math.exp(345.4 / 257.3)  # 2.338 kPa at 20 degrees
    assert es == pytest.approx(2.338, abs=1e-3)
    et0 = 0.0023 * 37.8 * 0.492
    same(found[0], {
        "vpd": es / 2, "vpd_normalized": (es / 2) / (es + 1e-6), "et0": et0, "et0_monthly": 30 * et0, "effective_rainfall": 135,
        "water_balance": 110 - 30 * et0, "water_balance_sign": 1, "soil_water_deficit": -15, "soil_water_deficit_pct": -0.6,
        "aridity_index": 100 / 30.000001, "dew_point": 10, "temp_dew_spread": 10, "wind_evap_factor": 2.5 * et0, "heat_wind_stress": 0.5})
    kc = found[0]["crop_water_demand"] / et0
    assert 0.3 <= kc <= 1.3
    same(found[0], {"crop_water_demand_mo": 30 * kc * et0, "net_irrigation_need": 30 * kc * et0 - 135, "irrigation_deficit": 0})
    other = run(frame(spark, [GOOD], stage="Unknown"), irr.agronomy_spec(), irr.SHORT)[0]
    same(other, {"crop_water_demand": 0.8 * et0})  # the default coefficient
    same(found[6], {"effective_rainfall": 20 * (125 - 4) / 125, "soil_water_deficit": 17, "dew_point": 41 - 88 / 5})  # up to 75 mm
    same(found[2], {"effective_rainfall": 0, "aridity_index": 0, "heat_wind_stress": (-12.5 / 30) * -0.2 * 0.5})
    same(found[3], {"vpd": None, "et0": None, "dew_point": None, "soil_water_deficit": None, "water_balance": None})
    same(found[4], {"effective_rainfall": None, "water_balance_sign": None, "wind_evap_factor": None, "vpd": es / 2})
    assert all(v is None for k, v in found[5].items() if k != "id")


def by_name(name, v):
    """What a column of the library is, read from its name; ``v``: the roles' values. NaN stands for missing."""
    part = name.split("_")

    def clip(x, low=-math.inf, high=math.inf):
        return x if math.isnan(x) else min(max(x, low), high)

    if name == "W_T_RH_product":
        return v["W"] * v["T"] * (1 - v["RH"] / 100)
    if part[-1] == "ratio":
        return v[part[0]] / (v[part[1]] + 1e-6)
    if part[-1] == "product":
        return v[part[0]] * v[part[1]]
    if part[1] == "minus":
        return v[part[0]] - (v[part[2]] if part[2] in v else float(part[2]))
    if part[-1] == "sq" and part[1] == "dist":
        return (v[part[0]] - float(part[2])) ** 2
    if part[-1] in ("sq", "cb"):
        return v[part[0]] ** (2 if part[-1] == "sq" else 3)
    if part[-1] == "sqrt":
        return math.sqrt(clip(v[part[0]], 0.0))
    if part[0] == "log":
        return math.log1p(v[part[1]]) if v[part[1]] > -1 else math.nan
    if part[0] == "exp":
        return math.exp(clip(v[part[1]] / 100, -10, 10))
    if part[0] in ("sin", "cos"):
        return getattr(math, part[0])(math.radians(v[part[1]]))
    if part[1] == "dist":
        return abs(v[part[0]] - float(part[2]))
    if part[0] == "sigmoid":
        width = 50 if part[1] == "R" else 1
        return 1 / (1 + math.exp(-(v[part[1]] - float(part[2])) / width))
    if part[0] == "harm":
        return 2 * v[part[1]] * v[part[2]] / (v[part[1]] + v[part[2]] + 1e-6)
    if part[0] == "geom":
        return math.sqrt(clip(v[part[1]] * v[part[2]], 0.0))
    if part[0] in ("min", "max"):
        a, b = v[part[1]], v[part[2]]
        return math.nan if math.isnan(a) or math.isnan(b) else (min if part[0] == "min" else max)(a, b)
    assert len(part) == 3, name
    return v[part[0]] * v[part[1]] * v[part[2]]


def test_expression_library_is_what_its_names_say(spark):
    found = run(frame(spark), irr.expression_library_spec(), irr.SHORT)
    assert len(found[0]) == 112
    for row, values in zip(found, ROWS, strict=True):
        v = {k: math.nan if x is None else x for k, x in values.items()}
        for name, got in row.items():
            if name == "id":
                continue
            want = by_name(name, v)
            if math.isnan(want):
                assert got is None or math.isnan(got), (name, values)
            else:
                assert got == pytest.approx(want, rel=1e-9, abs=1e-12), (name, values)


def test_second_feature_set_column_by_column(spark):
    """Every column of the second build on rows with edge values, against pandas and the names."""
    import numpy as np
    import pandas as pd

    from furrow.plans.second_features import run_all_features

    rng = np.random.default_rng(2)
    n = 60
    pdf = pd.DataFrame({c: np.round(rng.uniform(-5 if k in ("T", "SM") else 0, hi, n), 3) for (k, c), hi in zip(
        ROLES.items(), [45, 99, 2000, 20, 70, 120, 11, 1.6, 3.5, 15, 8.5], strict=True)})
    pdf.iloc[3] = 0.0
    pdf.loc[5, "Soil_Moisture"] = np.nan
    pdf.loc[7, ["Rainfall_mm", "Soil_pH"]] = np.nan
    cats = {c: rng.choice(["a", "b", "c"], n).astype(object) for c in irr.BASE_CATEGORICAL_COLS}
    cats["Mulching_Used"][:] = "Yes"
    cats["Season"][11] = cats["Crop_Type"][4] = None
    pdf = pdf.assign(id=range(n), **cats)
    schema = ", ".join(f"{c} {'string' if c in cats else 'int' if c == 'id' else 'double'}" for c in pdf)
    rows = [tuple(None if v is None or v != v else v for v in r) for r in pdf.astype(object).itertuples(index=False)]
    df = spark.createDataFrame(rows, schema)
    train, test, dropped = run_all_features(df.where("id < 45"), df.where("id >= 45"))
    assert set(dropped) >= {"Mulching_Used"} and not set(dropped) & {"id", "Season", "T_sq"}
    wide = {r["id"]: r.asDict() for r in [*train.collect(), *test.collect()]}
    assert len(wide) == n and "Mulching_Used" not in wide[0]

    base = pdf.iloc[:45]
    raw = {c: pdf[c].to_numpy() for c in ROLES.values()}
    digits = {c: 3 if base[c].max() < 10 else 2 if base[c].max() < 100 else 1 for c in ROLES.values()}
    checked = {"id", *cats}
    text = {c: pdf[c].where(pdf[c].notna(), "nan") for c in cats}
    want = {}
    for c, x in raw.items():
        want[c] = pdf[c].round(digits[c])
        want[f"{c}_bin"] = pd.cut(pdf[c], irr.FIXED_BIN_EDGES[c], labels=False, include_lowest=True)
        want[f"{c}_int"], want[f"{c}_dec"] = np.floor(x), x - np.floor(x)
        for k in range(-4, 4):
            want[f"{c}_digit{k}"] = pd.Series(x // 10.0**k % 10)
    for g in [*irr.CROSS_PAIRS, *irr.CROSS_TRIPLETS]:
        joined = text[g[0]].str.cat([text[c] for c in g[1:]], sep="__")
        want["__".join(g)] = joined
        want["ce_" + "__".join(g)] = joined.map(joined[:45].value_counts()).fillna(0)
    for c in cats:
        want[f"ce_{c}"] = pdf[c].map(pdf[c][:45].value_counts()).fillna(0)
    own = {n_ for n_ in run(frame(spark), irr.expression_library_spec(), ROLES)[0] if n_ != "id"}
    agronomy = {n_ for n_ in run(frame(spark), irr.agronomy_spec(), ROLES)[0] if n_ != "id"}
    scores = {"formula_score", "formula_pred", "dist_to_low_boundary"}
    for i, row in wide.items():
        v = {k: float(want[c].iloc[i]) for k, c in ROLES.items()}
        for name, got in row.items():
            if name in checked or name in agronomy or name in scores:
                continue
            expected = by_name(name, v) if name in own else want[name][i]
            if isinstance(expected, str):
                assert got == expected, (i, name)
            elif expected != expected:
                assert got is None or got != got, (i, name)
            else:
                assert got == pytest.approx(float(expected), rel=1e-6, abs=1e-9), (i, name)
    # the two families with tests of their own: from the rounded and the raw columns
    rounded = [{k: None if math.isnan(x := float(want[c].iloc[i])) else x for k, c in ROLES.items()} for i in range(n)]
    again = run(frame(spark, rounded, stage="x"), [f for f in irr.agronomy_spec()], ROLES)
    for i, row in wide.items():
        if pdf["Crop_Growth_Stage"][i] in irr.KC_MAP:
            continue
        for name in agronomy & set(row):
            assert row[name] == (None if again[i][name] is None else pytest.approx(again[i][name], rel=1e-9)), (i, name)
    left = set(want) | own | agronomy | scores | checked
    assert set(wide[0]) | set(dropped) == left
