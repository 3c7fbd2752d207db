"""Preset for the irrigation-need schema: every column name, map, plan and edge.

Operators elsewhere are generic over column names; this module is the only
place that knows the irrigation schema. The values in the FIXED VALUES block
must equal the original pipeline's for its features to mean the same thing,
so they are stated plainly and in their natural order.
"""

from __future__ import annotations

from furrow.functions.scalar import (
    Feature,
    clip_both,
    clip_low,
    div,
    log1p,
    nan_max,
    nan_min,
    product,
    ratio,
)

# ============================ FIXED VALUES ===================================
# Column names, category maps, aggregation plans, bin edges and cross lists of
# the irrigation-need data set. Do not reorder: names and orders define
# feature names, bit positions and column order.

TARGET = "Irrigation_Need"
ID_COL = "id"
CLASS_LABELS = ["Low", "Medium", "High"]  # -> 0, 1, 2

BASE_CATEGORICAL_COLS = [
    "Soil_Type",
    "Crop_Type",
    "Crop_Growth_Stage",
    "Season",
    "Irrigation_Type",
    "Water_Source",
    "Mulching_Used",
    "Region",
]

BASE_NUMERICAL_COLS = [
    "Soil_pH",
    "Soil_Moisture",
    "Organic_Carbon",
    "Electrical_Conductivity",
    "Temperature_C",
    "Humidity",
    "Rainfall_mm",
    "Sunlight_Hours",
    "Wind_Speed_kmh",
    "Field_Area_hectare",
    "Previous_Irrigation_mm",
]

GROWTH_STAGE_MAP = {"Sowing": 0, "Vegetative": 1, "Flowering": 2, "Harvest": 3}
SEASON_MAP = {"Rabi": 0, "Zaid": 1, "Kharif": 2}
KC_MAP = {"Sowing": 0.4, "Vegetative": 0.8, "Flowering": 1.15, "Harvest": 0.6}
KC_DEFAULT = 0.8

BASE_TARGET_AGG_KEYS = [
    "Soil_Type",
    "Crop_Type",
    "Crop_Growth_Stage",
    "Season",
    "Irrigation_Type",
    "Water_Source",
    "Region",
    "Soil_Crop_Combo",
    "Irrigation_Water_Combo",
    "Crop_Stage_Combo",
]
BAND_COLS = ["Soil_pH_Band", "Moisture_Band", "Rainfall_Band", "Temperature_Band"]

ANCHOR_NUMERIC_COLS = ["Soil_Moisture", "Rainfall_mm", "Previous_Irrigation_mm", "Temperature_C"]

_S6 = ["mean", "std", "count", "nunique", "min", "max"]
_S7 = ["mean", "std", "count", "nunique", "median", "min", "max"]
_S4 = ["mean", "std", "count", "nunique"]
_S5 = ["mean", "std", "count", "nunique", "median"]
NUMERIC_AGG_PLAN = {
    "Soil_Type": (["Soil_Moisture", "Organic_Carbon", "Electrical_Conductivity", "Rainfall_mm"], _S6),
    "Crop_Type": (["Soil_Moisture", "Temperature_C", "Humidity", "Previous_Irrigation_mm"], _S6),
    "Crop_Growth_Stage": (["Soil_Moisture", "Temperature_C", "Humidity"], _S6),
    "Season": (["Rainfall_mm", "Temperature_C", "Humidity", "Sunlight_Hours"], _S7),
    "Irrigation_Type": (["Previous_Irrigation_mm", "Soil_Moisture", "Field_Area_hectare"], _S6),
    "Water_Source": (["Previous_Irrigation_mm", "Rainfall_mm", "Electrical_Conductivity"], _S6),
    "Region": (["Rainfall_mm", "Temperature_C", "Humidity", "Wind_Speed_kmh"], _S7),
    "Soil_Crop_Combo": (["Soil_Moisture", "Rainfall_mm", "Previous_Irrigation_mm"], _S4),
    "Irrigation_Water_Combo": (["Previous_Irrigation_mm", "Field_Area_hectare", "Rainfall_mm"], _S4),
    "Season_Region_Combo": (["Rainfall_mm", "Temperature_C", "Humidity"], _S5),
    "Mulch_Season_Combo": (["Soil_Moisture", "Previous_Irrigation_mm", "Rainfall_mm"], _S5),
}

GROUP_QUANTILES = [10, 25, 50, 75, 90]
GROUP_QUANTILE_PLAN = {
    "Season": ["Rainfall_mm", "Temperature_C"],
    "Region": ["Rainfall_mm", "Humidity"],
    "Crop_Type": ["Soil_Moisture", "Previous_Irrigation_mm"],
    "Soil_Type": ["Soil_Moisture", "Organic_Carbon"],
}

PH_BAND_EDGES = [float("-inf"), 5.5, 7.5, float("inf")]
PH_BAND_LABELS = ["Acidic", "Neutral", "Alkaline"]
QUANTILE_BANDS = {  # source column -> (new column, labels, prefix)
    "Soil_Moisture": ("Moisture_Band", ["Very_Low", "Low", "High", "Very_High"], "Moisture"),
    "Rainfall_mm": ("Rainfall_Band", ["Low", "Medium", "High", "Very_High"], "Rainfall"),
    "Temperature_C": ("Temperature_Band", ["Cool", "Mild", "Warm", "Hot"], "Temperature"),
}

CROSS_COMBOS = [  # (name, left, right)
    ("Soil_Crop_Combo", "Soil_Type", "Crop_Type"),
    ("Season_Region_Combo", "Season", "Region"),
    ("Irrigation_Water_Combo", "Irrigation_Type", "Water_Source"),
    ("Crop_Stage_Combo", "Crop_Type", "Crop_Growth_Stage"),
    ("Mulch_Season_Combo", "Mulching_Used", "Season"),
    ("Soil_Season_Combo", "Soil_Type", "Season"),
    ("Region_Water_Combo", "Region", "Water_Source"),
]

ROUNDING_PLAN = {
    "Soil_Moisture": [0, 1],
    "Rainfall_mm": [0, 1],
    "Previous_Irrigation_mm": [0, 1],
    "Temperature_C": [0, 1],
}
DIGIT_SOURCES = {"Soil_Moisture": 3, "Rainfall_mm": 3, "Previous_Irrigation_mm": 3}

# Second feature set: formula thresholds, fixed bins, crosses.
FIXED_BIN_EDGES = {
    "Soil_pH": [4.8, 5, 5.5, 6, 6.5, 7, 7.5, 8.5],
    "Soil_Moisture": [8, 12, 20, 25, 30, 32, 40, 50, 60, 70],
    "Organic_Carbon": [0.3, 0.4, 0.6, 0.9, 1, 1.3, 1.4, 1.6],
    "Electrical_Conductivity": [0.1, 1, 1.7, 2.5, 3.5],
    "Temperature_C": [12, 20, 27, 35, 42],
    "Humidity": [25, 30, 40, 50, 62, 82, 95],
    "Rainfall_mm": [0, 400, 800, 1000, 1500, 2000, 2150, 2500],
    "Sunlight_Hours": [4, 5, 6, 7, 9, 10, 11],
    "Wind_Speed_kmh": [0.5, 5, 10, 20],
    "Field_Area_hectare": [0.3, 2.5, 5, 7.5, 10, 12.5, 15],
    "Previous_Irrigation_mm": [0.02, 20, 40, 62, 120],
}
SECOND_NUM_COLS = [
    "Temperature_C", "Rainfall_mm", "Wind_Speed_kmh", "Humidity",
    "Sunlight_Hours", "Soil_Moisture", "Soil_pH", "Organic_Carbon",
    "Electrical_Conductivity", "Previous_Irrigation_mm", "Field_Area_hectare",
]
CROSS_PAIRS = [
    ("Crop_Type", "Season"),
    ("Crop_Type", "Crop_Growth_Stage"),
    ("Region", "Season"),
    ("Soil_Type", "Region"),
    ("Crop_Type", "Soil_Type"),
    ("Season", "Soil_Type"),
    ("Irrigation_Type", "Crop_Type"),
    ("Water_Source", "Region"),
    ("Mulching_Used", "Soil_Type"),
    ("Crop_Growth_Stage", "Season"),
]
CROSS_TRIPLETS = [
    ("Crop_Type", "Season", "Region"),
    ("Crop_Type", "Crop_Growth_Stage", "Season"),
    ("Soil_Type", "Region", "Season"),
    ("Crop_Type", "Soil_Type", "Region"),
]
DIGIT_POSITIONS = list(range(-4, 4))

# Short role names used by the second feature set's formulas.
SHORT = {
    "T": "Temperature_C",
    "RH": "Humidity",
    "R": "Rainfall_mm",
    "W": "Wind_Speed_kmh",
    "SM": "Soil_Moisture",
    "PI": "Previous_Irrigation_mm",
    "SH": "Sunlight_Hours",
    "OC": "Organic_Carbon",
    "EC": "Electrical_Conductivity",
    "FA": "Field_Area_hectare",
    "PH": "Soil_pH",
}

# Expression library parameters (second feature set).
LIB_RATIOS = [
    ("T", "RH"), ("SM", "R"), ("PI", "FA"), ("W", "RH"), ("R", "T"), ("SM", "PI"),
    ("SH", "RH"), ("OC", "EC"), ("T", "W"), ("R", "FA"), ("SM", "T"), ("PI", "R"),
    ("SH", "W"), ("PH", "EC"), ("OC", "SM"), ("FA", "PI"), ("RH", "W"), ("T", "SH"),
]
LIB_PRODUCTS = [
    ("T", "W"), ("T", "SH"), ("W", "SH"), ("SM", "OC"), ("R", "RH"), ("T", "RH"),
    ("PI", "FA"), ("SM", "R"), ("EC", "PH"), "W_T_RH", ("SM", "T"), ("OC", "PH"),
    ("SH", "T"), ("W", "RH"), ("R", "SH"), ("PI", "SM"), ("EC", "SM"), ("FA", "W"),
]
LIB_DIFFERENCES = [
    ("SM_minus_25", "{SM} - 25"),
    ("R_minus_300", "{R} - 300"),
    ("PI_minus_SM", "{PI} - {SM}"),
    ("T_minus_27", "{T} - 27"),
    ("W_minus_10", "{W} - 10"),
    ("R_minus_PI", "{R} - {PI}"),
    ("SM_minus_OC", "{SM} - {OC}"),
    ("T_minus_RH", "{T} - {RH}"),
    ("SH_minus_W", "{SH} - {W}"),
    ("PH_minus_7", "{PH} - 7.0"),
]
LIB_SQUARES = ["SM", "T", "R", "W", "RH", "SH"]
LIB_CUBES = ["SM", "T"]
LIB_SQRTS = ["SM", "R", "T", "W"]
LIB_LOGS = ["R", "PI", "FA", "SM", "W", "T", "SH", "EC", "OC"]
LIB_EXPS = ["SM", "T", "RH"]
LIB_TRIG = ["T", "RH", "SM", "W"]
LIB_THRESHOLDS = [("SM", 25), ("R", 300), ("T", 30), ("W", 10), ("PH", 7.0)]
LIB_THRESHOLD_SQUARES = [("SM", 25), ("R", 300), ("T", 30), ("W", 10)]
LIB_SIGMOIDS = [("SM", 25, 1), ("R", 300, 50), ("T", 30, 1), ("W", 10, 1)]
LIB_HARMONIC = [("SM", "R"), ("T", "RH"), ("W", "SH")]
LIB_GEOMETRIC = [("SM", "R"), ("T", "SH"), ("W", "RH")]
LIB_MINMAX = [("SM", "PI"), ("T", "RH"), ("R", "W")]
LIB_TRIPLES = [
    ("SM", "R", "T"), ("W", "T", "SH"), ("SM", "OC", "PH"), ("R", "RH", "W"),
    ("T", "W", "RH"), ("SM", "T", "W"), ("R", "T", "SH"), ("SM", "R", "RH"),
]

# Formula score thresholds: (role, op, threshold, weight)
FORMULA_HIGH = [("Soil_Moisture", "<", 25, 2), ("Rainfall_mm", "<", 300, 2),
                ("Temperature_C", ">", 30, 1), ("Wind_Speed_kmh", ">", 10, 1)]
FORMULA_LOW = [("Crop_Growth_Stage", "=", "Harvest", 2), ("Crop_Growth_Stage", "=", "Sowing", 2),
               ("Mulching_Used", "=", "Yes", 1)]
# ========================== END FIXED VALUES =================================


def _num(c) -> str:
    return str(int(c)) if float(c).is_integer() else str(c)


def _case_map(col: str, mapping: dict, default) -> str:
    arms = " ".join(
        f"WHEN '{k}' THEN {v!r}" if not isinstance(v, str) else f"WHEN '{k}' THEN '{v}'"
        for k, v in mapping.items()
    )
    return f"(CASE {{{col}}} {arms} ELSE {default!r} END)"


def _safe_div(n: str, d: str) -> str:
    return div(n, f"NULLIF({d}, 0) + 1e-6")


def ordinal_spec() -> list[Feature]:
    """Stage and season ordinals (unknown -> -1)."""
    return [
        Feature("Crop_Growth_Stage_Ordinal", _case_map("Crop_Growth_Stage", GROWTH_STAGE_MAP, -1), "int"),
        Feature("Season_Ordinal", _case_map("Season", SEASON_MAP, -1), "int"),
    ]


def interaction_spec() -> list[Feature]:
    """The 16 sensor interaction columns."""
    hid = [
        Feature("_humidity_ratio", "{Humidity} / 100.0", keep=False),
        Feature("_evaporation_pressure",
                "({Temperature_C} * {Sunlight_Hours}) * (1.0 - {_humidity_ratio} + 1e-6)", keep=False),
    ]
    out = [
        Feature("Moisture_to_Temperature", _safe_div("{Soil_Moisture}", "{Temperature_C}")),
        Feature("Rainfall_to_Temperature", _safe_div("{Rainfall_mm}", "{Temperature_C}")),
        Feature("Prev_Irrigation_to_Area", _safe_div("{Previous_Irrigation_mm}", "{Field_Area_hectare}")),
        Feature("Rainfall_to_Area", _safe_div("{Rainfall_mm}", "{Field_Area_hectare}")),
        Feature("Rain_plus_Irrigation", "{Rainfall_mm} + {Previous_Irrigation_mm}"),
        Feature("Water_Availability_Index", _safe_div("{Rain_plus_Irrigation}", "{Field_Area_hectare}")),
        Feature("Evaporation_Pressure", "{_evaporation_pressure}"),
        Feature("Dryness_Index",
                _safe_div("{_evaporation_pressure}", "{Soil_Moisture} + {Previous_Irrigation_mm}")),
        Feature("Conductivity_pH_Interaction", "{Electrical_Conductivity} * {Soil_pH}"),
        Feature("Carbon_Moisture_Interaction", "{Organic_Carbon} * {Soil_Moisture}"),
        Feature("Wind_Sunlight_Interaction", "{Wind_Speed_kmh} * {Sunlight_Hours}"),
        Feature("Temp_Humidity_Interaction", "{Temperature_C} * {_humidity_ratio}"),
        Feature("Rainfall_per_Humidity", _safe_div("{Rainfall_mm}", "{Humidity}")),
        Feature("Moisture_Deficit", "100.0 - {Soil_Moisture}"),
        Feature("Heat_Load", "{Temperature_C} * (1.0 - {_humidity_ratio} / 2.0)"),
        Feature("Irrigation_Gap", "{Rainfall_mm} - {Previous_Irrigation_mm}"),
    ]
    return hid + out


def domain_spec(with_ordinals: bool = False) -> list[Feature]:
    """D3 (+ D4 through the ``demand_median`` parameter): 14 water-balance columns.

    Needs the two ordinals; ``with_ordinals`` inlines them instead of reading
    existing columns.
    """
    pre = [Feature(f.name, f.sql, f.dtype, keep=False) for f in ordinal_spec()] if with_ordinals else []
    hid = [
        Feature("_hr", "{Humidity} / 100.0", keep=False),
        Feature("_effective_rainfall",
                "{Rainfall_mm} * " + clip_low("1.0 - {Wind_Speed_kmh} / 150.0", 0.25), keep=False),
        Feature("_supply", "{Previous_Irrigation_mm} + {_effective_rainfall}", keep=False),
        Feature("_demand",
                "{Temperature_C} * (1.0 + {Sunlight_Hours} / 12.0) + {Wind_Speed_kmh} * 0.35 - {Humidity} * 0.08",
                keep=False),
    ]
    out = [
        Feature("Effective_Rainfall", "{_effective_rainfall}"),
        Feature("Irrigation_Supply", "{_supply}"),
        Feature("Climate_Demand_Index", "{_demand}"),
        Feature("Net_Water_Balance", "{_supply} - {_demand}"),
        Feature("Water_Stress_Index", _safe_div("{_demand}", "{Soil_Moisture} + {_supply}")),
        Feature("Moisture_Recharge_Ratio", _safe_div("{_supply}", "{Soil_Moisture} + 1.0")),
        Feature("Field_Size_Stress", _safe_div("{_demand} * {Field_Area_hectare}", "{_supply} + 1.0")),
        Feature("Salinity_Stress_Index", "{Electrical_Conductivity} * (1.0 - {_hr} + 1e-6)"),
        Feature("pH_Deviation", "abs({Soil_pH} - 6.5)"),
        Feature("Soil_Buffer_Score",
                _safe_div("{Organic_Carbon}", "{Electrical_Conductivity} + {pH_Deviation} + 1.0")),
        Feature("Canopy_Demand_Index", "({Crop_Growth_Stage_Ordinal} + 1.0) * {_demand}"),
        Feature("Seasonal_Water_Pressure", "({Season_Ordinal} + 1.0) * {Water_Stress_Index}"),
        Feature("High_Stress_Flag",
                "CASE WHEN {Water_Stress_Index} > 1.0 OR {Net_Water_Balance} < 0 THEN 1 ELSE 0 END",
                "tinyint"),
        Feature("Moisture_Critical_Flag",
                "CASE WHEN {Soil_Moisture} < 30.0 AND {_demand} > {demand_median} THEN 1 ELSE 0 END",
                "tinyint"),
    ]
    return pre + hid + out


def climate_demand_sql() -> list[Feature]:
    """The demand term alone (fitting D4's median needs it)."""
    return [
        Feature("Climate_Demand_Index",
                "{Temperature_C} * (1.0 + {Sunlight_Hours} / 12.0) + {Wind_Speed_kmh} * 0.35 - {Humidity} * 0.08")
    ]


def formula_spec() -> list[Feature]:
    """Threshold score, 3-way prediction and distance to the low boundary."""
    def term(col, op, thr, weight):
        lit = f"'{thr}'" if isinstance(thr, str) else repr(thr)
        return f"(CASE WHEN {{{col}}} {op} {lit} THEN {weight} ELSE 0 END)"

    high = " + ".join(term(*t) for t in FORMULA_HIGH)
    low = " + ".join(term(*t) for t in FORMULA_LOW)
    return [
        Feature("formula_score", f"({high}) - ({low})", "int"),
        Feature("formula_pred",
                "CASE WHEN {formula_score} <= 0 THEN 0 WHEN {formula_score} <= 3 THEN 1 ELSE 2 END", "int"),
        Feature("dist_to_low_boundary", "abs({formula_score})", "int"),
    ]


def agronomy_spec() -> list[Feature]:
    """18 agronomy columns (vapour pressure, ET0, crop demand, balances)."""
    kc = _case_map("Crop_Growth_Stage", KC_MAP, KC_DEFAULT)
    return [
        Feature("_e_s", "0.6108 * exp(" + div("17.27 * {T}", "{T} + 237.3") + ")", keep=False),
        Feature("_e_a", "({RH} / 100.0) * {_e_s}", keep=False),
        Feature("vpd", "{_e_s} - {_e_a}"),
        Feature("vpd_normalized", div("{vpd}", "{_e_s} + 1e-6")),
        Feature("_Ra", "{SH} * 0.0820", keep=False),
        Feature("et0", "0.0023 * ({T} + 17.8) * {_Ra}"),
        Feature("et0_monthly", "{et0} * 30"),
        Feature("_kc", kc, keep=False),
        Feature("crop_water_demand", "{_kc} * {et0}"),
        Feature("crop_water_demand_mo", "{_kc} * {et0_monthly}"),
        Feature("effective_rainfall",
                "CASE WHEN {R} <= 75 THEN {R} * (125 - 0.2 * {R}) / 125 ELSE 125 + 0.1 * {R} END"),
        Feature("net_irrigation_need", "{crop_water_demand_mo} - {effective_rainfall}"),
        Feature("irrigation_deficit", clip_low("{net_irrigation_need}", 0.0)),
        Feature("water_balance", "{R} + {PI} - {et0_monthly}"),
        Feature("water_balance_sign", "sign({water_balance})"),
        Feature("soil_water_deficit", "25 - {SM}"),
        Feature("soil_water_deficit_pct", "{soil_water_deficit} / 25.0"),
        Feature("aridity_index", div("{R}", "{T} + 10 + 1e-6")),
        Feature("dew_point", "{T} - ((100 - {RH}) / 5.0)"),
        Feature("temp_dew_spread", "{T} - {dew_point}"),
        Feature("wind_evap_factor", "{et0} * (1 + 0.1 * {W})"),
        Feature("heat_wind_stress", "({T} / 30.0) * ({W} / 10.0) * (1 - {RH} / 100.0)"),
    ]


def expression_library_spec() -> list[Feature]:
    """111 derived columns in 13 families, generated from the parameter lists."""
    out: list[Feature] = [ratio(a, b) for a, b in LIB_RATIOS]
    for p in LIB_PRODUCTS:
        if p == "W_T_RH":
            out.append(Feature("W_T_RH_product", "{W} * {T} * (1 - {RH} / 100)"))
        else:
            out.append(product(*p))
    out += [Feature(n, e) for n, e in LIB_DIFFERENCES]
    out += [Feature(f"{x}_sq", f"{{{x}}} * {{{x}}}") for x in LIB_SQUARES]
    out += [Feature(f"{x}_cb", f"{{{x}}} * {{{x}}} * {{{x}}}") for x in LIB_CUBES]
    out += [Feature(f"{x}_sqrt", f"sqrt({clip_low('{' + x + '}', 0.0)})") for x in LIB_SQRTS]
    out += [Feature(f"log_{x}", log1p("{" + x + "}")) for x in LIB_LOGS]
    out += [Feature(f"exp_{x}_scaled", f"exp({clip_both('{' + x + '} / 100', -10.0, 10.0)})") for x in LIB_EXPS]
    for x in LIB_TRIG:
        out.append(Feature(f"sin_{x}", f"sin({{{x}}} * pi() / 180)"))
        out.append(Feature(f"cos_{x}", f"cos({{{x}}} * pi() / 180)"))
    out += [Feature(f"{x}_dist_{_num(c)}", f"abs({{{x}}} - {c!r})") for x, c in LIB_THRESHOLDS]
    out += [Feature(f"{x}_dist_{_num(c)}_sq", f"({{{x}}} - {c!r}) * ({{{x}}} - {c!r})")
            for x, c in LIB_THRESHOLD_SQUARES]
    for x, c, s in LIB_SIGMOIDS:
        arg = f"-({{{x}}} - {c!r})" if s == 1 else f"-({{{x}}} - {c!r}) / {s!r}"
        out.append(Feature(f"sigmoid_{x}_{c}", f"1 / (1 + exp({arg}))"))
    out += [Feature(f"harm_{a}_{b}", div(f"2 * {{{a}}} * {{{b}}}", f"{{{a}}} + {{{b}}} + 1e-6")) for a, b in LIB_HARMONIC]
    out += [Feature(f"geom_{a}_{b}", f"sqrt({clip_low('{' + a + '} * {' + b + '}', 0.0)})") for a, b in LIB_GEOMETRIC]
    for a, b in LIB_MINMAX:
        out.append(Feature(f"min_{a}_{b}", nan_min("{" + a + "}", "{" + b + "}")))
        out.append(Feature(f"max_{a}_{b}", nan_max("{" + a + "}", "{" + b + "}")))
    out += [Feature("_".join(t), " * ".join("{" + x + "}" for x in t)) for t in LIB_TRIPLES]
    return out
