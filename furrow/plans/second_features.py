"""The second feature set (I4): formula score, fixed bins, decimal split,
positional digits with range rounding, agronomy columns, the expression
library, crosses with count encoding, and dropping test-constant columns.

Order matters as in the original: digits are taken from the raw values, then
each source column is rounded by its train maximum and every later step sees
the rounded value.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from furrow.functions import bands, crosses
from furrow.functions.nulls import normalise_numeric
from furrow.functions.scalar import spec_columns
from furrow.operators.encoders import fit_count_encoder
from furrow.operators.impute import column_max, constant_columns
from furrow.plans import irrigation as irr
from furrow.session import tune_wide, write_table


def _stage(df: DataFrame, maxes: dict) -> DataFrame:
    num = irr.SECOND_NUM_COLS
    out = df.select("*", *spec_columns(irr.formula_spec()))
    out = out.select("*", *[bands.fixed_bins(c, e).alias(f"{c}_bin") for c, e in irr.FIXED_BIN_EDGES.items()])
    out = out.select("*", *[x for c in num for x in (bands.decimal_int(c).alias(f"{c}_int"),
                                                     bands.decimal_frac(c).alias(f"{c}_dec"))])
    digits = [bands.positional_digit(c, k).alias(f"{c}_digit{k}") for c in num for k in irr.DIGIT_POSITIONS]
    out = out.select(*[bands.round_by_max(c, maxes[c]).alias(c) if c in num else F.col(c) for c in out.columns],
                     *digits)
    out = out.select("*", *spec_columns(irr.agronomy_spec(), irr.SHORT))
    return out.select("*", *spec_columns(irr.expression_library_spec(), irr.SHORT))


def run_all_features(train: DataFrame, test: DataFrame) -> tuple[DataFrame, DataFrame, list[str]]:
    """Returns ``(train, test, dropped_columns)``.

    Crosses and their counts depend on the categories alone, so they are joined
    while the rows are narrow; the wide columns follow in one projection of a written table.
    """
    tune_wide(train.sparkSession)
    groups = [*irr.CROSS_PAIRS, *irr.CROSS_TRIPLETS]
    names = ["__".join(g) for g in groups]
    cats = [*irr.BASE_CATEGORICAL_COLS, *names]
    raw = {}
    for key, df in (("train", train), ("test", test)):
        raw[key] = write_table(normalise_numeric(df).select("*", *crosses.nway_crosses(groups)), f"second-{key}")
    maxes = column_max(raw["train"], irr.SECOND_NUM_COLS)
    enc = fit_count_encoder(raw["train"], cats)

    def build(key: str, df: DataFrame) -> DataFrame:
        coded = enc.transform(raw[key], cats, suffix="__ce").withColumnsRenamed({f"{c}__ce": f"ce_{c}" for c in cats})
        out = _stage(write_table(coded, f"second-{key}-coded"), maxes)
        last = [*names, *[f"ce_{c}" for c in cats]]
        return out.select(*df.columns, *[c for c in out.columns if c not in df.columns and c not in last], *last)

    # both stay projections of written tables: only the few columns that may be constant are worked out twice
    tr, te = build("train", train), build("test", test)
    drop = constant_columns(te)
    return tr.drop(*drop), te.drop(*drop), drop
