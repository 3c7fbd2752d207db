import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from furrow.operators.ranking import cumulative_sums, exact_group_quantiles, rank_in_group


def test_rank_matches_sorted_position_with_hot_group(spark):
    # one group holds most rows and many ties: rank must still be exact
    rows = [(i, "hot" if i % 10 else "cold", float(i % 7)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g string, v double")
    out = rank_in_group(df, ["g"], ["v", "id"], "r").toPandas()
    exp = out.sort_values(["g", "v", "id"]).groupby("g").cumcount() + 1
    assert (out.sort_values(["g", "v", "id"])["r"].values == exp.values).all()


def test_global_rank_without_groups(spark):
    df = spark.createDataFrame([(i, float((i * 37) % 101)) for i in range(500)], "id long, v double")
    out = rank_in_group(df, [], ["v", "id"], "r").toPandas().sort_values(["v", "id"])
    assert list(out["r"]) == list(range(1, 501))


def test_exact_quantiles_match_pandas_linear(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.choice(["a", "b", None], 900), "v": rng.normal(size=900).round(2)})
    pdf.loc[::17, "v"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None), "g string, v double")
    got = exact_group_quantiles(df, ["g"], "v", [0.1, 0.5, 0.9], names=["p10", "p50", "p90"]).toPandas()
    for _, row in got.iterrows():
        sub = pdf[pdf["g"].isna()] if row["g"] is None else pdf[pdf["g"] == row["g"]]
        for q, name in [(0.1, "p10"), (0.5, "p50"), (0.9, "p90")]:
            assert abs(sub["v"].quantile(q) - row[name]) < 1e-12


def test_cumulative_sums(spark):
    df = spark.createDataFrame([("a", 1.0, 2), ("a", 2.0, 3), ("b", 1.0, 5), ("a", 3.0, 1)], "g string, v double, w long")
    out = cumulative_sums(df, ["g"], ["v"], {"w": "cw"}).orderBy("g", "v").select("cw").toPandas()
    assert list(out["cw"]) == [2, 5, 6, 5]
