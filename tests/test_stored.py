"""Tables and models that are read back, rows that do not fit, the prediction log, densities and sketches."""

import math
import random

import numpy as np
import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from furrow.operators.encoders import fit_sorted_codes
from furrow.operators.groups import density_curve, merge_sketches, quantile_sketches, rank_error, sketch_quantiles
from furrow.plans.features import FeatureModel
from furrow.session import scratch_path
from furrow.sources import artifacts
from furrow.sources import tables as T

SCHEMA = "id bigint not null, when date, name string, amount double"


def test_csv_rows_that_do_not_fit_are_kept_apart(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id,when,name,amount\n1,2024-01-31,"a, b",1.5\n2,2024-13-01,c,x\n3,,,\n,2024-01-01,d,2\n5,2024-01-02,e,3,4\n6,2024-01-03\n7,2024-01-04,"say ""hi""",1e3\n')
    rows, bad = T.read_checked(spark, str(path), SCHEMA)
    assert [(f.name, f.dataType.simpleString()) for f in rows.schema.fields] == [("id", "bigint"), ("when", "date"), ("name", "string"), ("amount", "double")]
    assert {r.id: r.amount for r in rows.collect()} == {1: 1.5, 3: None, 7: 1000.0}
    why = {r["id"]: r["reason"] for r in bad.collect()}
    assert set(why) == {"2", None, "5", "6"}
    assert why["2"] == "when is no date: 2024-13-01; amount is no double: x" and why[None] == "id is missing"
    assert "number of fields" in why["5"] and "number of fields" in why["6"]


def test_parquet_absent_columns_and_missing_paths(spark, tmp_path):
    path = f"{tmp_path}/p"
    spark.createDataFrame([("1", "2.5", 9), ("x", "3", 9), (None, "4", 9)], "id string, amount string, more int").write.parquet(path)
    rows, bad = T.read_checked(spark, path, SCHEMA)
    assert [tuple(r) for r in rows.collect()] == [(1, None, None, 2.5)]
    assert sorted(r["reason"] for r in bad.collect()) == ["id is missing", "id is no bigint: x"]
    assert bad.columns == ["id", "amount", "more", "reason"]
    for fmt in ("csv", "parquet"):
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            T.read_checked(spark, f"{tmp_path}/none.{fmt}", SCHEMA, fmt)
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            T.read_table(spark, f"{tmp_path}/none.{fmt}", SCHEMA, fmt)


def test_features_are_refused_when_their_files_changed(spark, tmp_path):
    path = f"{tmp_path}/f"
    df = spark.createDataFrame([(1, 2.0, "a")], "id int, x double, k string")
    T.write_features(df, path, {"numeric": ["x"]})
    back, columns = T.read_features(spark, path, ["x", "gone", "id"])
    assert columns == {"numeric": ["x"]} and [tuple(r) for r in back.collect()] == [(2.0, 0.0, 1)]
    T.write_features(df.unionAll(df), path)  # published over the old one
    assert T.read_features(spark, path)[0].count() == 2
    with pytest.raises(artifacts.ArtifactError, match="exists"):
        T.write_features(df, path, overwrite=False)
    with pytest.raises(ValueError, match="lacks"):
        T.write_features(df, f"{path}2", {"numeric": ["y"]})
    df.withColumn("x", F.col("x").cast("string")).write.mode("overwrite").parquet(f"{path}/data")
    with pytest.raises(artifacts.ArtifactError, match="schema"):
        T.read_features(spark, path)
    with pytest.raises(artifacts.ArtifactError, match="absent"):
        T.read_features(spark, f"{tmp_path}/none")


def test_submission_counts_and_misfits(spark, tmp_path):
    df = spark.createDataFrame([(i, "Low" if i % 3 else "High", 0.5) for i in range(9)], "id long, label string, p double")
    counts = T.write_submission(df, "id", "label", f"{tmp_path}/s")
    assert {r["label"]: r["count"] for r in counts.collect()} == {"Low": 6, "High": 3}
    assert T.read_submission(spark, f"{tmp_path}/s", "id long, label string").count() == 9
    with pytest.raises(Exception, match="MALFORMED|malformed|FAILFAST"):
        T.read_submission(spark, f"{tmp_path}/s", "id long, label int").collect()


def test_the_same_batch_is_logged_once(spark, tmp_path):
    path, schema = f"{tmp_path}/log", "id long, predicted_class string"
    assert T.read_prediction_log(spark, path, schema).count() == 0
    a = spark.createDataFrame([(1, "Low"), (2, "High")], schema)
    for _ in range(2):
        T.prediction_log_sink(a, path, "first")
    T.prediction_log_sink(a.limit(1), path, 7)
    log = T.read_prediction_log(spark, path, schema).collect()
    assert sorted((r.batch_id, r.id) for r in log) == [("7", 1), ("first", 1), ("first", 2)] and all(r.timestamp for r in log)


def test_half_written_and_altered_models_are_refused(spark, tmp_path):
    codes = fit_sorted_codes(spark.createDataFrame([("a",), ("b",)], "k string"), ["k"])
    model = FeatureModel(id_col="id", code_table=codes.table, code_defaults=codes.defaults, feature_cols=["k_factorized"])
    path = f"{tmp_path}/m"
    model.save(path)
    assert FeatureModel.load(spark, path).code_defaults == {"k": -1}
    with pytest.raises(artifacts.ArtifactError, match="exists"):
        model.save(path)
    model.save(path, overwrite=True)
    codes.table.withColumn("code", F.col("code").cast("string")).write.mode("overwrite").parquet(f"{path}/codes")
    with pytest.raises(artifacts.ArtifactError, match="codes: its schema"):
        FeatureModel.load(spark, path)

    def dies(folder):
        codes.table.write.parquet(f"{folder}/codes")
        raise OSError("lost")

    with pytest.raises(OSError):
        artifacts.publish(spark, f"{tmp_path}/half", "feature model", dies, {})
    with pytest.raises(artifacts.ArtifactError, match="absent or was not finished"):
        FeatureModel.load(spark, f"{tmp_path}/half")
    artifacts.publish(spark, f"{tmp_path}/other", "something else", lambda f: None, {})
    with pytest.raises(artifacts.ArtifactError, match="something else"):
        FeatureModel.load(spark, f"{tmp_path}/other")


def test_density_is_near_the_direct_sum(spark):
    rng = random.Random(3)
    rows = [("a", rng.gauss(0, 1)) for _ in range(2000)] + [("b", rng.choice([1.0, 1.0, 50.0]) + rng.random()) for _ in range(500)]
    rows += [(None, float(i % 7)) for i in range(90)] + [("one", 5.0)] * 20 + [("few", None), ("few", float("nan")), ("few", 1.0)]
    got = {}
    for r in density_curve(spark.createDataFrame(rows, "k string, v double").repartition(4), "v", ["k"]).collect():
        got.setdefault(r["k"], {})[r["point"]] = (r["x"], r["density"])
    assert set(got) == {"a", "b", None} and all(sorted(v) == list(range(200)) for v in got.values())
    for k, curve in got.items():
        v = np.array([x for g, x in rows if g == k])
        bw = v.std(ddof=1) * len(v) ** -0.2
        x = np.array([curve[i][0] for i in range(200)])
        assert np.allclose(x, np.linspace(v.min() - 3 * bw, v.max() + 3 * bw, 200))
        want = np.exp(-0.5 * ((x[:, None] - v) / bw) ** 2).sum(1) / (len(v) * bw * math.sqrt(2 * math.pi))
        assert np.abs(np.array([curve[i][1] for i in range(200)]) - want).max() < 1e-3 * want.max()


def test_sketch_ranks_are_within_their_bound(spark):
    probs, names = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0], list("abcdefg")
    rng = random.Random(4)
    # a hot group with half its rows on one value, and small ones
    rows = [("hot", i % 5, 7.0 if rng.random() < 0.5 else rng.expovariate(0.1)) for i in range(60_000)]
    rows += [(f"g{i % 3}", i % 5, float(i)) for i in range(300)] + [("g0", 1, None), ("g1", 1, float("nan")), ("none", 0, None)]
    df = spark.createDataFrame(rows, "k string, part int, v double").repartition(8)
    merged = merge_sketches(quantile_sketches(df, ["k", "part"], "v"), ["k"])
    for sketches in (quantile_sketches(df, ["k"], "v"), merged):
        found = {r["k"]: r for r in sketch_quantiles(sketches, ["k"], probs, names).collect()}
        assert set(found) == {"hot", "g0", "g1", "g2"}
        for k, r in found.items():
            v = np.array([x for g, _, x in rows if g == k and x is not None and not math.isnan(x)])
            assert r["n"] == len(v)
            for p, c in zip(probs, names, strict=True):
                low, high = (v < r[c]).mean(), (v <= r[c]).mean()  # the ranks that its equal values cover
                slack = rank_error(800) + 1 / len(v)
                assert low - slack <= p <= high + slack, (k, p, low, high)
    assert rank_error(800) < 0.004 and sketches.agg(F.max(F.length("sketch"))).first()[0] < 40_000
