"""The steps that keep the wide build short: medians without a full sort, one broadcast for all target keys."""

import math
import random
from unittest.mock import Mock

from py4j.protocol import Py4JError
from pyspark.sql import functions as F

from furrow.operators.encoders import CodeMap, fit_count_encoder, fit_frequency_rank, fit_sorted_codes
from furrow.operators.groups import fit_group_lookups
from furrow.operators.impute import medians, wide_medians
from furrow.operators.lookups import BUNDLE, pack_and_join
from furrow.operators.target import TargetEncoder, TargetGlobals, small_keys, target_columns, target_encode_oof, target_joins, target_tables
from furrow.session import planned_once, release, trim_native_heap


def test_wide_medians_are_exact(spark):
    r = random.Random(5)
    rows = [(r.gauss(0, 1), float(r.randrange(3)), i if i % 3 else None, math.nan if i % 2 else r.random(), None, 7,
             float(i) if i % 3 else math.inf, 0.0 if i < 3001 else float(i)) for i in range(6000)]
    df = spark.createDataFrame(rows, "a double, ties double, holes int, nan double, empty double, same int, inf double, edge double").repartition(5)
    assert wide_medians(df, df.columns) == medians(df, df.columns)
    for n in (0, 1, 2, 3):
        assert wide_medians(df.limit(n).where("a < 9"), ["a", "holes"]).keys() == {"a", "holes"}
    few = spark.createDataFrame([(1.0,), (4.0,)], "a double")
    assert wide_medians(few, ["a"]) == {"a": 2.5} and wide_medians(few.limit(1), ["a"]) == medians(few.limit(1), ["a"])
    assert wide_medians(few, []) == {}


def test_rows_with_and_without_a_fold_share_the_joins(spark):
    r = random.Random(3)
    keys = ["p", "q", "s"]
    df = spark.createDataFrame([(i, *[r.choice(["x", "y", "z", None]) for _ in keys], r.randrange(3), i % 4) for i in range(300)],
                               "id long, p string, q string, s string, y int, fold int")
    test = df.where("id % 5 = 0").withColumn("fold", F.lit(None).cast("int")).unionByName(spark.createDataFrame([(900, "new", None, "x", None, None)], df.schema))
    g = TargetGlobals.fit(df, "y")
    table = target_tables(df, keys, "y", "fold", g)
    packed = pack_and_join(df.unionByName(test), target_joins(table, {k: F.col(k) for k in keys}, ["fold"], g, small_keys(table)))
    with planned_once(spark):
        plan = packed._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") == len(keys) - 1
    got = packed.select("__row.*", *target_columns(keys, g))
    oof = target_encode_oof(df, keys, "y", "fold", g)
    full = TargetEncoder.fit(df, keys, "y", g=g).transform(test)

    def rows(x):
        return sorted(tuple(round(v, 9) if isinstance(v, float) else str(v) for v in row) for row in x.select(sorted(x.columns)).collect())

    assert rows(got.where("fold IS NOT NULL")) == rows(oof)
    assert rows(got.where("fold IS NULL")) == rows(full)


def test_code_joins_of_a_small_table_share_a_broadcast(spark):
    cols = ["p", "q", "s"]
    df = spark.createDataFrame([("a", "1", None), ("b", None, "x"), ("a", "2", "x"), (None, "1", "a")], "p string, q string, s string")
    rows = df.unionByName(spark.createDataFrame([("1", "a", "new")], df.schema))
    for codes in (fit_sorted_codes(df, cols), fit_count_encoder(df, cols), fit_frequency_rank(df, cols, 1)):
        out = codes.transform(rows, cols, suffix="_code")
        with planned_once(spark):
            plan = out._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ReusedExchange") == len(cols) - 1
        # the same codes as by a slice of the table for each column
        apart = CodeMap(codes.table, codes.defaults, codes.fill_missing, codes.out_type, small=False)
        assert sorted(map(str, out.collect())) == sorted(map(str, apart.transform(rows, cols, suffix="_code").collect()))
    found = fit_sorted_codes(df, cols).transform(rows, cols, suffix="_code")
    assert sorted(tuple(r) for r in found.select("p_code", "q_code", "s_code").collect()) == sorted([(1, 0, 0), (2, 2, 2), (1, 1, 2), (0, 0, 1), (-1, -1, -1)])


def test_quantiles_of_a_key_are_one_join(spark):
    r = random.Random(7)
    rows = [(r.choice(["x", "y", None]), r.randrange(3), r.gauss(0, 1), float(r.randrange(4)) if i % 3 else None, math.inf if i % 50 == 0 else r.random())
            for i in range(400)]
    rows += [("bare", 9, None, None, math.nan)] * 2  # a group without a value
    df = spark.createDataFrame(rows, "k string, n int, a double, b double, c double")
    cols = ["a", "b", "c"]
    lookups = fit_group_lookups(df, {"k": (cols, ["mean", "median", "count"]), "n": (["a", "b"], ["median"])}, {"k": ["a", "c"]}, [10, 90])
    for key, wanted in (("k", [(c, "median", 0.5) for c in cols] + [(c, f"q{p}", p / 100) for c in ("a", "c") for p in (10, 90)]),
                        ("n", [(c, "median", 0.5) for c in ("a", "b")])):
        with planned_once(spark):
            plan = lookups[key]._jdf.queryExecution().executedPlan().toString()
        assert plan.count("HashJoin") == 1
        got = {row[key]: row for row in lookups[key].collect()}
        assert set(got) == {row[0 if key == "k" else 1] for row in rows}
        for value, row in got.items():
            for c, name, p in wanted:
                have = sorted(v for v in (x["k n a b c".split().index(c)] for x in rows if x["kn".index(key)] == value) if v is not None and not math.isnan(v))
                if not have:
                    assert row[f"FE_{key}_{c}_{name}"] is None
                    continue
                h = (len(have) - 1) * p
                lo, hi = have[math.floor(h)], have[math.ceil(h)]
                assert math.isclose(row[f"FE_{key}_{c}_{name}"], lo + (h - math.floor(h)) * (hi - lo), rel_tol=1e-12, abs_tol=1e-12)


def _joins(plan):
    below = [plan.children().apply(i) for i in range(plan.children().size())]
    return [plan] * (plan.nodeName() == "Join") + [x for p in below for x in _joins(p)]


def test_many_lookups_copy_few_columns_and_give_the_same(spark):
    n = 2 * BUNDLE + 3
    df = spark.createDataFrame([(i, [None, "a", "b", "unseen"][i % 4]) for i in range(12)] + [(None, None), (3, "a"), (3, "a")], "id long, k string")
    lookups = [spark.createDataFrame([(None, 100 + j), ("a", 200 + j), ("b", None)], "k string, v int") for j in range(n)]
    joins = [(f"__x{j}", [F.concat(F.lit(""), F.col("k"))], lk, ["k"], ["v"], True) for j, lk in enumerate(lookups)]
    packed = pack_and_join(df, joins)
    assert packed.columns == ["__row", *[f"__x{j}" for j in range(n)]]
    found = packed.select("__row.*", *[F.col(f"__x{j}")["v"].alias(f"v{j}") for j in range(n)], F.col("__x0").isNull().alias("none")).collect()
    want = [(r["id"], r["k"], *[{None: 100 + j, "a": 200 + j}.get(r["k"]) for j in range(n)], r["k"] == "unseen") for r in df.collect()]
    assert sorted(map(tuple, found), key=str) == sorted(want, key=str)
    widths = [p.output().size() for p in _joins(packed._jdf.queryExecution().optimizedPlan())]
    assert len(widths) == n and max(widths) <= 4 + n // BUNDLE + BUNDLE, widths
    assert pack_and_join(df, []).select("__row.*").count() == df.count()


def test_release_gives_freed_native_memory_back(spark):
    said = trim_native_heap(spark)
    assert said is None or said.startswith("Trim native heap")
    release(spark)
    other = Mock()
    other.sparkContext._jvm.java.lang.Class.forName.side_effect = Py4JError("no such command")
    assert trim_native_heap(other) is None
