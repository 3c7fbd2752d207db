"""The irrigation roles mapped onto the driver tables.

The irrigation data itself is not supplied, so the catalogue runs the same
operators on ``orders`` joined with ``customer``, ``nation``, ``region`` and a
per-order ``lineitem`` aggregate, renamed to the 11 numeric and 8 categorical
roles. Only order-independent aggregates (max, min, count) feed the numerics,
so Spark and DuckDB see bit-identical inputs. Orders without line items give
NULL numerics (left join) and ``NULLIF`` makes NULL categories, which
exercises the missing-value rules.

At scale the lineitem aggregate is a partial (map-side) aggregation keyed by
order; the dimension tables are joined with size-checked broadcasts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from furrow.operators.lookups import join_lookup
from furrow.sources.tables import load

ROLE_SQL = """
WITH la AS (
  SELECT l_orderkey, max(l_tax) AS mx_tax, max(l_quantity) AS mx_qty, min(l_discount) AS mn_disc,
         max(l_discount) AS mx_disc, min(l_extendedprice) AS mn_price, count(*) AS n_lines,
         max(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS any_open
  FROM lineitem GROUP BY l_orderkey),
field AS (
  SELECT o.o_orderkey AS id,
    la.mx_tax * 100 AS "Soil_pH",
    la.mx_qty AS "Soil_Moisture",
    la.mn_disc * 10 AS "Organic_Carbon",
    c.c_acctbal / 3000.0 AS "Electrical_Conductivity",
    CAST(month(o.o_orderdate) - 1 AS DOUBLE) * 3.5 AS "Temperature_C",
    CAST(dayofmonth(o.o_orderdate) AS DOUBLE) * 3.0 AS "Humidity",
    o.o_totalprice / 200.0 AS "Rainfall_mm",
    CAST(la.n_lines AS DOUBLE) + 4.0 AS "Sunlight_Hours",
    la.mx_disc * 200 AS "Wind_Speed_kmh",
    CAST(c.c_nationkey AS DOUBLE) / 2.0 AS "Field_Area_hectare",
    la.mn_price / 100.0 AS "Previous_Irrigation_mm",
    c.c_mktsegment AS "Soil_Type",
    NULLIF(o.o_orderpriority, '3-MEDIUM') AS "Crop_Type",
    CASE quarter(o.o_orderdate) WHEN 1 THEN 'Sowing' WHEN 2 THEN 'Vegetative' WHEN 3 THEN 'Flowering'
         ELSE 'Harvest' END AS "Crop_Growth_Stage",
    CASE o.o_orderstatus WHEN 'F' THEN 'Rabi' WHEN 'O' THEN 'Zaid' ELSE 'Kharif' END AS "Season",
    n.n_name AS "Irrigation_Type",
    NULLIF(rg.r_name, 'AFRICA') AS "Water_Source",
    CASE WHEN la.any_open = 1 THEN 'Yes' ELSE 'No' END AS "Mulching_Used",
    CAST(year(o.o_orderdate) AS VARCHAR) AS "Region",
    CASE WHEN o.o_totalprice >= 350000 THEN 2 WHEN o.o_totalprice >= 150000 THEN 1 ELSE 0 END AS "Irrigation_Need",
    CASE WHEN o.o_orderdate >= TIMESTAMP '1999-01-01' THEN 'test' ELSE 'train' END AS split
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region rg ON n.n_regionkey = rg.r_regionkey
  LEFT JOIN la ON o.o_orderkey = la.l_orderkey)
"""


def field_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spark twin of :data:`ROLE_SQL` (``field`` CTE): one row per order."""
    li = load(spark, sf_dir, "lineitem")
    la = li.groupBy("l_orderkey").agg(
        F.max("l_tax").alias("mx_tax"),
        F.max("l_quantity").alias("mx_qty"),
        F.min("l_discount").alias("mn_disc"),
        F.max("l_discount").alias("mx_disc"),
        F.min("l_extendedprice").alias("mn_price"),
        F.count(F.lit(1)).alias("n_lines"),
        F.max(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("any_open"),
    )
    o = load(spark, sf_dir, "orders")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_nationkey", "c_mktsegment")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    rg = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    dims = join_lookup(
        join_lookup(c, n.withColumnRenamed("n_nationkey", "c_nationkey"), ["c_nationkey"], how="inner",
                    null_safe=False),
        rg.withColumnRenamed("r_regionkey", "n_regionkey"), ["n_regionkey"], how="inner", null_safe=False,
    ).withColumnRenamed("c_custkey", "o_custkey")
    base = o.join(dims, "o_custkey", "inner").join(
        la.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey", "left"
    )
    d = F.col("o_orderdate")
    return base.select(
        F.col("o_orderkey").alias("id"),
        (F.col("mx_tax") * 100).alias("Soil_pH"),
        F.col("mx_qty").alias("Soil_Moisture"),
        (F.col("mn_disc") * 10).alias("Organic_Carbon"),
        (F.col("c_acctbal") / 3000.0).alias("Electrical_Conductivity"),
        ((F.month(d) - 1).cast("double") * 3.5).alias("Temperature_C"),
        (F.dayofmonth(d).cast("double") * 3.0).alias("Humidity"),
        (F.col("o_totalprice") / 200.0).alias("Rainfall_mm"),
        (F.col("n_lines").cast("double") + 4.0).alias("Sunlight_Hours"),
        (F.col("mx_disc") * 200).alias("Wind_Speed_kmh"),
        (F.col("c_nationkey").cast("double") / 2.0).alias("Field_Area_hectare"),
        (F.col("mn_price") / 100.0).alias("Previous_Irrigation_mm"),
        F.col("c_mktsegment").alias("Soil_Type"),
        F.nullif(F.col("o_orderpriority"), F.lit("3-MEDIUM")).alias("Crop_Type"),
        F.when(F.quarter(d) == 1, "Sowing").when(F.quarter(d) == 2, "Vegetative")
        .when(F.quarter(d) == 3, "Flowering").otherwise("Harvest").alias("Crop_Growth_Stage"),
        F.when(F.col("o_orderstatus") == "F", "Rabi").when(F.col("o_orderstatus") == "O", "Zaid")
        .otherwise("Kharif").alias("Season"),
        F.col("n_name").alias("Irrigation_Type"),
        F.nullif(F.col("r_name"), F.lit("AFRICA")).alias("Water_Source"),
        F.when(F.col("any_open") == 1, "Yes").otherwise("No").alias("Mulching_Used"),
        F.year(d).cast("string").alias("Region"),
        F.when(F.col("o_totalprice") >= 350000, 2).when(F.col("o_totalprice") >= 150000, 1)
        .otherwise(0).alias("Irrigation_Need"),
        F.when(d >= F.lit("1999-01-01").cast("timestamp"), "test").otherwise("train").alias("split"),
    )
