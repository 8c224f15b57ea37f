"""Dimensions, keys, integrity and layers."""

from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

from civicloom.functions.parse import percent_of_label
from civicloom.operators import model
from civicloom.plans import places
from civicloom.plans.layers import Warehouse
from civicloom.queries.registry import query
from civicloom.session import scratch_path


@query(
    """
    SELECT CAST(row_number() OVER (ORDER BY num) AS BIGINT) AS brand_key, p_brand, num FROM
      (SELECT DISTINCT p_brand, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS num FROM part) d"""
)
def surrogate_key(t):
    """Dense keys for brands in numeric, not text, order."""
    number = F.regexp_extract("p_brand", "([0-9]+)", 1).cast("int")
    brands = t.part.select("p_brand", number.alias("num"))
    return model.dimension(brands, ["p_brand", "num"], "brand_key", ["num"])


@query(
    """
    SELECT row_number() OVER (ORDER BY l_partkey NULLS LAST, l_suppkey NULLS LAST) AS pair_key, l_partkey, l_suppkey
    FROM (SELECT DISTINCT CASE WHEN l_discount = 0.1 AND l_quantity = 50 THEN NULL ELSE l_partkey END AS l_partkey, l_suppkey FROM lineitem) d"""
)
def surrogate_key_large(t):
    """A dimension as long as the fact it comes from: part/supplier pairs, NULLs last."""
    missing = (F.col("l_discount") == 0.1) & (F.col("l_quantity") == 50)
    part = F.when(~missing, F.col("l_partkey")).alias("l_partkey")
    return model.dimension(
        t.lineitem.select(part, "l_suppkey"), ["l_partkey", "l_suppkey"], "pair_key"
    )


@query(
    """
    SELECT CAST(row_number() OVER (ORDER BY pct) AS BIGINT) AS level_key, label, pct FROM (SELECT DISTINCT CAST(CAST(round(l_tax * 100) AS INTEGER) AS VARCHAR) || '% tax' AS label,
      CAST(round(l_tax * 100) AS INTEGER) AS pct FROM lineitem) d"""
)
def level_dimension(t):
    """Percent labels keyed by their number, so 10% does not sort before 2%."""
    label = F.concat(F.round(F.col("l_tax") * 100).cast("int").cast("string"), F.lit("% tax"))
    levels = t.lineitem.select(label.alias("label")).withColumn("pct", percent_of_label("label"))
    return model.dimension(levels, ["label", "pct"], "level_key", ["pct"])


@query(
    """
    SELECT l_orderkey, l_linenumber, count(*) AS occurrences, CASE WHEN l_orderkey IS NULL THEN 'null key' ELSE 'duplicate key' END AS problem
    FROM (SELECT CASE WHEN l_tax = 0.08 AND l_quantity = 1 THEN NULL ELSE l_orderkey END AS l_orderkey, l_linenumber FROM lineitem) x
    GROUP BY 1, 2 HAVING count(*) > 1 OR l_orderkey IS NULL"""
)
def pk_violations(t):
    """Line keys that repeat or lack a part."""
    missing = (F.col("l_tax") == 0.08) & (F.col("l_quantity") == 1)
    rows = t.lineitem.select(F.when(~missing, F.col("l_orderkey")).alias("l_orderkey"), "l_linenumber")
    return model.key_violations(rows, ["l_orderkey", "l_linenumber"])


@query(
    """
    SELECT l_partkey, count(*) AS fact_rows FROM lineitem
    WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 45) GROUP BY 1"""
)
def fk_violations(t):
    """Line parts missing from a reduced part dimension."""
    return model.orphan_keys(t.lineitem, t.part.where("p_size < 45"), ["l_partkey"], ["p_partkey"])


@query(
    """
    SELECT c_custkey, c_name, c_nationkey FROM customer WHERE c_acctbal >= 0
    UNION ALL
    SELECT c_custkey, min('new ' || c_name), min(c_nationkey) FROM customer
    WHERE c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY 1"""
)
def insert_if_absent(t):
    """Known keys keep their row; new keys are added once even when offered twice."""
    known = t.customer.where("c_acctbal >= 0").select("c_custkey", "c_name", "c_nationkey")
    offered = t.customer.select(
        "c_custkey", F.concat(F.lit("new "), "c_name").alias("c_name"), "c_nationkey"
    )
    twice = offered.unionByName(offered.withColumn("c_name", F.concat("c_name", F.lit("!"))))
    return model.append_missing(known, twice, ["c_custkey"])


@query("SELECT '37' || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') AS \"county_GEOID\", n_name || ' County' AS county_name FROM nation")
def dim_county(t):
    """A stored dimension that takes in the counties it lacks, offered twice."""
    root = scratch_path(t.spark, "counties")
    house = Warehouse(t.spark, root, prefix=f"c{root[-8:]}_")
    code = F.concat(F.lit("37"), F.lpad(F.col("n_nationkey").cast("string"), 3, "0"))
    named = F.concat("n_name", F.lit(" County"))
    counties = t.nation.select(code.alias("county_GEOID"), named.alias("county_name"), "n_regionkey")
    house.replace("gold", "dim_county", counties.where("n_regionkey = 2").drop("n_regionkey"))
    for _ in range(2):
        stored = house.insert("gold", "dim_county", counties.drop("n_regionkey"), ["county_GEOID"])
    return stored


@query(
    """
    SELECT CAST(c_custkey AS VARCHAR) AS "block_GEOID", c_name AS block_name, 'shape ' || c_custkey AS geometry FROM customer WHERE c_acctbal >= 0"""
)
def dim_block(t):
    """Blocks of one county with their boundary."""
    key = F.col("c_custkey").cast("string")
    features = t.customer.select(
        key.alias("GEOID20"),
        F.col("c_name").alias("NAME20"),
        F.when(F.col("c_acctbal") >= 0, "119").otherwise("025").alias("COUNTYFP20"),
        F.concat(F.lit("shape "), key).alias("geometry"),
    )
    return places.block_dimension(places.clean_blocks(features))


ORDER_SCHEMA = StructType(
    [
        StructField("order_key", LongType(), False),
        StructField("order_day", DateType()),
        StructField("price", DoubleType()),
        StructField("priority", StringType()),
        StructField("class", IntegerType()),
    ]
)


@query(
    """
    SELECT o_orderkey AS order_key, CAST(o_orderdate AS DATE) AS order_day, o_totalprice AS price, o_orderpriority AS priority,
           CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS class FROM orders"""
)
def declared_schema(t):
    """Any column order and types conformed to a declared schema."""
    rough = t.orders.select(
        F.substring("o_orderpriority", 1, 1).alias("class"),
        F.col("o_orderpriority").alias("priority"),
        F.col("o_totalprice").cast("string").alias("price"),
        F.col("o_orderkey").cast("string").alias("order_key"),
        F.col("o_orderdate").alias("order_day"),
    )
    return model.conform(rough, ORDER_SCHEMA)


@query(
    """
    SELECT 'gold.dim_nation' AS table_name, count(*) AS n, CAST(sum(n_regionkey) AS BIGINT) AS checksum FROM nation
    UNION ALL SELECT 'silver.orders', count(*), CAST(sum(o_orderkey) AS BIGINT) FROM orders"""
)
def layer_snapshot(t):
    """Replace tables in two layers, reset a third, copy all, and read the copy back."""
    root = scratch_path(t.spark, "layers")
    house = Warehouse(t.spark, root, prefix=f"w{root[-8:]}_")
    keyed = t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice")
    house.replace("silver", "orders", keyed.where("o_orderkey < 0"))
    house.replace("silver", "orders", keyed, partition_by=["o_orderstatus"])
    house.replace("gold", "dim_nation", t.nation)
    house.replace("main", "stale", t.region)
    house.reset("main")
    target = scratch_path(t.spark, "copy")
    copied = house.snapshot(target)
    sums = {"silver.orders": "o_orderkey", "gold.dim_nation": "n_regionkey"}
    if sorted(copied) != sorted(sums):
        raise AssertionError(f"unexpected tables in the copy: {copied}")
    parts = [
        t.spark.read.parquet(f"{target}/{name.replace('.', '/')}").agg(
            F.lit(name).alias("table_name"),
            F.count(F.lit(1)).alias("n"),
            F.sum(column).cast("bigint").alias("checksum"),
        )
        for name, column in sums.items()
    ]
    return parts[0].unionByName(parts[1])


