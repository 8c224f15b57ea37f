"""Drafts, keyed and ordered writes, and copies that can be checked."""

import glob

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from civicloom.plans import build, survey
from civicloom.plans.layers import Warehouse, changed


@pytest.fixture
def house(spark, tmp_path):
    made = Warehouse(spark, str(tmp_path / "tables"), prefix=f"d{tmp_path.name[-6:].replace('-', '_')}_")
    yield made
    for layer in ("bronze", "silver", "gold", "main"):
        made.reset(layer)


def test_a_draft_is_read_by_nobody_until_it_is_published(house, spark):
    house.replace("gold", "t", spark.range(3).toDF("k"))
    before = house.table("gold", "t")
    draft = house.draft("gold")
    draft.replace("gold", "t", spark.range(5).toDF("k"))
    assert house.table("gold", "t").count() == 3 and draft.table("gold", "t").count() == 5
    assert house.tables("gold") == draft.tables("gold") == ["t"]
    draft.publish("gold")
    assert house.table("gold", "t").count() == draft.table("gold", "t").count() == 5
    assert before.count() == 3  # the version before stays for plans that read it
    other = house.draft("gold")
    other.replace("gold", "u", spark.range(1).toDF("k"))
    other.publish("gold")
    assert house.tables("gold") == ["u"]
    house.reset("gold")
    assert house.tables("gold") == []


def test_a_failed_rebuild_leaves_the_layer(house, spark, monkeypatch):
    house.replace("gold", "dim_region", spark.createDataFrame([(1, "R")], "region_key long, region_name string"))
    databases = {r[0] for r in spark.sql("SHOW DATABASES").collect()}

    def fails(draft):
        draft.replace("gold", "dim_region", spark.createDataFrame([(9, "X")], "region_key long, region_name string"))
        raise RuntimeError("lost")

    monkeypatch.setattr(build, "_star", fails)
    with pytest.raises(RuntimeError, match="lost"):
        build.model_star(house)

    def breaks(draft):
        twice = spark.createDataFrame([(1, "X"), (1, "Y"), (None, "Z")], "region_key long, region_name string")
        draft.replace("gold", "dim_region", twice)
        return [], []

    monkeypatch.setattr(build, "_star", breaks)
    with pytest.raises(build.BrokenKeys, match="duplicate key"):
        build.model_star(house)
    assert [tuple(r) for r in house.table("gold", "dim_region").collect()] == [(1, "R")]
    assert {r[0] for r in spark.sql("SHOW DATABASES").collect()} == databases


def test_keys_are_counted_while_they_are_written(house, spark):
    rows = spark.range(1000).select((F.col("id") % 990).alias("a"), F.when(F.col("id") > 4, F.col("id")).alias("b"))
    house.replace("gold", "t", rows, key=["a"])
    assert house.key_checks["gold", "t"] == {"repeated": 10, "null": 0}
    house.replace("gold", "t", rows, key=["a", "b"])
    assert house.key_checks["gold", "t"] == {"repeated": 0, "null": 5}
    house.replace("gold", "t", rows.where("false"), key=["a"])
    assert house.key_checks["gold", "t"] == {"repeated": 0, "null": 0}
    assert house.table("gold", "t").columns == ["a", "b"]


def test_a_key_costs_one_exchange(house, spark, monkeypatch):
    grouped = spark.range(100).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))
    plans = []
    monkeypatch.setattr(house, "table", lambda *_: None)
    real = type(grouped.write).saveAsTable
    monkeypatch.setattr(type(grouped.write), "saveAsTable", lambda w, name, **k: (plans.append(w._df._jdf.queryExecution().executedPlan().toString()), real(w, name, **k))[1])
    house.replace("gold", "t", grouped, key=["k"])
    assert plans[0].count("Exchange hashpartitioning") == 1


def test_files_in_name_order_are_the_order(house, spark, tmp_path):
    rows = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("a"), (F.col("id") % 3).alias("b")).repartition(7)
    house.replace("main", "t", rows, order_by=[F.desc("b"), "a"])
    names = sorted(glob.glob(f"{tmp_path}/tables/main/t/part-*.parquet"))
    read = [(r["b"], r["a"]) for n in names for r in pq.read_table(n).to_pylist()]
    assert read == sorted(read, key=lambda r: (-r[0], r[1])) and len(read) == 5000


def test_a_changed_copy_is_found(house, spark, tmp_path):
    rows = spark.range(50).select(F.col("id").alias("k"), F.when(F.col("id") > 3, F.col("id") / 7).alias("v"), F.create_map(F.lit("a"), "id").alias("m"))
    house.replace("gold", "t", rows)
    house.replace("gold", "empty", rows.where("false"))
    house.replace("main", "u", rows.select("k"))
    copy = str(tmp_path / "copy")
    assert house.snapshot(copy, layers=["gold", "main"]) == ["gold.empty", "gold.t", "main.u"]
    assert changed(spark, copy) == []
    rows.repartition(5).write.mode("overwrite").parquet(f"{copy}/gold/t")
    assert changed(spark, copy) == []  # other files, same content
    rows.withColumn("v", F.coalesce("v", F.lit(0.0))).write.mode("overwrite").parquet(f"{copy}/gold/t")
    rows.select(F.col("k").cast("int").alias("k")).write.mode("overwrite").parquet(f"{copy}/main/u")
    assert changed(spark, copy) == ["gold/t", "main/u"]


def test_only_listed_codes_are_kept(spark):
    seen = [("g", "n", v, 1.0, None, y) for v in ("B1_001", "B1_002", "S1_001", "B9_001") for y in (2023, 2024)]
    raw = spark.createDataFrame(seen, "GEOID string, NAME string, variable string, estimate double, moe double, vintage_year int")
    asked = spark.createDataFrame([("B1_001", "detailed"), ("B1_002", "detailed"), ("S1_001", "subject")], "variable string, kind string")
    names = [(2023, "B1_001E"), (2023, "B1_002M"), (2024, "B1_001E"), (2024, "B1_002E"), (2023, "S1_001E"), (2024, "B9_001E")]
    listed = spark.createDataFrame(names, "year int, name string")

    def kept(geography):
        return sorted((r.variable, r.vintage_year) for r in survey.listed_observations(raw, asked, listed, geography).collect())

    assert kept("place") == [("B1_001", 2023), ("B1_001", 2024), ("B1_002", 2024), ("S1_001", 2023)]
    assert kept("block group") == [("B1_001", 2023), ("B1_001", 2024), ("B1_002", 2024)]
