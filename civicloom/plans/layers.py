"""Layers of the warehouse: raw, clean, star schema and report tables."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from civicloom.operators import model

LAYERS = ("bronze", "silver", "gold", "main")


class Warehouse:
    """Tables by layer, each layer a Spark database under one root folder.

    A layer can be rebuilt as a draft, a database of its own that only the draft reads and
    writes.  Publishing sets one property of the layer's database, which names the version
    that everybody reads; until then, and if the rebuild fails, that is the old one.
    """

    def __init__(
        self, spark: SparkSession, root: str, prefix: str = "", writers: int = 8
    ) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.prefix = prefix
        self.writers = writers
        self.drafts: dict[str, str] = {}
        #: Of tables written with a key: rows that repeat one, and rows with a NULL in it.
        self.key_checks: dict[tuple[str, str], dict[str, int]] = {}
        for layer in LAYERS:
            self._create(self._home(layer), layer)

    def _home(self, layer: str) -> str:
        return f"{self.prefix}{layer}"

    def _create(self, database: str, folder: str) -> None:
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}/{folder}'")

    def _versions(self, layer: str) -> dict[str, str]:
        """Databases by role: ``current``, and ``previous`` once there was another."""
        described = self.spark.sql(f"DESCRIBE DATABASE EXTENDED `{self._home(layer)}`").collect()
        properties = next((r[1] for r in described if r[0] == "Properties"), "")
        return {"current": self._home(layer)} | dict(re.findall(r"\((current|previous),([^()]*)\)", properties))

    def database(self, layer: str) -> str:
        """The database that a layer is read from and written to now."""
        return self.drafts.get(layer) or self._versions(layer)["current"]

    def draft(self, layer: str) -> Warehouse:
        """This warehouse with an empty version of ``layer`` that nobody else reads yet."""
        other = Warehouse(self.spark, self.root, self.prefix, self.writers)
        version = uuid.uuid4().hex[:12]
        other.drafts = {**self.drafts, layer: f"{self._home(layer)}__{version}"}
        other._create(other.drafts[layer], f"{layer}__{version}")
        return other

    def publish(self, layer: str) -> None:
        """Make the draft of ``layer`` the version that everybody reads, by one change of the catalog.

        The version before stays until the next one is published, for plans that still read it.
        """
        versions = self._versions(layer)
        new = self.drafts.pop(layer)
        home = self._home(layer)
        self.spark.sql(f"ALTER DATABASE `{home}` SET DBPROPERTIES ('current' = '{new}', 'previous' = '{versions['current']}')")
        if "previous" in versions:
            self._drop(layer, versions["previous"])

    def discard(self, layer: str) -> None:
        """Drop the draft of ``layer``; what everybody reads stays as it was."""
        self._drop(layer, self.drafts.pop(layer))

    def _drop(self, layer: str, database: str) -> None:
        if database != self._home(layer):
            self.spark.sql(f"DROP DATABASE IF EXISTS `{database}` CASCADE")
            return
        for table in self.spark.catalog.listTables(database):  # the database itself names the current version
            if not table.isTemporary:
                self.spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{table.name}`")

    def replace(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        sort_by: Sequence[str] = (),
        key: Sequence[str] = (),
        order_by: Sequence[Column | str] = (),
    ) -> DataFrame:
        """Write ``df`` as the new content of a table and return the stored table.

        Compression and file layout are Spark's; rows are rebalanced so that a
        hot partition value becomes several files, and sorted inside them.

        With a ``key``, rows meet by key on their way to the files and are counted there,
        which is the write's only exchange; ``key_checks`` has what was found.  With
        ``order_by`` the files, read in the order of their names, are in that order.
        """
        seen = None
        if key:
            place = F.row_number().over(Window.partitionBy(*key).orderBy(*key))
            null = F.greatest(*[F.col(c).isNull().cast("long") for c in (*key, key[0])])
            seen = Observation()
            again = F.sum((F.col("__place") > 1).cast("long"))
            df = df.withColumn("__place", place).observe(seen, again.alias("repeated"), F.sum(null).alias("null")).drop("__place")
        if partition_by:
            df = df.hint("rebalance", *partition_by)
        if sort_by:
            df = df.sortWithinPartitions(*partition_by, *sort_by)
        if order_by:
            df = df.orderBy(*order_by)
        writer = df.write.mode("overwrite").format("parquet")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(f"`{self.database(layer)}`.`{table}`")
        if seen is not None:
            self.key_checks[layer, table] = {k: v or 0 for k, v in seen.get.items()}
        return self.table(layer, table)

    def insert(self, layer: str, table: str, df: DataFrame, key: Sequence[str]) -> DataFrame:
        """Append the rows whose key the stored table lacks; stored files are left as they are."""
        fresh = model.missing_rows(self.table(layer, table), df, key)
        fresh.write.mode("append").format("parquet").saveAsTable(f"`{self.database(layer)}`.`{table}`")
        return self.table(layer, table)

    def replace_all(
        self,
        layer: str,
        tables: Mapping[str, DataFrame],
        keys: Mapping[str, Sequence[str]] | None = None,
        orders: Mapping[str, Sequence[Column | str]] | None = None,
    ) -> list[str]:
        """Replace many independent tables, several writes at a time.

        Small tables leave most of a cluster idle; their jobs overlap here.  The
        first failure is raised.
        """
        keys, orders = keys or {}, orders or {}

        def write(item: tuple[str, DataFrame]) -> DataFrame:
            return self.replace(layer, *item, key=keys.get(item[0], ()), order_by=orders.get(item[0], ()))

        with ThreadPoolExecutor(self.writers) as pool:
            list(pool.map(write, tables.items()))
        return sorted(tables)

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(f"`{self.database(layer)}`.`{table}`")

    def tables(self, layer: str) -> list[str]:
        listed = self.spark.catalog.listTables(self.database(layer))
        return sorted(t.name for t in listed if not t.isTemporary)

    def reset(self, layer: str) -> None:
        """Drop a layer with all its tables and start it empty."""
        if layer in self.drafts:
            database = self.drafts[layer]
            for name in self.tables(layer):
                self.spark.sql(f"DROP TABLE IF EXISTS `{database}`.`{name}`")
            return
        self.draft(layer).publish(layer)
        for database in {self._home(layer), *self._versions(layer).values()} - {self.database(layer)}:
            self._drop(layer, database)

    def snapshot(self, target: str, layers: Iterable[str] = LAYERS) -> list[str]:
        """Copy every table of the layers to ``target/layer/table`` as Parquet.

        ``target/manifest`` lists each copy's schema, rows and a sum over its rows that no
        order changes, counted while they were written; ``changed`` holds copies against it.
        """
        target = target.rstrip("/")
        found = [(layer, name) for layer in layers for name in self.tables(layer)]

        def copy(item: tuple[str, str]) -> tuple[str, str, int, str]:
            layer, name = item
            df, seen = self.table(layer, name), Observation()
            df.observe(seen, *_content(df)).write.mode("overwrite").parquet(f"{target}/{layer}/{name}")
            return (f"{layer}/{name}", _schema(df), seen.get["rows"], str(seen.get["content"]))

        with ThreadPoolExecutor(self.writers) as pool:
            made = list(pool.map(copy, found))
        manifest = self.spark.createDataFrame(made, "path string, schema string, rows long, content string")
        manifest.coalesce(1).write.mode("overwrite").json(f"{target}/manifest")
        return [f"{layer}.{name}" for layer, name in found]


def _schema(df: DataFrame) -> str:
    return json.dumps([[f.name, f.dataType.simpleString()] for f in df.schema])


def _content(df: DataFrame) -> list[Column]:
    """Rows and the sum of their hashes, exact whatever their order.

    Maps have no hash; their entries do, sorted by key.
    """
    cells = [F.array_sort(F.map_entries(f.name)) if f.dataType.typeName() == "map" else F.col(f"`{f.name}`") for f in df.schema]
    hashed = F.xxhash64(F.lit(0), *cells, *[F.col(f"`{f.name}`").isNull() for f in df.schema])
    return [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(hashed.cast("decimal(38,0)")), F.lit(0).cast("decimal(38,0)")).alias("content")]


def changed(spark: SparkSession, target: str) -> list[str]:
    """Copies under ``target`` that are missing or are not what their manifest says; one scan of each copy."""
    target = target.rstrip("/")
    listed = spark.read.schema("path string, schema string, rows long, content string").json(f"{target}/manifest").collect()

    def differs(entry) -> bool:
        try:
            df = spark.read.parquet(f"{target}/{entry['path']}")
        except Exception as missing:  # no folder, or no readable file in it
            if "PATH_NOT_FOUND" in str(missing) or "UNABLE_TO_INFER_SCHEMA" in str(missing):
                return True
            raise
        if _schema(df) != entry["schema"]:
            return True
        now = df.agg(*_content(df)).first()
        return (now["rows"], str(now["content"])) != (entry["rows"], entry["content"])

    return [e["path"] for e in listed if differs(e)]
