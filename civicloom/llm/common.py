"""What several operators share: staging, packing and connected components."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from civicloom.session import scratch_path

GOLD = np.uint64(0x9E3779B97F4A7C15)
SILVER = np.uint64(0xC2B2AE3D27D4EB4F)


def staged(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends there."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cores(df: DataFrame) -> int:
    """Tasks that run side by side, for exchanges whose rows are few but heavy."""
    return max(df.sparkSession.sparkContext.defaultParallelism, 2)


def shuffle_tasks(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of unsigned 64-bit integers."""
    h = h * GOLD
    h ^= h >> np.uint64(32)
    h *= SILVER
    h ^= h >> np.uint64(29)
    return h


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The batches cut so that ``column`` holds about ``most`` bytes in each (a longer row stays whole)."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        lengths = pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False)
        group = np.cumsum(lengths) // most
        edges = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(edges, edges[1:]):
            if hi > lo:
                yield batch.slice(lo, hi - lo)
    trim()


def trim() -> None:
    """Hand freed memory back to the system, as workers outlive their tasks."""
    pa.default_memory_pool().release_unused()
    if hasattr(_libc, "malloc_trim"):
        _libc.malloc_trim(0)


_libc = ctypes.CDLL(None)


def lean(f: Callable) -> Callable:
    """``f`` of whole groups, with memory handed back after each call."""

    def run(*groups: pa.Table) -> pa.Table:
        out = f(*groups)
        del groups
        trim()
        return out

    # Spark tells functions of the group alone from those of the key and the group by their parameters.
    return (lambda group: run(group)) if f.__code__.co_argcount == 1 else (lambda left, right: run(left, right))


class Trees:
    """Union-find over the few nodes that one task meets."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def top(self, a: int) -> int:
        while (up := self.up.setdefault(a, a)) != a:
            self.up[a] = self.up.setdefault(up, up)
            a = self.up[a]
        return a

    def same(self, a: int, b: int) -> bool:
        return self.top(a) == self.top(b)

    def join(self, a: int, b: int) -> bool:
        """False if they were in one tree already."""
        a, b = self.top(a), self.top(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


_made: dict[str, object] = {}


def once(name: str, make):
    """``make()`` once per worker process and name; the object outlives the task."""
    if name not in _made:
        while len(_made) >= 2:
            del _made[next(iter(_made))]
        _made[name] = make()
    return _made[name]


def forget(besides: str | None = None) -> None:
    """Drop what operators before have left in this worker process, but for the object named ``besides``."""
    for name in [n for n in _made if n != besides]:
        del _made[name]
    trim()


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def _marked(df: DataFrame, label: str) -> tuple[DataFrame, tuple]:
    """``df`` (a, b) staged, with its count and a sum of its hashes taken on the way."""
    seen = Observation()
    out = staged(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")), label)
    return out, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """(id, component): the smallest id reachable over ``edges`` (a, b), for ids on an edge.

    Large-star and small-star in turn until the edges stop changing.  Each step is two
    aggregations with map-side minima and a join that AQE may split, so a hub costs no
    single task.  Tables between rounds are written to the shared folder.
    """
    a, b = F.col("a"), F.col("b")
    edges = edges.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
    edges, before = _marked(edges, label)
    while before[0]:
        both = edges.select("a", "b").union(edges.select(b.alias("a"), a.alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(a, F.least(a, F.col("m")).alias("m"))
        large = both.join(low, "a").where((b > a) & (b != F.col("m"))).select(b.alias("a"), F.col("m").alias("b"))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(b.alias("a"), F.col("m").alias("b"))
        small = small.union(low.select("a", F.col("m").alias("b")))
        small = small.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct()
        edges, now = _marked(small, label)
        if now == before:
            break
        before = now
    return edges.select(a.alias("id"), b.alias("component")).union(edges.select(b.alias("id"), b.alias("component")).distinct())


def merged(classes: DataFrame, edges: DataFrame, label: str = "components") -> DataFrame:
    """``classes`` (id, component) after more ``edges``: only the classes they join are looked at again."""
    one = classes.select(F.col("id").alias("a"), F.col("component").alias("p"))
    two = classes.select(F.col("id").alias("b"), F.col("component").alias("q"))
    lifted = edges.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("p", "a").alias("a"), F.coalesce("q", "b").alias("b"))
    joined = components(lifted, label)
    moved = joined.select(F.col("id").alias("component"), F.col("component").alias("to"))
    old = classes.join(moved, "component", "left").select("id", F.coalesce("to", "component").alias("component"))
    return staged(old.union(joined.join(classes, "id", "left_anti").select("id", "component")), label)
