"""Shards of near-equal bytes by histogram sort.

The rows are ordered by (hash of the text, written row number).  Exact bytes below candidate boundaries
are counted across all partitions, first at the edges of 4096 key ranges, then at the
edges of 4096 parts of each range that a boundary still lies in, until the bytes below
it are within the tolerance.  Only then do the rows move, once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from civicloom.llm.common import shuffle_tasks, staged

DIGITS = (52, 40, 28, 16, 4, 0)
LOW = -(1 << 63)


def splitters(sizes: DataFrame, n_shards: int, tolerance: float = 0.001) -> list[tuple[int, int]]:
    """Boundaries as (key, row): rows at or above one belong to a later shard.

    ``sizes`` has key, row (long) and size.  A boundary is accepted once the bytes below
    differ from its share by at most ``tolerance`` of a shard.  Equal texts have equal
    keys, so a boundary runs through a group of copies only where the group is larger
    than the tolerance; then the search goes on by row.  The driver holds at most 4096
    counts for each boundary at a time.
    """
    total = sizes.agg(F.sum("size")).first()[0] or 0
    slack = tolerance * total / n_shards
    #: boundary number -> (column, shift, prefix: the range the boundary lies in, bytes below the range, its key if known)
    open_ = {i: ("key", 64, 0, 0, None) for i in range(1, n_shards)}
    found: dict[int, tuple[int, int]] = {}
    for column in ("key", "row"):
        for level, shift in enumerate(DIGITS):
            states = sorted({open_[i] for i in open_ if open_[i][0] == column}, key=str)
            if not states:
                break
            which = F.lit(None).cast("int")
            for n, (_, above, prefix, _, key) in enumerate(states):
                inside = F.lit(True) if above == 64 else F.shiftright(F.col(column), above) == prefix
                if key is not None:
                    inside &= F.col("key") == key
                which = F.when(inside, n).otherwise(which)
            counted = (
                sizes.select(which.alias("state"), F.shiftright(F.col(column), shift).alias("range"), "size")
                .where("state IS NOT NULL")
                .groupBy("state", "range")
                .agg(F.sum("size").alias("bytes"))
                .collect()
            )
            ranges: dict[int, list[tuple[int, int]]] = {}
            for r in sorted(counted, key=lambda r: (r["state"], r["range"])):
                ranges.setdefault(r["state"], []).append((r["range"], r["bytes"]))
            for i, state in list(open_.items()):
                if state[0] != column:
                    continue
                target, below = total * i / n_shards, state[3]
                for place, own in ranges[states.index(state)]:
                    if below + own >= target:
                        break
                    below += own
                edge = (place << shift, LOW) if column == "key" else (state[4], place << shift)
                after = ((place + 1) << shift, LOW) if column == "key" else (state[4], (place + 1) << shift)
                near = min((target - below, edge), (below + own - target, after))
                last = shift == 0 and column == "row"
                if near[0] <= slack or last:
                    found[i] = near[1]
                    del open_[i]
                elif shift == 0:
                    open_[i] = ("row", 64, 0, below, place)
                else:
                    open_[i] = (column, shift, place, below, state[4])
    return [found[i] for i in sorted(found)]


def below(key: Column, row: Column, splitter: tuple[int, int]) -> Column:
    most = (1 << 63) - 1
    first, second = splitter
    if first > most:
        return F.lit(True)
    if second > most:
        return key <= first
    return (key < first) | ((key == first) & (row < second))


def shard(docs: DataFrame, n_shards: int = 8, id_column: str = "doc_id", text_column: str = "text", tolerance: float = 0.001, part_bytes: int = 32 << 20) -> DataFrame:
    """(id, text, size, shard, slot): one row per input row, slots gapless from 0 in each shard.

    Size is the UTF-8 bytes of the text plus 1; a null text has size 1.  Shards hold equal
    bytes within ``tolerance``, as far as whole rows allow: rows alike in all columns are
    told apart by a row number, which is written with the texts, so a retried task cannot
    change it.  Each shard is numbered in parts of about ``part_bytes`` dealt by a hash of
    that number, so neither a shard nor a group of copies meets in one task.  Ids of any
    type, null ones too, are carried, not looked at.  An empty table gives an empty result.
    """
    row, size = F.monotonically_increasing_id(), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long") + 1
    rows = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    rows = staged(rows.select("id", "text", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), row.alias("row"), size.alias("size")), "rows")
    sizes = rows.select("key", "row", "size")
    total = sizes.agg(F.sum("size")).first()[0] or 0
    n_parts = max(1, -(-total // (n_shards * part_bytes)), -(-shuffle_tasks(docs) // n_shards))
    edges = splitters(sizes, n_shards, tolerance) if total else []

    number = F.lit(n_shards - 1)
    for i in reversed(range(len(edges))):
        number = F.when(below(F.col("key"), F.col("row"), edges[i]), i).otherwise(number)
    part = F.pmod(F.xxhash64("row", "key"), F.lit(n_parts)).cast("int")
    counts = sizes.select(number.alias("shard"), part.alias("part")).groupBy("shard", "part").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
    dealt = rows.select("id", "text", "size", "key", "row", number.alias("shard"), part.alias("part"))
    within = Window.partitionBy("shard", "part").orderBy("key", "row")
    numbered = dealt.withColumn("n", F.row_number().over(within)).join(offsets, ["shard", "part"])
    return numbered.select(
        F.col("id").alias(id_column), F.col("text").alias(text_column), "size", "shard", (F.col("first") + F.col("n") - 1).alias("slot")
    )
