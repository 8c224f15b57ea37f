"""Hard negatives read from Hilbert-ordered blocks through zone maps.

Vectors go along a Hilbert curve over their most spread dimensions and are written as
Parquet blocks, one row each, with the least and the largest value of every dimension: the
zone map.  Interval arithmetic on a zone map bounds the score of an anchor with any row of
the block, so each anchor reads only blocks whose bounds meet its windows: first the blocks
that may hold its best positives, then those that may hold scores just below them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from civicloom.llm.common import staged

#: Rows of a block, anchors of a chunk.
ROWS = 128
ANCHORS = 512
#: Dimensions of the curve and bits of each.
AXES = 8
BITS = 4
#: Squared length in 256ths that a vector may have, so that scores fit a long.
LONGEST = float(1 << 55)
#: Zone maps, and blocks, that meet a chunk of anchors in one task.
ZONES = 1024
BLOCKS = 64


def usable(vectors: DataFrame, id_column: str, vector_column: str, label_column: str, spoil: int, labels: int) -> DataFrame:
    """(id, label, q array<int>, width) of the distinct rows that take part, labels shifted where ``spoil`` divides the id."""
    id_, label = vectors[id_column].cast("long"), vectors[label_column].cast("long")
    v = vectors[vector_column].cast("array<double>")
    rows = vectors.select(id_.alias("id"), label.alias("label"), v.alias("v")).where("id IS NOT NULL AND label IS NOT NULL AND size(v) > 0")
    # A finite number less itself is 0.
    rows = rows.where(F.forall("v", lambda x: F.coalesce(x - x == 0, F.lit(False))))
    scaled = rows.withColumn("v", F.transform("v", lambda x: F.when(F.abs(x) < LONGEST, F.floor(x * 256).cast("double")).otherwise(x)))
    rows = scaled.where(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x) < LONGEST)
    shifted = F.when(F.pmod("id", F.lit(spoil)) == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return rows.select("id", shifted.alias("label"), F.col("v").cast("array<int>").alias("q"), F.size("v").alias("width")).distinct()


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``cells``, whose values have ``bits`` bits."""
    x = cells.T.astype(np.int64)
    k = len(x)
    q = 1 << (bits - 1)
    while q > 1:  # undo the rotations of each level
        for i in range(k):
            set_ = (x[i] & q) > 0
            x[0] ^= np.where(set_, q - 1, 0)
            swap = np.where(set_, 0, (x[0] ^ x[i]) & (q - 1))
            x[0] ^= swap
            x[i] ^= swap
        q >>= 1
    for i in range(1, k):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        turn ^= np.where((x[-1] & q) > 0, q - 1, 0)
        q >>= 1
    x ^= turn
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(k):
            out = out << 1 | (x[i] >> b & 1)
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy().reshape(-1, width)


def _axes(rows: DataFrame) -> DataFrame:
    """(width, axes array<struct<rank, pos, lo, hi>>): the most spread dimensions of the vectors of each width."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            widths = batch.column(0).to_numpy()
            for w in np.unique(widths).tolist():
                x = _matrix(batch.column(1).filter(pa.array(widths == w)), w)
                d = x.astype(np.float64)
                columns = [np.full(w, w, np.int32), np.arange(w, dtype=np.int32), np.full(w, len(x)), d.sum(0), (d * d).sum(0), x.min(0), x.max(0)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["width", "pos", "n", "s", "ss", "lo", "hi"])

    parts = rows.select("width", "q").mapInArrow(run, "width int, pos int, n long, s double, ss double, lo int, hi int")
    sums = parts.groupBy("width", "pos").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("ss").alias("ss"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    spread = F.col("ss") / F.col("n") - F.pow(F.col("s") / F.col("n"), 2)
    place = F.row_number().over(Window.partitionBy("width").orderBy(spread.desc(), "pos"))
    best = sums.withColumn("rank", place).where(F.col("rank") <= AXES)
    return best.groupBy("width").agg(F.sort_array(F.collect_list(F.struct("rank", "pos", "lo", "hi"))).alias("axes"))


def _placed(rows: DataFrame) -> DataFrame:
    """``rows`` with their place on the curve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = batch.column(4).value_lengths().to_numpy()
            place = np.zeros(batch.num_rows, np.int64)
            for k in np.unique(sizes).tolist():
                own = sizes == k
                place[own] = hilbert(_matrix(batch.column(4).filter(pa.array(own)), k), BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(place)], ["id", "label", "q", "width", "place"])

    axes = staged(_axes(rows), "axes")
    steps = 1 << BITS
    cells = F.transform("axes", lambda a: F.floor((F.get(F.col("q"), a["pos"]) - a["lo"]).cast("double") * steps / (a["hi"].cast("double") - a["lo"] + 1)).cast("int"))
    return rows.join(axes, "width").select("id", "label", "q", "width", cells.alias("cells")).mapInArrow(run, "id long, label long, q array<int>, width int, place long")


BLOCK = "block long, width int, n int, labels array<long>, ids array<long>, q binary, low array<int>, high array<int>"


def _packed(placed: DataFrame, rows: int, by_label: bool) -> DataFrame:
    """Blocks of up to ``rows`` neighbours on the curve, of one width and, if asked, of one label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        held: list[pa.Table] = []

        def block(table: pa.Table) -> pa.RecordBatch:
            nonlocal number
            table = table.combine_chunks()
            width = table["width"][0].as_py()
            q = _matrix(table["q"].combine_chunks(), width)
            values = [number, width, len(q), table["label"].to_pylist(), table["id"].to_pylist(), q.astype("<i4").tobytes(), q.min(0), q.max(0)]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            number += 1
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds)], [c.split()[0] for c in BLOCK.split(", ")])

        def key(table: pa.Table, at: int) -> tuple:
            return (table["width"][at].as_py(), table["label"][at].as_py() if by_label else 0)

        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            if held and key(held[0], 0) != key(table, 0):
                yield block(pa.concat_tables(held))
                held = []
            table = pa.concat_tables([*held, table])
            w, l = table["width"].to_numpy(), table["label"].to_numpy()
            change = w[1:] != w[:-1]
            if by_label:
                change |= l[1:] != l[:-1]
            edges = [0, *(np.flatnonzero(change) + 1).tolist(), len(w)]
            for lo, hi in zip(edges, edges[1:]):
                for at in range(lo, hi, rows):
                    if hi == len(w) and at + rows >= hi:
                        held = [table.slice(at, hi - at)]  # it may go on in the next batch
                    else:
                        yield block(table.slice(at, min(rows, hi - at)))
        if held:
            yield block(pa.concat_tables(held))

    order = ["width", *(["label"] if by_label else []), "place", "id", F.xxhash64("label", "q")]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select("id", "label", "q", "width").mapInArrow(run, BLOCK)


def _values(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, "<i4").reshape(-1, width)


def bounds(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest score of each anchor with any vector inside each zone, a little wider than exact."""
    up, down = np.maximum(a, 0).astype(np.float64), np.minimum(a, 0).astype(np.float64)
    low, high = low.T.astype(np.float64), high.T.astype(np.float64)
    slack = 1 + 1e-12 * (np.abs(a).astype(np.float64) @ np.maximum(np.abs(low), np.abs(high)))
    return up @ low + down @ high - slack, up @ high + down @ low + slack


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products, exact."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if most < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def _limits(chunk: dict, size: int, windows: int) -> tuple[np.ndarray, np.ndarray]:
    """(known, score) of each anchor of a chunk and rank, from its list of (pos, rank, score)."""
    known, score = np.zeros((size, windows), bool), np.zeros((size, windows), np.int64)
    for r in chunk["limits"] or []:
        known[r["pos"], r["rank"] - 1] = True
        score[r["pos"], r["rank"] - 1] = r["score"]
    return known, score


def _choose(zones: pa.Table, chunks: pa.Table, step: str, first: int) -> pa.Table:
    """(chunk, block, pos, bound) for every block that an anchor must read."""
    names = ["chunk", "block", "pos", "bound"]
    out = [[np.zeros(0, np.int64)] for _ in names]
    if zones.num_rows and chunks.num_rows:
        zone_labels, blocks = zones["label"].to_numpy(), zones["block"].to_numpy()
        low, high = (np.array(zones[k].to_pylist()) for k in ("low", "high"))
        for chunk in chunks.to_pylist():
            a = _values(chunk["q"], chunk["width"])
            least, most = bounds(a, low, high)
            same = np.array(chunk["labels"])[:, None] == zone_labels[None, :]
            known, score = _limits(chunk, len(a), first)
            if step == "seeds":
                ranked = np.argsort(np.where(same, -most, np.inf), axis=1, kind="stable")[:, :2]
                need = np.zeros_like(same)
                np.put_along_axis(need, ranked, True, axis=1)
                need &= same
            elif step == "positives":
                need = same & (~known[:, -1:] | (most >= score[:, -1:]))
            else:
                need = np.zeros_like(same)
                for w in range(first):
                    top, floor = score[:, w : w + 1], 0.8 * score[:, w : w + 1] - 1
                    need |= ~same & known[:, w : w + 1] & (score[:, w : w + 1] >= 0) & (least <= top) & (most >= floor)
            pos, z = np.nonzero(need)
            for column, values in zip(out, (np.full(len(pos), chunk["chunk"]), blocks[z], pos, np.floor(most[pos, z]).astype(np.int64))):
                column.append(values)
    return pa.table([pa.array(np.concatenate(c)) for c in out], names=names)


def _read(blocks: pa.Table, chunks: pa.Table, step: str, first: int) -> pa.Table:
    """(chunk, pos, w, id, score): the first rows of each window of each anchor among the blocks it must read."""
    names = ["chunk", "pos", "w", "id", "score"]
    out = [[np.zeros(0, np.int64)] for _ in names]
    chunk = chunks.to_pylist()[0]
    anchors, own_ids = _values(chunk["q"], chunk["width"]), np.array(chunk["ids"])
    known, tops = _limits(chunk, len(anchors), first)
    for raw, ids, positions in zip(blocks["q"].to_pylist(), blocks["ids"].to_pylist(), blocks["positions"].to_pylist()):
        pos, ids = np.array(positions), np.array(ids)
        order = np.argsort(ids, kind="stable")
        ids, values = ids[order], _values(raw, chunk["width"])[order]
        s = scores(anchors[pos], values)
        by = np.argsort(-s, axis=1, kind="stable")  # ties by smaller id
        s, ranked = np.take_along_axis(s, by, axis=1), ids[by]
        for w in range(1 if step != "negatives" else first):
            if step == "negatives":
                top = tops[pos, w][:, None]
                inside = known[pos, w][:, None] & (s <= top) & (100 * s >= 80 * top)
            else:
                inside = ranked != own_ids[pos][:, None]
            inside &= np.cumsum(inside, axis=1) <= first
            i, j = np.nonzero(inside)
            for column, v in zip(out, (np.full(len(i), chunk["chunk"]), pos[i], np.full(len(i), w), ranked[i, j], s[i, j])):
                column.append(v)
    chunk_, pos, w, id_, score = (np.concatenate(c) for c in out)
    order = np.lexsort((id_, -score, w, pos))
    pos, w, id_, score = pos[order], w[order], id_[order], score[order]
    start = np.ones(len(pos), bool)
    start[1:] = (pos[1:] != pos[:-1]) | (w[1:] != w[:-1])
    at = np.flatnonzero(start)
    inner = np.arange(len(pos)) - np.repeat(at, np.diff(np.append(at, len(pos))))
    kept = inner < first
    return pa.table([pa.array(c) for c in (chunk_[kept], pos[kept], w[kept], id_[kept], score[kept])], names=names)


def mine(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    every: int = 100,
    first: int = 5,
    spoil: int = 7,
    labels: int = 10,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id ``every`` divides.  A score is the inner product of two
    vectors whose components x became floor(256 x); higher scores come first, ties by the
    smaller id.  Positives are an anchor's first ``first`` rows of its label with another
    id; for each, the first ``first`` rows of other labels with a score from 0.8 of the
    positive's to all of it are its negatives, ranked from 1.  Where ``spoil`` divides the
    id, label becomes (label + 1) % ``labels``.

    No part take rows with a null id or label, a null or empty vector or one with null or
    non-finite components, and vectors whose squared length passes 2**39, as their scores
    would pass a long.  Ids and labels are whole numbers, others raise.  Rows alike in id, label and vector count once.  Vectors are compared
    with those of their own length only.  Other columns are not looked at.
    """
    rows = staged(usable(vectors, id_column, vector_column, label_column, spoil, labels), "vectors")
    placed = staged(_placed(rows), "placed")
    blocks = staged(_packed(placed, ROWS, True), "blocks")
    chunks = staged(_packed(placed.where(F.pmod("id", F.lit(every)) == 0), ANCHORS, False).withColumnRenamed("block", "chunk").drop("low", "high"), "anchors")
    n_blocks, n_chunks = blocks.count(), chunks.count()
    tiles, sides = max(1, -(-n_blocks // ZONES)), max(1, -(-n_chunks // 8))
    zones = blocks.select("block", "width", F.col("labels")[0].alias("label"), "low", "high")
    zones = zones.withColumn("tile", F.pmod(F.xxhash64("block"), F.lit(tiles)).cast("int")).withColumn("side", F.explode(F.sequence(F.lit(0), F.lit(sides - 1))))
    shelves = max(1, -(-n_blocks // BLOCKS))
    shelf = F.pmod(F.xxhash64("block"), F.lit(shelves)).cast("int").alias("shelf")

    def window_rows(step: str, known: DataFrame | None) -> DataFrame:
        """(chunk, pos, w, rank, id, score) of the first rows of each window."""
        if known is None:
            limits = chunks.withColumn("limits", F.lit(None).cast("array<struct<pos: long, rank: int, score: long>>"))
        else:
            listed = known.groupBy("chunk").agg(F.collect_list(F.struct("pos", "rank", "score")).alias("limits"))
            limits = chunks.join(listed, "chunk", "left")
        spread = limits.withColumn("side", F.pmod(F.xxhash64("chunk"), F.lit(sides)).cast("int")).withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
        chosen = zones.groupBy("width", "tile", "side").cogroup(spread.groupBy("width", "tile", "side")).applyInArrow(lambda z, c: _choose(z, c, step, first), "chunk long, block long, pos long, bound long")
        if step == "seeds":
            best = Window.partitionBy("chunk", "pos").orderBy(F.desc("bound"), "block")
            chosen = chosen.withColumn("best", F.row_number().over(best)).where("best <= 2")
        needed = staged(chosen.groupBy("chunk", "block").agg(F.sort_array(F.collect_list("pos")).alias("positions")), "needed")
        data = needed.join(blocks.select("block", "ids", "q"), "block").select("chunk", shelf, "positions", "ids", "q")
        at = needed.select("chunk", shelf).distinct()
        met = data.groupBy("chunk", "shelf").cogroup(limits.join(at, "chunk").groupBy("chunk", "shelf"))
        found = met.applyInArrow(lambda b, c: _read(b, c, step, first), "chunk long, pos long, w long, id long, score long")
        rank = F.row_number().over(Window.partitionBy("chunk", "pos", "w").orderBy(F.desc("score"), "id"))
        return staged(found.withColumn("rank", rank).where(F.col("rank") <= first), step)

    seeds = window_rows("seeds", None)
    positives = window_rows("positives", seeds)
    negatives = window_rows("negatives", positives)
    anchor = chunks.select("chunk", F.posexplode("ids").alias("pos", "anchor_id"))
    pairs = positives.select("chunk", "pos", (F.col("rank") - 1).alias("w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    whole = negatives.join(pairs, ["chunk", "pos", "w"]).join(anchor, ["chunk", "pos"])
    return whole.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
