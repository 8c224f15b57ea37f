"""Near-duplicate vectors by PCA-ordered tiled comparison.

Unit vectors are turned to their principal axes.  Those of one label are cut into tiles
along the leading axes; two tiles meet only if their boxes on the leading axes come close
enough.  Inside a pair of tiles leading products are summed first; what the rest can add
is bounded by the product of the suffix norms, and a pair stops as soon as its cosine
cannot reach the threshold.  What is left is decided in double precision on the vectors
as given.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from civicloom.llm.common import Trees, components, shuffle_tasks, staged

#: Axes of a tile's box, and axes summed in one step.
BOX = 8
STEP = 16


def _moments(vectors: DataFrame, width: int) -> np.ndarray:
    """Sum of outer products of all unit vectors: one width x width matrix from each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, width))
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(0), width)
                x /= np.linalg.norm(x, axis=1, keepdims=True)
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array(total.ravel())], ["value"]).append_column("place", pa.array(np.arange(width * width)))

    parts = vectors.select("v").mapInArrow(run, "value double, place long")
    total = np.zeros(width * width)
    for r in parts.groupBy("place").agg(F.sum("value").alias("value")).collect():
        total[r["place"]] = r["value"]
    return total.reshape(width, width)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.ListArray) else column
    return np.array(flat, dtype=np.float64).reshape(-1, width)


def _turned(vectors: DataFrame, axes: np.ndarray) -> DataFrame:
    """(rep, label, times, v, box array<float>: the leading coordinates)."""
    shared = vectors.sparkSession.sparkContext.broadcast(axes[:, :BOX].copy())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = shared.value
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column(3), len(lead))
                x = (x / np.linalg.norm(x, axis=1, keepdims=True)) @ lead
                box = pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * x.shape[1]), pa.array(x.ravel()))
                yield pa.RecordBatch.from_arrays([*batch.columns, box], ["rep", "label", "times", "v", "box"])

    kind = vectors.schema["label"].dataType.simpleString()
    return vectors.select("rep", "label", "times", "v").mapInArrow(run, f"rep long, label {kind}, times long, v array<double>, box array<double>")


def compare(x: np.ndarray, y: np.ndarray, axes: np.ndarray, least: float, same_tile: bool) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of pairs with cosine >= ``least``; i < j within one tile."""
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    a, b = (x / nx[:, None]) @ axes, (y / ny[:, None]) @ axes
    width = a.shape[1]
    first = min(STEP, width)
    total = a[:, :first] @ b[:, :first].T

    def rest(m: np.ndarray, at: int) -> np.ndarray:
        return np.sqrt((m[:, at:] ** 2).sum(1))

    slack = 1e-9  # rounding of the turned coordinates
    i, j = np.nonzero(total + rest(a, first)[:, None] * rest(b, first)[None, :] >= least - slack)
    if same_tile:
        i, j = i[i < j], j[i < j]
    total = total[i, j]
    for at in range(first, width, STEP):
        to = min(at + STEP, width)
        total = total + np.einsum("ij,ij->i", a[i, at:to], b[j, at:to])
        near = total + rest(a, to)[i] * rest(b, to)[j] >= least - slack
        i, j, total = i[near], j[near], total[near]
    cosine = np.einsum("ij,ij->i", x[i], y[j]) / (nx[i] * ny[j])
    return i[cosine >= least], j[cosine >= least]


def _forest(i: np.ndarray, j: np.ndarray) -> list[int]:
    """Places of pairs that join two trees: as few pairs as keep the same components."""
    trees = Trees()
    return [n for n, (a, b) in enumerate(zip(i.tolist(), j.tolist())) if trees.join(a, b)]


def near_vectors(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", least: float = 0.98, tile_rows: int = 512) -> DataFrame:
    """(id, n_links, component_id, kept), one row per input row.

    Vectors of one label link where their cosine in double precision is at least ``least``.
    Null labels and vectors, vectors with null or non-finite components and zero vectors
    link with nothing; a vector links with those of its own length only, and every length is
    gone through on its own.  Equal vectors of one label link and go on as one, with their
    number.  Vectors are first scaled by a power of two to a largest component from 1 to 2,
    which changes no cosine, so that tiny and huge ones keep theirs.  A null id counts as a link of others but is
    kept, without a component.  Other columns are not carried.

    Tiles hold ``tile_rows`` distinct vectors in the order of their cell on the first axes.
    Tile pairs are found by a join on label and cell of the first axis; each pair of tiles
    returns counts per vector and a spanning forest of its links, never all its pairs.
    """
    rows = vectors.select(vectors[id_column].cast("long").alias("id"), vectors[label_column].alias("label"), F.col(vector_column).cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    usable = F.coalesce(F.col("label").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    # -0.0 and 0.0 are one value.
    rows = rows.withColumn("v", F.when(usable, F.transform("v", lambda x: x + F.lit(0.0))))
    largest = F.array_max(F.transform("v", F.abs))
    rows = rows.withColumn("v", F.transform("v", lambda x: x / F.pow(F.lit(2.0), F.floor(F.log2(largest)))))
    rows = staged(rows.withColumn("w", F.size("v")), "rows")
    widths = [r["w"] for r in rows.where("v IS NOT NULL").groupBy("w").count().orderBy("w").collect()]
    parts = [_of_width(rows.where(F.col("w") == w), w, least, tile_rows) for w in widths]
    alone = rows.where("v IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    whole = reduce(DataFrame.union, parts, alone)
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "id"))
    return whole.select(F.col("id").alias(id_column), "n_links", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def _of_width(rows: DataFrame, width: int, least: float, tile_rows: int) -> DataFrame:
    """(id, n_links, component) of usable ``rows`` (id, label, v) of one length."""
    vectors = rows
    hashes = [F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")]
    real = rows.select("id", "label", "v", *hashes)
    groups = staged(real.groupBy("label", "h1", "h2").agg(F.coalesce(F.min("id"), F.lit((1 << 63) - 1)).alias("rep"), F.count("*").alias("times"), F.first("v").alias("v")), "vectors")
    values, axes = np.linalg.eigh(_moments(groups, width))
    axes = axes[:, np.argsort(-values, kind="stable")]

    reach = float(np.sqrt(max(0.0, 2 - 2 * least))) + 1e-9  # distance of unit vectors at the threshold
    turned = _turned(groups.select(F.xxhash64("label", "h1", "h2").alias("rep"), "label", "times", "v"), axes)
    # Order within a label by cells of the first axes; vectors of a cell are neighbours.
    cell = [F.floor(F.col("box")[k] / reach) for k in range(min(3, width))]
    ordered = turned.withColumn("first", cell[0]).withColumn("cell", F.struct(*[c.alias(f"c{k}") for k, c in enumerate(cell[1:], 1)]) if len(cell) > 1 else F.lit(0))
    ordered = staged(ordered, "turned")
    # Rows of one (label, first cell) are dealt to tiles by position in parts of bounded size.
    sized = ordered.groupBy("label", "first").agg(F.count("*").alias("n"))
    pieces = ordered.join(sized, ["label", "first"]).withColumn(
        "slice", F.pmod(F.xxhash64("cell"), F.ceil(F.col("n") / (16 * tile_rows)).cast("long")) * 64 + F.when(F.col("n") > 256 * tile_rows, F.pmod(F.col("rep"), F.lit(64))).otherwise(0)
    )
    place = Window.partitionBy("label", "first", "slice").orderBy("cell", "rep")
    tiled = pieces.withColumn("tile", F.floor((F.row_number().over(place) - 1) / tile_rows))
    tiles = tiled.groupBy("label", "first", "slice", "tile").agg(
        F.collect_list(F.struct("rep", "times", "v")).alias("rows"),
        F.array(*[F.min(F.col("box")[k]) for k in range(min(BOX, width))]).alias("low"),
        F.array(*[F.max(F.col("box")[k]) for k in range(min(BOX, width))]).alias("high"),
    )
    tiles = tiles.select("label", F.xxhash64("label", "first", "slice", "tile").alias("name"), "low", "high", "rows")
    tiles = staged(tiles, "tiles")

    boxes = tiles.select("label", "name", "low", "high")
    cells = F.sequence(F.floor(F.col("low")[0] / reach) - 1, F.floor(F.col("high")[0] / reach) + 1)
    left = boxes.select("label", F.col("name").alias("a"), F.col("low").alias("la"), F.col("high").alias("ha"), F.floor(F.col("low")[0] / reach).alias("at"))
    right = boxes.select("label", F.col("name").alias("b"), F.col("low").alias("lb"), F.col("high").alias("hb"), F.explode(cells).alias("at"))
    gap = F.aggregate(
        F.zip_with(
            F.arrays_zip(F.col("la"), F.col("ha")), F.arrays_zip(F.col("lb"), F.col("hb")), lambda p, q: F.greatest(p["la"] - q["hb"], q["lb"] - p["ha"], F.lit(0.0))
        ),
        F.lit(0.0),
        lambda total, d: total + d * d,
    )
    pairs = left.join(right, ["label", "at"]).where(gap <= reach * reach)
    pairs = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    one, two = tiles.select(F.col("name").alias("a"), F.col("rows").alias("x")), tiles.select(F.col("name").alias("b"), F.col("rows").alias("y"))
    met = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    shared = vectors.sparkSession.sparkContext.broadcast(axes)

    def side(cell: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = cell.values
        return own.field("rep").to_numpy(), own.field("times").to_numpy(), _matrix(own.field("v"), width)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                same_tile = batch.column(0)[k] == batch.column(1)[k]
                rep_x, times_x, x = side(batch.column(2)[k])
                rep_y, times_y, y = side(batch.column(3)[k])
                i, j = compare(x, y, shared.value, least, same_tile)
                if len(i):
                    count_x = np.bincount(i, times_y[j], len(rep_x)).astype(np.int64)
                    count_y = np.bincount(j, times_x[i], len(rep_y)).astype(np.int64)
                    tree = _forest(i, j if same_tile else j + len(rep_x))
                    a = np.concatenate([rep_x[count_x > 0], rep_y[count_y > 0], rep_x[i[tree]]])
                    b = np.concatenate([np.zeros((count_x > 0).sum() + (count_y > 0).sum(), np.int64), rep_y[j[tree]]])
                    n = np.concatenate([count_x[count_x > 0], count_y[count_y > 0], np.zeros(len(tree), np.int64)])
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(n)], ["a", "b", "n"])

    # Rows (a, b, n): n > 0 counts links of a in one pair of tiles, n = 0 is a link of the forest.
    found = staged(met.repartition(4 * shuffle_tasks(vectors)).mapInArrow(run, "a long, b long, n long"), "links")
    names = groups.select(F.xxhash64("label", "h1", "h2").alias("name"), "label", "h1", "h2", "times", "rep")
    counts = found.where("n > 0").groupBy(F.col("a").alias("name")).agg(F.sum("n").alias("others"))
    tree = found.where("n = 0").select("a", "b")
    tree = tree.join(names.select(F.col("name").alias("a"), F.col("rep").alias("p")), "a").join(names.select(F.col("name").alias("b"), F.col("rep").alias("q")), "b")
    classes = components(tree.select(F.col("p").alias("a"), F.col("q").alias("b")))
    known = names.join(counts, "name", "left").join(classes.withColumnRenamed("id", "rep"), "rep", "left")
    known = known.select("label", "h1", "h2", (F.coalesce("others", F.lit(0)) + F.col("times") - 1).alias("links"), F.coalesce("component", "rep").alias("c"))
    whole = rows.select("id", "label", *hashes).join(known, ["label", "h1", "h2"])
    return whole.select("id", F.col("links").cast("long").alias("n_links"), F.col("c").alias("component"))
