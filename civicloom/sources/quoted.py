"""CSV whose cells hold line breaks, read by many tasks.

A split of a file cannot tell whether it starts inside a quoted cell.  So every split first
reports where it would end for either start, which is all it takes to know where each one
does start: one pass over the splits of a file, two answers each.  Then each split cuts
its lines to records on its own, and only the pieces of records that cross a split are
put together.  Lines are never shuffled.
"""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from civicloom.functions.names import normalize_names
from civicloom.session import stored

#: Pieces of records: the end of one that another split began, the start of one that goes on, and all of a split.
WHOLE, HEAD, TAIL, ALL = range(4)


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that starts inside a quoted cell, or not, ends in one.

    A quote opens a cell only where a cell starts, doubled quotes are text, and what
    follows a closing quote up to the next comma belongs to the cell.
    """
    at = 0
    if not inside:
        if not line.startswith('"'):
            at = line.find(',"') + 1
            if not at:
                return False
        at += 1
    while True:
        close = line.find('"', at)
        while close >= 0 and line.startswith('"', close + 1):
            close = line.find('"', close + 2)
        if close < 0:
            return True
        at = line.find(',"', close + 1) + 2
        if at < 2:
            return False


def _lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, start, line): the split a line belongs to, by the file's hash and its first byte."""
    text = spark.read.text(path, lineSep="\n")
    return text.select(F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"), F.col("value").alias("line"))


def _splits(batch: pa.RecordBatch) -> Iterator[tuple[tuple[int, int], pa.Array]]:
    """Runs of rows of one split."""
    file, start = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    edges = [0, *((file[1:] != file[:-1]) | (start[1:] != start[:-1])).nonzero()[0] + 1, batch.num_rows]
    for lo, hi in zip(edges, edges[1:]):
        if hi > lo:
            yield (int(file[lo]), int(start[lo])), batch.column(2).slice(lo, hi - lo)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, plain, quoted, header): whether a split ends inside a cell, by how it starts, and a file's first record."""
    state: dict[tuple[int, int], list[bool]] = {}
    header: dict[tuple[int, int], tuple[list[str], bool]] = {}
    for batch in batches:
        for key, lines in _splits(batch):
            own = state.setdefault(key, [False, True])
            if key[1] == 0 and not header.get(key, ([], False))[1]:
                parts, _ = header.setdefault(key, ([], False))
                inside = bool(parts)
                for line in lines.to_pylist():
                    if not inside and line.strip("\r") == "":
                        continue
                    parts.append(line)
                    inside = ends_inside(line, inside)
                    if not inside:
                        header[key] = (parts, True)
                        break
            for line in lines.filter(pc.match_substring(lines, '"')).to_pylist():
                own[:] = [ends_inside(line, s) for s in own]
    keys = list(state)
    heads = ["\n".join(header[k][0]).removesuffix("\r") if header.get(k, ([], False))[1] else None for k in keys]
    columns = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([state[k][0] for k in keys], pa.bool_()), pa.array([state[k][1] for k in keys], pa.bool_()), pa.array(heads, pa.string())]
    yield pa.RecordBatch.from_arrays(columns, ["file", "start", "plain", "quoted", "header"])


def _records(batches: Iterator[pa.RecordBatch], inside_at: set[tuple[int, int]], pieces: bool) -> Iterator[pa.RecordBatch]:
    """(kind, file, start, text): the whole records of each split, or the pieces of those that cross its ends."""
    at: tuple[int, int] | None = None
    inside, held = False, []
    first, header = True, False  # nothing of this split is cut yet; the file's header is still to come
    out: list[tuple[int, int, int, str]] = []

    def put(kind: int, text: str) -> None:
        if (kind != WHOLE) == pieces:
            out.append((kind, *at, text))

    def closed() -> None:
        if held:
            put(ALL if first and at in inside_at else TAIL, "\n".join(held))
            held.clear()

    def batch_of() -> pa.RecordBatch:
        made = pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.string()))], ["kind", "file", "start", "text"])
        out.clear()
        return made

    for batch in batches:
        for key, lines in _splits(batch):
            if key != at:
                closed()
                at, inside, first, header = key, key in inside_at, True, key[1] == 0
            if not inside and not held and not header and not pc.any(pc.match_substring(lines, '"')).as_py():
                first = False
                if not pieces:
                    out += [(WHOLE, *at, line) for line in lines.to_pylist()]
                continue
            for line in lines.to_pylist():
                held.append(line)
                if inside or '"' in line:
                    inside = ends_inside(line, inside)
                if not inside:
                    if not header:
                        put(HEAD if first and at in inside_at else WHOLE, "\n".join(held))
                    header &= line.strip("\r") == ""
                    held.clear()
                    first = False
        yield batch_of()
    if at is not None:
        closed()
        yield batch_of()


def read_quoted_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """CSV files of one header, cells with quoted line breaks, as strings under normalised column names.

    The same rows as Spark's reader with ``multiLine``, but a file takes as many tasks as it
    has splits.  Text is read three times: for the state at the splits' ends, for the pieces
    that cross them, and for the rows.  The driver keeps two flags a split, which it lists
    anyway to schedule the read.  Files with other headers, or in another order, are an error.
    """
    lines = _lines(spark, path)
    known = lines.mapInArrow(_ends, "file long, start long, plain boolean, quoted boolean, header string").collect()
    headers = {r["header"] for r in known if r["start"] == 0}
    if len(headers) != 1 or None in headers:
        raise ValueError(f"files need one header, the same in all: {sorted(map(str, headers))[:3]}")
    inside_at: set[tuple[int, int]] = set()
    of_file: dict[int, list] = defaultdict(list)
    for r in known:
        of_file[r["file"]].append(r)
    for file, splits in of_file.items():
        inside = False
        for r in sorted(splits, key=lambda r: r["start"]):
            if inside:
                inside_at.add((file, r["start"]))
            inside = r["quoted"] if inside else r["plain"]
    shared = spark.sparkContext.broadcast(inside_at)

    def cut(pieces: bool) -> DataFrame:
        return lines.mapInArrow(lambda batches: _records(batches, shared.value, pieces), "kind int, file long, start long, text string")

    crossing = stored(cut(True))
    place = Window.partitionBy("file").orderBy("start", F.col("kind") == TAIL)
    number = F.sum(F.when(F.col("kind") == TAIL, 1).otherwise(0)).over(place)
    listed = crossing.withColumn("number", number).groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts"))
    joined = listed.select(F.array_join(F.transform("parts", lambda p: p["text"]), "\n").alias("text"))
    header = headers.pop()
    whole = cut(False).select("text").union(joined).select(F.regexp_replace("text", "\r$", "").alias("text"))
    whole = whole.where("text != ''")
    names = next(csv.reader(io.StringIO(header, newline="")))
    fields = ", ".join(f"c{k} string" for k in range(len(names)))
    row = F.from_csv("text", fields, {"quote": '"', "escape": '"', "multiLine": "true", "maxCharsPerColumn": "-1"})
    return whole.select(row.alias("r")).select("r.*").toDF(*normalize_names(names))
