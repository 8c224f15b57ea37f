"""Removal of long byte strings that an earlier document has too.

Windows of 50 bytes are dealt by content: every window is filed under the least of its
24-byte grams (by a hash), so equal windows meet wherever they stand.  Grams that only
one text holds are dropped first.  What is left - short pieces of consecutive windows
under one gram - goes by gram to tasks, which build the Burrows-Wheeler transform of
their pieces and expand intervals on it up to 50 bytes to find equal windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.llm.bwt import least_owner
from civicloom.llm.common import forget, lean, mix, same, shuffle_tasks, slices, staged

GRAM = 24
#: Windows of one document that are looked at together.
STRIDE = 1 << 17
#: Bytes of documents that are looked at together.
TOGETHER = 1 << 19
#: A gram in so many texts or more has its windows dealt one by one.
HOT = 20_000
#: Low bytes of a gram's 48-bit name that are sent; the rest is its part.
LOW_BYTES = 5
LAST = (1 << 63) - 1


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        h = np.minimum(h[:-size], h[size:])
        size *= 2
    return h if size == width else np.minimum(h[: len(h) - (width - size)], h[width - size :])


def pieces(texts: list[bytes], least: int) -> Iterator[tuple[np.ndarray, ...]]:
    """(buffer, start in it, windows, name of the gram, text, start in the text) of runs of windows.

    A run is neighbouring windows of one text whose least gram is the same one.  A long text
    is looked at in strides that overlap by a window less a byte, so each window is in one.
    """
    parts, held = [], 0
    for number, text in enumerate(texts):
        for at in range(0, max(0, len(text) - least + 1), STRIDE):
            part = text[at : at + STRIDE + least - 1]
            parts.append((number, at, part))
            held += len(part)
            if held >= TOGETHER:
                yield _runs(parts, least)
                parts, held = [], 0
    if parts:
        yield _runs(parts, least)


def _runs(parts: list[tuple[int, int, bytes]], least: int) -> tuple[np.ndarray, ...]:
    raw = b"".join(p for *_, p in parts)
    buffer = np.frombuffer(raw, np.uint8)
    lengths = np.array([len(p) for *_, p in parts])
    starts = np.cumsum(lengths) - lengths
    words = np.ndarray((len(raw) - 7,), "<u8", raw, strides=(1,))
    n = len(raw) - GRAM + 1
    h = mix(words[:n])
    for k in range(8, GRAM, 8):
        h = mix(h + words[k : k + n])
    bits = np.uint64(int(n).bit_length())
    low = (np.uint64(1) << bits) - np.uint64(1)
    place = (_least((h & ~low) | np.arange(n, dtype=np.uint64), least - GRAM + 1) & low).astype(np.int64)
    inside = np.ones(len(place), bool)  # windows that end in the part they start in
    for edge in starts[1:].tolist():
        inside[max(0, edge - least + 1) : edge] = False
    change = np.ones(len(place) + 1, bool)
    change[1:-1] = (place[1:] != place[:-1]) | (inside[1:] != inside[:-1])
    change[starts[starts < len(place)]] = True
    edges = np.flatnonzero(change)
    first, count = edges[:-1], np.diff(edges)
    good = inside[first]
    first, count = first[good], count[good]
    name = mix(h[place[first]] ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(16)
    part = np.searchsorted(starts, first, side="right") - 1
    number, at = np.array([p[0] for p in parts]), np.array([p[1] for p in parts])
    return buffer, first, count, name, number[part], at[part] + first - starts[part]


def _cut(values: np.ndarray, width: int) -> np.ndarray:
    return np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width])


def _full(raw: bytes, width: int) -> np.ndarray:
    out = np.zeros((len(raw) // width, 8), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(-1, width)
    return out.view("<u8").ravel()


def _gather(buffer: np.ndarray, first: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    at = np.arange(int(lengths.sum())) + np.repeat(first - (np.cumsum(lengths) - lengths), lengths)
    return buffer[at]


_powers = np.cumprod(np.full(256, 0x5851F42D4C957F2D, np.uint64))
_values = np.random.default_rng(7).integers(0, 1 << 63, 256, dtype=np.uint64)


def _content(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each piece in ``data`` (pieces one after the other, each under 256 bytes)."""
    starts = np.cumsum(lengths) - lengths
    inner = np.arange(len(data)) - np.repeat(starts, lengths)
    return mix(np.add.reduceat(_values[data] * _powers[inner], starts) + lengths.astype(np.uint64)) if len(lengths) else np.zeros(0, np.uint64)


def _texts(table: pa.Table) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct texts of a bucket, the smallest id of each, and how many rows have that id; by id and text.

    The place in this order names a text within its bucket, also after a task is run again.
    """
    best: dict[bytes, list[int]] = {}
    for id_, times, text in zip(table["id"].to_pylist(), table["times"].to_pylist(), table["text"].to_pylist()):
        own = best.setdefault(text, [id_, 0])
        if id_ < own[0]:
            own[:] = [id_, 0]
        if id_ == own[0]:
            own[1] += times
    order = sorted(best.items(), key=lambda x: (x[1][0], x[0]))
    return [t for t, _ in order], np.array([v[0] for _, v in order], np.int64), np.array([v[1] for _, v in order], np.int64)


def _dealt(docs: DataFrame) -> DataFrame:
    """(bucket, id, times, text as bytes): each text goes to its bucket once from each batch, with its smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text"):
            if batch.num_rows:
                names = ["bucket", "id", "times", "text"]
                table = pa.table([batch.column(0), batch.column(1), pa.array(np.ones(batch.num_rows, np.int64)), batch.column(2)], names=names)
                bucket = dict(zip(batch.column(2).to_pylist(), batch.column(0).to_pylist()))
                texts, ids, times = _texts(table)
                yield pa.RecordBatch.from_arrays([pa.array([bucket[t] for t in texts], pa.int32()), pa.array(ids), pa.array(times), pa.array(texts, pa.binary())], names)

    return docs.mapInArrow(run, "bucket int, id long, times long, text binary")


def _grams(table: pa.Table, least: int, bits: int) -> pa.Table:
    """Names of the grams of a bucket and the number of texts that hold each, by part."""
    texts, *_ = _texts(table)
    names, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for _, _, _, name, number, _ in pieces(texts, least):
        order = np.lexsort((number, name))
        name, number = name[order], number[order]
        new = np.ones(len(name), bool)
        new[1:] = (name[1:] != name[:-1]) | (number[1:] != number[:-1])
        names.append(name[new])
        owners.append(number[new])
    name, owner = np.concatenate(names), np.concatenate(owners)
    order = np.lexsort((owner, name))
    name, owner = name[order], owner[order]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
    name = name[new]
    first = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]])) if len(name) else np.zeros(0, np.int64)
    count = np.diff(np.append(first, len(name)))
    name = name[first]
    held = np.where(count < 200, count, 200 + np.minimum(55, np.log2(np.maximum(count, 200) / 200))).astype(np.uint8)
    part = (name >> np.uint64(48 - bits)).astype(np.int64)
    edges = np.searchsorted(part, np.arange((1 << bits) + 1))
    own = [p for p in range(1 << bits) if edges[p + 1] > edges[p]]
    low = _cut(name, LOW_BYTES)
    bucket = table["bucket"][0].as_py()
    return pa.table(
        [
            pa.array(own, pa.int32()),
            pa.array([bucket] * len(own), pa.int32()),
            pa.array([low[edges[p] : edges[p + 1]].tobytes() for p in own], pa.binary()),
            pa.array([held[edges[p] : edges[p + 1]].tobytes() for p in own], pa.binary()),
        ],
        names=["part", "bucket", "names", "held"],
    )


def _shared(table: pa.Table) -> pa.Table:
    """Of the grams of a part, for each bucket, those that two texts or more hold, and whether they are hot."""
    raw = table["names"].to_pylist()
    name = _full(b"".join(raw), LOW_BYTES)
    held = np.frombuffer(b"".join(table["held"].to_pylist()), np.uint8)
    count = np.where(held < 200, held, 200 << np.maximum(held.astype(np.int64) - 200, 0)).astype(np.int64)
    kinds, inverse = np.unique(name, return_inverse=True)
    total = np.bincount(inverse, count, len(kinds))[inverse]
    edges = np.cumsum([0] + [len(r) // LOW_BYTES for r in raw])
    low = _cut(name, LOW_BYTES)
    buckets, names, hot = [], [], []
    for b, lo, hi in zip(table["bucket"].to_pylist(), edges, edges[1:]):
        kept = total[lo:hi] > 1
        if kept.any():
            buckets.append(b)
            names.append(low[lo:hi][kept].tobytes())
            hot.append((total[lo:hi][kept] >= HOT).astype(np.uint8).tobytes())
    part = [table["part"][0].as_py()] * len(buckets)
    return pa.table([pa.array(buckets, pa.int32()), pa.array(part, pa.int32()), pa.array(names, pa.binary()), pa.array(hot, pa.binary())], names=["bucket", "part", "names", "hot"])


PIECES = "part int, bucket int, data binary, lengths binary, ids binary, counts binary, numbers binary, starts binary, done_numbers binary, done_starts binary, done_lengths binary"


def _cut_out(table: pa.Table, known: pa.Table, least: int, bits: int, parts: int) -> pa.Table:
    """Pieces under shared grams, by the part that compares them.

    Pieces of equal content in the bucket go on once, with the places in the smallest
    document; those in other documents are settled here, as an earlier one has them whole.
    """
    schema = pa.schema([(f.split()[0], pa.int32() if f.endswith("int") else pa.binary()) for f in PIECES.split(", ")])
    if not table.num_rows or not known.num_rows:
        return schema.empty_table()
    texts, ids, _ = _texts(table)
    high = known["part"].to_numpy().astype(np.uint64)
    raw = known["names"].to_pylist()
    rest = np.uint64(48 - bits)
    name = np.concatenate([_full(r, LOW_BYTES) & ((np.uint64(1) << rest) - np.uint64(1)) | p << rest for r, p in zip(raw, high)])
    hot = np.frombuffer(b"".join(known["hot"].to_pylist()), np.uint8)
    order = np.argsort(name)
    name, hot = name[order], hot[order] > 0
    out = {k: [] for k in ("data", "length", "name", "owner", "start", "hash")}
    for buffer, first, count, own, number, start in pieces(texts, least):
        at = np.minimum(np.searchsorted(name, own), len(name) - 1)
        hit = name[at] == own
        first, count, own, number, start, single = first[hit], count[hit], own[hit], number[hit], start[hit], hot[at[hit]]
        if single.any():  # one window to a piece
            each = np.where(single, count, 1)
            step = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each)
            first, start = np.repeat(first, each) + step, np.repeat(start, each) + step
            count, own, number, single = (np.repeat(x, each) for x in (np.where(single, 1, count), own, number, single))
        length = count + least - 1
        data = _gather(buffer, first, length)
        hash_ = _content(data, length)
        own = np.where(single, mix(hash_) >> np.uint64(16), own)
        for k, v in (("data", data), ("length", length), ("name", own), ("owner", number), ("start", start), ("hash", hash_)):
            out[k].append(v)
    length, own, number, start, hash_ = (np.concatenate(out[k]) for k in ("length", "name", "owner", "start", "hash"))
    data = np.concatenate(out["data"])
    if not len(length):
        return schema.empty_table()
    part = (own % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((start, number, hash_, part))
    offset = np.cumsum(length) - length
    p, h, o = part[order], hash_[order], number[order]
    lead = np.ones(len(order), bool)
    lead[1:] = (h[1:] != h[:-1]) | (p[1:] != p[:-1])
    group = np.cumsum(lead) - 1
    leader = np.flatnonzero(lead)
    mine = ids[o] == ids[o[leader]][group]
    heads = order[leader]
    counts = np.bincount(group[mine], minlength=len(leader))
    body = _gather(data, offset[heads], length[heads])
    body_at = np.concatenate([[0], np.cumsum(length[heads])])
    place_at = np.concatenate([[0], np.cumsum(counts)])
    places, holders = start[order[mine]].astype("<u4"), number[order[mine]].astype("<u4")
    done = order[~mine]
    own_parts = np.unique(part)
    lo, hi = np.searchsorted(part[heads], own_parts), np.searchsorted(part[heads], own_parts, side="right")
    short, owners = length[heads].astype(np.uint8), ids[number[heads]]
    rows = [
        own_parts.tolist(),
        [table["bucket"][0].as_py()] * len(own_parts),
        [body[body_at[a] : body_at[b]].tobytes() for a, b in zip(lo, hi)],
        [short[a:b].tobytes() for a, b in zip(lo, hi)],
        [owners[a:b].tobytes() for a, b in zip(lo, hi)],
        [counts[a:b].astype("<u4").tobytes() for a, b in zip(lo, hi)],
        [holders[place_at[a] : place_at[b]].tobytes() for a, b in zip(lo, hi)],
        [places[place_at[a] : place_at[b]].tobytes() for a, b in zip(lo, hi)],
        *([b""] * len(own_parts) for _ in range(3)),
    ]
    if len(done):  # settled: a row of its own, so no part gathers the places of a passage that is everywhere
        settled = [v.astype("<u4").tobytes() for v in (number[done], start[done], length[done])]
        for row, value in zip(rows, [-1 - table["bucket"][0].as_py(), table["bucket"][0].as_py(), *[b""] * 6, *settled]):
            row.append(value)
    return pa.table([pa.array(r, f.type) for r, f in zip(rows, schema)], schema=schema)


REMOVALS = "bucket int, numbers binary, starts binary, lengths binary"


def _judge(table: pa.Table, least: int) -> pa.Table:
    """Byte ranges to remove, by bucket, from the pieces of a part."""

    def joined(column: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(table[column].to_pylist()), kind)

    if table["part"][0].as_py() < 0:
        return pa.table([table[c] for c in ("bucket", "done_numbers", "done_starts", "done_lengths")], names=["bucket", "numbers", "starts", "lengths"])
    buckets = table["bucket"].to_numpy()
    per_row = np.array([len(x) for x in table["lengths"].to_pylist()])
    data, length = joined("data", "u1"), joined("lengths", "u1").astype(np.int64)
    ids, counts = joined("ids", "<i8"), joined("counts", "<u4").astype(np.int64)
    numbers, starts = joined("numbers", "<u4"), joined("starts", "<u4").astype(np.int64)
    bucket = np.repeat(buckets, per_row)
    hash_ = _content(data, length)
    order = np.lexsort((ids, hash_))
    lead = np.ones(len(order), bool)
    lead[1:] = hash_[order][1:] != hash_[order][:-1]
    heads = order[lead]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(lead) - 1
    smallest = ids[heads]
    offset = np.cumsum(length) - length
    at, best = least_owner(_gather(data, offset[heads], length[heads]), length[heads], smallest, least)
    # Windows of each distinct piece that a document before its smallest has.
    ends = np.cumsum(length[heads])
    piece = np.searchsorted(ends, at, side="right")
    hit = best < smallest[piece]
    piece, window = piece[hit], (at - (ends - length[heads])[piece])[hit]
    by = np.lexsort((window, piece))
    piece, window = piece[by], window[by]
    new = np.ones(len(piece), bool)
    new[1:] = (piece[1:] != piece[:-1]) | (window[1:] != window[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(piece)) - 1 if len(piece) else first
    run_piece, run_start, run_length = piece[first], window[first], window[last] - window[first] + least if len(piece) else window[first]
    run_at = np.searchsorted(run_piece, np.arange(len(heads) + 1))
    # Every place: whole where its document is not the smallest, else the runs.
    item = np.repeat(np.arange(len(length)), counts)
    whole = ids[item] != smallest[group[item]]
    runs = np.diff(run_at)[group[item]] * ~whole
    again = np.repeat(np.arange(len(item)), runs)
    run = np.arange(len(again)) - np.repeat(np.cumsum(runs) - runs, runs) + run_at[:-1][group[item[again]]]
    out_bucket = np.concatenate([bucket[item[whole]], bucket[item[again]]])
    out_number = np.concatenate([numbers[whole], numbers[again]])
    out_start = np.concatenate([starts[whole], starts[again] + run_start[run]])
    out_length = np.concatenate([length[item[whole]], run_length[run]])
    order = np.argsort(out_bucket, kind="stable")
    own = np.unique(out_bucket)
    lo, hi = np.searchsorted(out_bucket[order], own), np.searchsorted(out_bucket[order], own, side="right")

    def split(values: np.ndarray, kind: str) -> pa.Array:
        values = values[order].astype(kind)
        return pa.array([values[a:b].tobytes() for a, b in zip(lo, hi)], pa.binary())

    return pa.table([pa.array(own, pa.int32()), split(out_number, "<u4"), split(out_start, "<u4"), split(out_length, "<u4")], names=["bucket", "numbers", "starts", "lengths"])


def _apply(table: pa.Table, removals: pa.Table) -> pa.Table:
    """(id, n_bytes, kept, spans): one row for each row of a distinct text's smallest id."""
    texts, ids, times = _texts(table)
    pa.default_memory_pool().release_unused()

    def joined(column: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(removals[column].to_pylist()), kind)

    owner, start, length = joined("numbers", "<u4"), joined("starts", "<u4").astype(np.int64), joined("lengths", "<u4").astype(np.int64)
    order = np.lexsort((start, owner))
    owner, start, end = owner[order], start[order], (start + length)[order]
    every = np.arange(len(texts))
    lo, hi = np.searchsorted(owner, every), np.searchsorted(owner, every, side="right")
    out_id, size, kept, edges, lefts, rights = [], [], [], [0], [], []
    for text, id_, n, a, b in zip(texts, ids.tolist(), times.tolist(), lo.tolist(), hi.tolist()):
        left = right = np.zeros(0, np.int64)
        rest = text
        if b > a:
            reach = np.maximum.accumulate(end[a:b])
            new = np.concatenate([[True], start[a + 1 : b] > reach[:-1]])
            left = start[a:b][new]
            right = reach[np.append(np.flatnonzero(new)[1:], b - a) - 1]
            cuts = zip([0, *right.tolist()], [*left.tolist(), len(text)])
            rest = b"".join(text[x:y] for x, y in cuts)
        for _ in range(n):
            out_id.append(id_)
            size.append(len(text))
            kept.append(rest)
            lefts.append(left)
            rights.append(right)
            edges.append(edges[-1] + len(left))
    spans = pa.StructArray.from_arrays([pa.array(np.concatenate(lefts or [[]]).astype(np.int64)), pa.array(np.concatenate(rights or [[]]).astype(np.int64))], ["start", "end"])
    return pa.table([pa.array(out_id, pa.int64()), pa.array(size, pa.int64()), pa.array(kept, pa.binary()), pa.ListArray.from_arrays(pa.array(edges, pa.int32()), spans)], names=["id", "n_bytes", "kept", "spans"])


def remove_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = 50, bucket_bytes: int = 4 << 20) -> DataFrame:
    """(id, n_bytes, kept binary, spans array<struct<start, end>>), one row per input row.

    A byte goes if a string of ``least`` bytes around it also starts in a document with a
    smaller id; strings are judged on the input.  A null text is empty; texts under
    ``least`` bytes stay whole.  A null id counts as larger than any other and stays null.
    Rows with one id are one document: they take nothing from each other.  Other columns
    are not carried.

    A text that occurs under several ids takes part once, with the smallest; under the
    others it goes whole.  Texts move once, to buckets by their hash, and the exchange is
    used again by the steps that need them.
    """
    if not GRAM <= least <= 200:
        raise ValueError(f"least must be between {GRAM} and 200")
    rows = docs.select(F.coalesce(docs[id_column].cast("long"), F.lit(LAST)).alias("id"), F.coalesce(docs[text_column], F.lit("")).alias("text"))
    h1, h2 = F.xxhash64("text"), F.xxhash64(F.lit(1), "text")
    brief = F.when(F.octet_length("text") < least, F.col("text"))
    narrow = staged(rows.select("id", h1.alias("h1"), h2.alias("h2"), F.octet_length("text").cast("long").alias("n"), brief.alias("brief")), "texts")
    total = narrow.agg(F.sum("n")).first()[0] or 0
    buckets = max(-(-total // bucket_bytes), 2 * shuffle_tasks(docs))
    bits = max(48 - 8 * LOW_BYTES, int(max(total >> 22, 1)).bit_length())
    parts = max(-(-total // (2 << 20)), 2 * shuffle_tasks(docs))

    bucketed = rows.select(F.pmod(h1, F.lit(buckets)).cast("int").alias("bucket"), "id", F.col("text").cast("binary").alias("text"))
    tasks = max(shuffle_tasks(docs), -(-total // (64 << 20)))
    dealt = _dealt(bucketed).repartition(tasks, "bucket")
    grams = dealt.groupBy("bucket").applyInArrow(lean(lambda t: _grams(t, least, bits)), "part int, bucket int, names binary, held binary")
    shared = grams.groupBy("part").applyInArrow(lean(_shared), "bucket int, part int, names binary, hot binary")
    cut = dealt.groupBy("bucket").cogroup(shared.groupBy("bucket")).applyInArrow(lean(lambda t, k: _cut_out(t, k, least, bits, parts)), PIECES)
    removals = cut.groupBy("part").applyInArrow(lean(lambda t: _judge(t, least)), REMOVALS)
    first = dealt.groupBy("bucket").cogroup(removals.groupBy("bucket")).applyInArrow(lean(_apply), "id long, n_bytes long, kept binary, spans array<struct<start: long, end: long>>")

    least_id = narrow.groupBy("h1", "h2").agg(F.min("id").alias("rep"))
    copies = narrow.join(least_id, ["h1", "h2"]).where("id > rep")
    whole = F.when(F.col("n") >= least, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n").alias("end"))))
    copies = copies.select(
        "id",
        F.col("n").alias("n_bytes"),
        F.coalesce(F.col("brief"), F.lit("")).cast("binary").alias("kept"),
        F.coalesce(whole, F.array().cast("array<struct<start: bigint, end: bigint>>")).alias("spans"),
    )
    out = first.union(copies)
    return out.select(F.when(F.col("id") != LAST, F.col("id")).alias(id_column), "n_bytes", "kept", "spans")


def rewritten(docs: DataFrame, kept: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with the kept bytes as text; a character that lost some of its bytes goes whole.

    ``docs`` has one row per id.
    """

    @F.pandas_udf("string")
    def plain(raw):
        return raw.map(lambda b: None if b is None else b.decode("utf-8", "ignore"))

    rest = kept.select(F.col(id_column).alias("__id"), F.col("kept").alias("__kept"))
    other = docs.select(*[docs[c] for c in docs.columns if c != text_column], docs[text_column].isNull().alias("__null"))
    joined = other.join(rest, same(F.col(id_column), F.col("__id")))
    new = F.when(~F.col("__null"), plain("__kept"))
    return joined.withColumn(text_column, new).select(*docs.columns)
