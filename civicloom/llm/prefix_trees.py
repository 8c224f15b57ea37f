"""Removal of word passages that an earlier document has too, by prefix-partitioned suffix trees.

The suffixes that take part start at cut points: of every window of 13 words, the four
words among its first six starts that hash least.  Equal windows have the same cut point,
and at least eight words follow it inside the window.  Suffixes are split by a prefix of
variable length: four words, or eight where too many suffixes share four, so that a group
fits in memory; prefixes that one document has alone are leaves and dropped before any text
moves.  A task gets the text of the groups of its part, sorts their suffixes and takes the
inner nodes of each subtree from common prefixes: suffixes under a node that is as deep as
a window reaches, and with equal words before the cut, are repeats.  Where more than GROUP
documents share eight words, the windows are whole prefixes themselves: nodes without a
subtree, which need a minimum and no sorting.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.llm.common import mix, shuffle_tasks, staged
from civicloom.llm.substrings import LAST, _dealt, _texts

GRAM = 4
#: Words that follow a cut point inside every window of its own.
AFTER = 8
#: Documents of one prefix that are sorted together.
GROUP = 1000
#: Bytes of a word that are kept as they are; a longer one goes by its digest.
LONG = 200
#: Words of one document, and bytes of short documents, that are looked at together.
STRIDE = 1 << 16
TOGETHER = 1 << 19
#: A byte that no text in UTF-8 has.
NEVER = b"\xff"

_white = np.zeros(256, bool)
_white[[9, 10, 11, 12, 13, 32]] = True
_values = np.random.default_rng(11).integers(0, 1 << 63, 256, dtype=np.uint64)
_factor = 0x5851F42D4C957F2D
_back = pow(_factor, -1, 1 << 64)


def _spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of ``raw``, found in strips of bounded size."""
    starts, ends = [], []
    before = True
    for at in range(0, len(raw), 1 << 22):
        white = _white[np.frombuffer(raw, np.uint8, min(1 << 22, len(raw) - at), at)]
        change = np.flatnonzero(np.diff(white, prepend=before)) + at
        first = 0 if before else 1
        starts.append(change[first::2])
        ends.append(change[1 - first :: 2])
        before = bool(white[-1])
    if not before:
        ends.append(np.array([len(raw)]))
    return tuple(np.concatenate(x).astype(np.int64) if x else np.zeros(0, np.int64) for x in (starts, ends))


def plain(text: bytes) -> tuple[bytes, np.ndarray, np.ndarray]:
    """``text`` with every long word replaced by its digest, and the spans of its words."""
    starts, ends = _spans(text)
    if len(starts) and int((ends - starts).max()) > LONG:
        text = b" ".join(w if len(w) <= LONG else NEVER + hashlib.sha256(w).hexdigest().encode() for w in text.split())
        starts, ends = _spans(text)
    return text, starts, ends


def _powers(base: int, n: int) -> np.ndarray:
    held = _tables.get(base)
    if held is None or len(held) < n:
        size = max(n, TOGETHER + (1 << 16))
        held = _tables[base] = np.concatenate([[np.uint64(1)], np.cumprod(np.full(size, base, np.uint64))])
    return held


_tables: dict[int, np.ndarray] = {}


def hashed(raw: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word: equal words have equal ones."""
    n = len(raw)
    total = np.concatenate([[np.uint64(0)], np.cumsum(_values[np.frombuffer(raw, np.uint8)] * _powers(_factor, n)[:n])])
    return mix((total[ends] - total[starts]) * _powers(_back, n)[starts] + (ends - starts).astype(np.uint64))


def _chunks(texts: list[bytes], width: int) -> Iterator[tuple[bytes, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(raw, starts, ends, text number, place in the text) of words; every window is in one chunk."""

    def joined():
        raw, at, out = [], 0, []
        for number, first, part, starts, ends in held:
            out.append((starts + at, ends + at, np.full(len(starts), number), np.arange(first, first + len(starts))))
            raw.append(part)
            at += len(part) + 1
        return b"\n".join(raw), *(np.concatenate(x) for x in zip(*out))

    held, size = [], 0
    for number, text in enumerate(texts):
        raw, starts, ends = plain(text)
        for first in range(0, max(0, len(starts) - width + 1), STRIDE):
            lo, hi = starts[first : first + STRIDE + width - 1], ends[first : first + STRIDE + width - 1]
            held.append((number, first, raw[lo[0] : hi[-1]], lo - lo[0], hi - lo[0]))
            size += int(hi[-1] - lo[0])
            if size >= TOGETHER:
                yield joined()
                held, size = [], 0
    if held:
        yield joined()


def cut_points(w: np.ndarray, number: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(cut, first window, windows, name) of runs of windows with one cut point.

    ``w`` hashes the words, ``number`` tells texts apart.  The upper half of a name hashes the
    four words at the cut, the lower half all eight.
    """
    h = w[: len(w) - GRAM + 1]
    for k in range(1, GRAM):
        h = mix(h + w[k : k + len(h)])
    windows = len(w) - width + 1
    low, cut = h[:windows].copy(), np.arange(windows)
    for k in range(1, width - AFTER + 1):
        less = h[k : k + windows] < low
        low[less] = h[k : k + windows][less]
        cut[less] = np.flatnonzero(less) + k
    inside = number[:windows] == number[width - 1 :]
    new = np.ones(windows, bool)
    new[1:] = (cut[1:] != cut[:-1]) | (inside[1:] != inside[:-1]) | (number[1:windows] != number[: windows - 1])
    edges = np.append(np.flatnonzero(new), windows)
    first, count = edges[:-1], np.diff(edges)
    good = inside[first]
    first, count = first[good], count[good]
    cut = cut[first]
    long = h[cut]
    for k in range(GRAM, AFTER):
        long = mix(long + w[cut + k])
    half = np.uint64(32)
    return cut, first, count, mix(h[cut]) >> half << half | mix(long) >> half


def _distinct(name: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((owner, name))
    name, owner = name[order], owner[order]
    new = np.ones(len(name), bool)
    new[1:] = (name[1:] != name[:-1]) | (owner[1:] != owner[:-1])
    return name[new], owner[new]


def _names(table: pa.Table, width: int, bits: int) -> pa.Table:
    """Prefixes of a bucket and the number of its texts that have each, by part."""
    texts, *_ = _texts(table)
    names, owners = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for raw, starts, ends, number, _ in _chunks(texts, width):
        cut, _, _, name = cut_points(hashed(raw, starts, ends), number, width)
        name, owner = _distinct(name, number[cut])
        names.append(name)
        owners.append(owner)
    name, _ = _distinct(np.concatenate(names), np.concatenate(owners))
    name, held = np.unique(name, return_counts=True)
    part = (name >> np.uint64(64 - bits)).astype(np.int64)
    own, lo = np.unique(part, return_index=True)
    hi = np.append(lo[1:], len(part))
    bucket = table["bucket"][0].as_py()
    held = np.minimum(held, 255).astype(np.uint8)
    return pa.table(
        [
            pa.array(own, pa.int32()),
            pa.array([bucket] * len(own), pa.int32()),
            pa.array([name[a:b].tobytes() for a, b in zip(lo, hi)], pa.binary()),
            pa.array([held[a:b].tobytes() for a, b in zip(lo, hi)], pa.binary()),
        ],
        names=["part", "bucket", "names", "held"],
    )


def split(name: np.ndarray, held: np.ndarray, group: int = GROUP) -> np.ndarray:
    """The length of the prefix that each name goes by: 4, 8, or 0 for whole windows; -1 for a leaf.

    The same prefix may be there several times, with documents of its own each time.
    """
    kinds, place = np.unique(name, return_inverse=True)
    total = np.bincount(place, held, len(kinds))
    shared = total > 1
    short = kinds >> np.uint64(32)
    _, of = np.unique(short, return_inverse=True)
    under = np.bincount(of, total * shared)[of]
    length = np.where(under <= group, GRAM, np.where(total <= group, AFTER, 0))
    return np.where(shared, length, -1)[place].astype(np.int8)


def _split_part(table: pa.Table, group: int) -> pa.Table:
    """For each bucket, its prefixes that two documents or more have, with the length they go by."""
    raw = table["names"].to_pylist()
    name = np.frombuffer(b"".join(raw), np.uint64)
    held = np.frombuffer(b"".join(table["held"].to_pylist()), np.uint8)
    length = split(name, held, group)
    edges = np.cumsum([0] + [len(r) // 8 for r in raw])
    out = []
    for bucket, lo, hi in zip(table["bucket"].to_pylist(), edges, edges[1:]):
        kept = length[lo:hi] >= 0
        if kept.any():
            out.append((bucket, name[lo:hi][kept].tobytes(), length[lo:hi][kept].tobytes()))
    return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.int32(), pa.binary(), pa.binary()))], names=["bucket", "names", "lengths"])


WINDOWS = "array<struct<window: binary, own: long, places: array<struct<number: int, start: int>>>>"
PIECES = f"part int, bucket int, groups binary, words binary, sizes binary, cuts binary, owners binary, numbers binary, starts binary, whole {WINDOWS}"
_PIECES = pa.schema(
    [
        ("part", pa.int32()),
        ("bucket", pa.int32()),
        *((n, pa.binary()) for n in ("groups", "words", "sizes", "cuts", "owners", "numbers", "starts")),
        ("whole", pa.list_(pa.struct([("window", pa.binary()), ("own", pa.int64()), ("places", pa.list_(pa.struct([("number", pa.int32()), ("start", pa.int32())])))]))),
    ]
)


def _gathered(raw: bytes, starts: np.ndarray, ends: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[bytes, np.ndarray]:
    """The words ``first`` to ``first + size`` of every piece, each with a space after it, and the bytes of a piece."""
    word = np.arange(int(size.sum())) + np.repeat(first - (np.cumsum(size) - size), size)
    long = ends[word] - starts[word] + 1
    edge = np.cumsum(long)
    data = np.frombuffer(raw + b" ", np.uint8)[np.arange(int(edge[-1])) + np.repeat(starts[word] - (edge - long), long)]
    data[edge - 1] = 32
    return data.tobytes(), np.diff(edge[np.cumsum(size) - 1], prepend=0)


def _cut_out(table: pa.Table, known: pa.Table, width: int, parts: int) -> pa.Table:
    """Words around shared cut points, by the part that sorts them, and windows that are prefixes themselves."""
    if not table.num_rows or not known.num_rows:
        return _PIECES.empty_table()
    texts, ids, _ = _texts(table)
    bucket = table["bucket"][0].as_py()
    name = np.frombuffer(b"".join(known["names"].to_pylist()), np.uint64)
    length = np.frombuffer(b"".join(known["lengths"].to_pylist()), np.int8)
    order = np.argsort(name)
    name, length = name[order], length[order]
    rows: dict[int, list[list[bytes]]] = {}
    whole: dict[bytes, list[tuple[int, int, int]]] = {}
    for raw, starts, ends, number, place in _chunks(texts, width):
        cut, first, count, own = cut_points(hashed(raw, starts, ends), number, width)
        at = np.minimum(np.searchsorted(name, own), len(name) - 1)
        by = np.where(name[at] == own, length[at], -1)
        for f, c in zip(first[by == 0].tolist(), count[by == 0].tolist()):
            for s in range(f, f + c):
                window = b" ".join([raw[a:b] for a, b in zip(starts[s : s + width].tolist(), ends[s : s + width].tolist())])
                whole.setdefault(hashlib.sha256(window).digest(), []).append((int(ids[number[s]]), int(number[s]), int(place[s])))
        keep = by > 0
        if not keep.any():
            continue
        cut, first, count, own, by = cut[keep], first[keep], count[keep], own[keep], by[keep]
        group = mix(np.where(by == GRAM, own >> np.uint64(32) << np.uint64(32), own) + by.astype(np.uint64))
        part = (group % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        cut, first, count, group, part = cut[order], first[order], count[order], group[order], part[order]
        size = count + width - 1
        data, long = _gathered(raw, starts, ends, first, size)
        edge = np.concatenate([[0], np.cumsum(long)])
        to, lo = np.unique(part, return_index=True)
        hi = np.append(lo[1:], len(part))
        columns = (group, None, size.astype(np.uint8), (cut - first).astype(np.uint8), ids[number[first]], number[first].astype("<u4"), place[first].astype("<u4"))
        for p, a, b in zip(to.tolist(), lo.tolist(), hi.tolist()):
            rows.setdefault(p, []).append([data[edge[a] : edge[b]] if c is None else c[a:b].tobytes() for c in columns])
    out = [[p for p in rows], [bucket] * len(rows), *([b"".join(x[k] for x in v) for v in rows.values()] for k in range(7)), [None] * len(rows)]
    if whole:  # a row of its own, which no part sorts
        listed = [{"window": w, "own": min(p[0] for p in places), "places": [{"number": p[1], "start": p[2]} for p in places]} for w, places in whole.items()]
        for column, value in zip(out, [-1 - bucket, bucket, *[None] * 7, listed]):
            column.append(value)
    return pa.table([pa.array(c, f.type) for c, f in zip(out, _PIECES)], schema=_PIECES)


class _Numbers(dict):
    """Word -> a number of its own."""

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self)
        return self[word]


def _common(sorted_rows: np.ndarray) -> np.ndarray:
    """How many leading values each row shares with the one before."""
    same = np.zeros((len(sorted_rows), sorted_rows.shape[1] + 1), bool)
    same[1:, :-1] = sorted_rows[1:] == sorted_rows[:-1]
    return same.argmin(axis=1)


def repeats(groups: np.ndarray, words: np.ndarray, sizes: np.ndarray, cuts: np.ndarray, owners: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, window in it) of windows that a smaller owner's piece of the same group has too.

    ``words`` are the pieces' words as numbers, one piece after the other; a piece has
    ``sizes`` words and its cut point is before word ``cuts``.
    """
    n, left = len(sizes), width - AFTER
    first = np.cumsum(sizes) - sizes
    after = np.arange(width)[None, :] + cuts[:, None]
    forward = np.where(after < sizes[:, None], words[np.minimum(first[:, None] + after, len(words) - 1)], -1)
    before = cuts[:, None] - 1 - np.arange(left)[None, :]
    backward = np.where(before >= 0, words[np.maximum(first[:, None] + before, 0)], -1)
    _, group = np.unique(groups, return_inverse=True)

    def ordered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort(keys.T[::-1])
        return order, _common(keys[order])

    # The subtrees: suffixes in order, with the depth at which each leaves the one before.
    order, depth = ordered(np.column_stack([group, forward]))
    order_b, depth_b = ordered(backward)
    node, node_b = np.empty(n, np.int64), np.empty(n, np.int64)
    piece, window = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    last = sizes - width
    for o in range(left + 1):
        node[order] = np.cumsum(depth < 1 + width - o)  # inner nodes as deep as the window reaches
        node_b[order_b] = np.cumsum(depth_b < o)
        own = np.flatnonzero((cuts >= o) & (cuts - o <= last))
        if not len(own):
            continue
        by = np.lexsort((owners[own], node_b[own], node[own]))
        a, b = node[own][by], node_b[own][by]
        new = np.ones(len(own), bool)
        new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        least = owners[own][by][new][np.cumsum(new) - 1]
        hit = own[by][owners[own][by] > least]
        piece.append(hit)
        window.append(cuts[hit] - o)
    return np.concatenate(piece), np.concatenate(window)


REMOVALS = "bucket int, numbers array<int>, starts array<int>, least long"


def _judge(table: pa.Table, width: int) -> pa.Table:
    """Windows to remove, by bucket, from the groups of a part."""

    def joined(column: str, kind: str) -> np.ndarray:
        return np.frombuffer(b"".join(table[column].to_pylist()), kind)

    if table["part"][0].as_py() < 0:
        return pa.table([pa.nulls(0, t) for t in (pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int64())], names=["bucket", "numbers", "starts", "least"])
    named = _Numbers()
    split_words = b"".join(table["words"].to_pylist()).split()
    words = np.fromiter(map(named.__getitem__, split_words), np.int64, len(split_words))
    del split_words, named
    sizes, cuts = joined("sizes", "u1").astype(np.int64), joined("cuts", "u1").astype(np.int64)
    piece, window = repeats(joined("groups", "<u8"), words, sizes, cuts, joined("owners", "<i8"), width)
    bucket = np.repeat(table["bucket"].to_numpy(), [len(x) for x in table["sizes"].to_pylist()])[piece]
    number, start = joined("numbers", "<u4")[piece].astype(np.int32), (joined("starts", "<u4")[piece] + window).astype(np.int32)
    order = np.lexsort((start, number, bucket))
    own, lo = np.unique(bucket[order], return_index=True)
    hi = np.append(lo[1:], len(order))
    lists = [pa.array([x[order][a:b] for a, b in zip(lo, hi)], pa.list_(pa.int32())) for x in (number, start)]
    return pa.table([pa.array(own, pa.int32()), *lists, pa.nulls(len(own), pa.int64())], names=["bucket", "numbers", "starts", "least"])


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows that are prefixes themselves."""
    for batch in batches:
        yield batch.filter(pc.is_valid(batch.column("whole"))).select(["bucket", "whole"])


def _apply(table: pa.Table, removals: pa.Table, width: int) -> pa.Table:
    """(id, n_words, kept, spans): one row for each row of a distinct text's smallest id."""
    texts, ids, times = _texts(table)
    owners, starts = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for number, start, least in zip(removals["numbers"].combine_chunks(), removals["starts"].combine_chunks(), removals["least"].to_pylist()):
        number, start = number.values.to_numpy().astype(np.int64), start.values.to_numpy().astype(np.int64)
        if least is not None:
            later = ids[number] > least
            number, start = number[later], start[later]
        owners.append(number)
        starts.append(start)
    owner, start = np.concatenate(owners), np.concatenate(starts)
    order = np.lexsort((start, owner))
    owner, start = owner[order], start[order]
    every = np.arange(len(texts))
    lo, hi = np.searchsorted(owner, every), np.searchsorted(owner, every, side="right")
    out = {k: [] for k in ("id", "n_words", "kept", "spans")}
    for text, id_, n, a, b in zip(texts, ids.tolist(), times.tolist(), lo.tolist(), hi.tolist()):
        words = text.split()
        spans, kept, size = [], words, len(words)
        if b > a:
            own = start[a:b]
            new = np.append(True, own[1:] > own[:-1] + width)
            left = own[new].tolist()
            right = (own[np.append(np.flatnonzero(new)[1:], len(own)) - 1] + width).tolist()
            spans = [{"start": x, "end": y} for x, y in zip(left, right)]
            kept = [w for x, y in zip([0, *right], [*left, size]) for w in words[x:y]]
        rest = b" ".join(kept)
        for _ in range(n):
            for k, v in (("id", id_), ("n_words", size), ("kept", rest), ("spans", spans)):
                out[k].append(v)
    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
    return pa.table([pa.array(v, t) for v, t in zip(out.values(), kinds)], names=list(out))


def remove_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 13, bucket_bytes: int = 4 << 20, group: int = GROUP) -> DataFrame:
    """(id, n_words, kept string, spans array<struct<start, end>>), one row per input row.

    Words are runs without ASCII white space.  A word goes if a window of ``width`` words
    around it also starts in a document with a smaller id; windows are judged on the input.
    ``kept`` joins the words that stay by one space; spans count words.  A null text has no
    words; texts with fewer words than a window stay whole.  A null id counts as larger than
    any other and stays null; ids are whole numbers, others raise.  Rows with one id are one
    document: they take nothing from each other.  Other columns are not carried.

    A text that occurs under several ids takes part once, with the smallest; under the
    others it goes whole.  Words over LONG bytes are compared by SHA-256, all others as they
    are.  A prefix costs eight bytes and a count from each bucket that has it, a window that
    over ``group`` documents share one row.
    """
    if width <= AFTER:
        raise ValueError(f"width must be over {AFTER}")
    rows = docs.select(F.coalesce(docs[id_column].cast("long"), F.lit(LAST)).alias("id"), F.coalesce(docs[text_column], F.lit("")).alias("text"))
    h1, h2 = F.xxhash64("text"), F.sha2("text", 256)
    words = F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))
    brief = F.when(words < width, F.col("text"))
    narrow = staged(rows.select("id", h2.alias("h"), F.octet_length("text").cast("long").alias("n"), words.cast("long").alias("n_words"), brief.alias("brief")), "texts")
    total = narrow.agg(F.sum("n")).first()[0] or 0
    buckets = max(-(-total // bucket_bytes), 2 * shuffle_tasks(docs))
    bits = max(8, int(max(total >> 22, 1)).bit_length())
    parts = max(-(-total // (2 << 20)), 2 * shuffle_tasks(docs))
    tasks = max(shuffle_tasks(docs), -(-total // (64 << 20)))

    bucketed = rows.select(F.pmod(h1, F.lit(buckets)).cast("int").alias("bucket"), "id", F.col("text").cast("binary").alias("text"))
    dealt = _dealt(bucketed).repartition(tasks, "bucket")
    names = dealt.groupBy("bucket").applyInArrow(lambda t: _names(t, width, bits), "part int, bucket int, names binary, held binary")
    known = names.groupBy("part").applyInArrow(lambda t: _split_part(t, group), "bucket int, names binary, lengths binary")
    cut = dealt.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(lambda t, k: _cut_out(t, k, width, parts), PIECES)
    cut = cut.repartition(tasks, "part")  # computed once for the three that read it
    judged = cut.groupBy("part").applyInArrow(lambda t: _judge(t, width), REMOVALS)
    own = cut.mapInArrow(_whole, f"bucket int, whole {WINDOWS}").select("bucket", F.inline("whole"))
    least = own.groupBy("window").agg(F.min("own").alias("least"))
    nodes = own.join(least, "window").select("bucket", F.col("places.number").alias("numbers"), F.col("places.start").alias("starts"), "least")
    removals = judged.union(nodes)
    first = dealt.groupBy("bucket").cogroup(removals.groupBy("bucket")).applyInArrow(lambda t, r: _apply(t, r, width), "id long, n_words long, kept binary, spans array<struct<start: long, end: long>>")

    least_id = narrow.groupBy("h").agg(F.min("id").alias("rep"))
    copies = narrow.join(least_id, "h").where("id > rep")
    span = F.when(F.col("n_words") >= width, F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("n_words").alias("end"))))
    rest = F.array_join(F.regexp_extract_all(F.coalesce("brief", F.lit("")), F.lit(r"([^\x20\x09-\x0D]+)")), " ")
    copies = copies.select("id", "n_words", rest.cast("binary").alias("kept"), F.coalesce(span, F.array().cast("array<struct<start: bigint, end: bigint>>")).alias("spans"))
    out = first.union(copies)
    return out.select(F.when(F.col("id") != LAST, F.col("id")).alias(id_column), "n_words", F.col("kept").cast("string").alias("kept"), "spans")
