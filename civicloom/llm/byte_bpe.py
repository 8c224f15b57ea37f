"""Byte-level BPE: encode texts by a rank file, decode the ids.

Merges run on a hierarchical-bitmap rank queue: one bucket per merge rank holds the
positions in a linked list of tokens where that merge may apply; two levels of bitmaps
say which buckets hold anything, find-first-set picks the next rank, and entries that
an earlier merge has made stale are skipped.  A pre-token of n bytes costs O(n log n)
at worst, so a run of a million equal characters is no special case.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from heapq import heappop, heappush
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from civicloom.llm.common import once, slices

#: Pre-tokens of up to so many characters are remembered, and so many of them in each of two generations.
REMEMBERED_CHARS = 48
REMEMBERED = 300_000
#: Texts are split in one call up to so many characters, by an iterator beyond.
AT_ONCE = 1 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes -> rank, of a rank file (base64 token and rank on each line)."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def merge(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token."""
    whole = ranks.get(piece)
    if whole is not None:
        return [whole]
    n, get = len(piece), ranks.get
    after = list(range(1, n + 1))  # start of the next token, which is this one's end
    before = list(range(-1, n - 1))
    rank_at = [-1] * n  # rank of the pair that starts here, -1: none or merged away
    buckets: dict[int, list[int]] = {}
    leaves: dict[int, int] = {}
    top = 0
    for i in range(n - 1):
        rank = get(piece[i : i + 2])
        if rank is not None:
            rank_at[i] = rank
            if rank in buckets:
                buckets[rank].append(i)
            else:
                buckets[rank] = [i]
                leaves[rank >> 8] = leaves.get(rank >> 8, 0) | 1 << (rank & 255)
                top |= 1 << (rank >> 8)
    while top:
        high = (top & -top).bit_length() - 1
        leaf = leaves[high]
        rank = high << 8 | ((leaf & -leaf).bit_length() - 1)
        bucket = buckets[rank]
        i = heappop(bucket)  # the leftmost position goes first
        if not bucket:
            del buckets[rank]
            leaves[high] = leaf = leaf & (leaf - 1)
            if not leaf:
                top &= top - 1
        if rank_at[i] != rank:
            continue
        gone = after[i]
        end = after[i] = after[gone]
        rank_at[gone] = rank_at[i] = -1
        changed = []
        if end < n:
            before[end] = i
            changed.append((i, after[end]))
        if i:
            changed.append((before[i], end))
        for start, stop in changed:
            new = get(piece[start:stop])
            rank_at[start] = -1 if new is None else new
            if new is not None:
                if new in buckets:
                    heappush(buckets[new], start)
                else:
                    buckets[new] = [start]
                    leaves[new >> 8] = leaves.get(new >> 8, 0) | 1 << (new & 255)
                    top |= 1 << (new >> 8)
    ids, i = [], 0
    while i < n:
        ids.append(ranks[piece[i : after[i]]])
        i = after[i]
    return ids


class _Pieces(dict):
    """Pre-token -> its ids as little-endian unsigned 32-bit integers.

    A full memory becomes the older generation, from which pre-tokens met again come
    back, so the frequent ones are never merged anew.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        ids = self.older.get(piece)
        if ids is None:
            ids = array("I", merge(piece.encode(), self.ranks)).tobytes()
        if len(piece) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Encoder:
    """Text -> ids as bytes; each match of ``pattern`` is merged on its own."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        # White space as Unicode has it; the control characters 1C-1F are none.
        pattern = pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}")
        self.split = regex.compile(pattern.replace(r"\S", r"\P{White_Space}"))
        self.pieces = _Pieces(ranks)

    def __call__(self, text: str) -> bytes:
        ids = self.pieces.__getitem__
        if len(text) <= AT_ONCE:
            return b"".join(map(ids, self.split.findall(text)))
        found = (m.group() for m in self.split.finditer(text))
        out = bytearray()
        while part := list(islice(found, 1 << 16)):
            out += b"".join(map(ids, part))
        return bytes(out)


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ids): ``ids`` binary, little-endian unsigned 32-bit; one row per input row.

    A null or empty text gives no ids.  The rank table is the only broadcast; its size is
    that of the vocabulary file.  Other columns of ``docs`` are not carried.
    """
    shared, name = docs.sparkSession.sparkContext.broadcast((ranks, pattern)), hashlib.sha256(b" ".join([*ranks, pattern.encode()])).hexdigest()
    kind = docs.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = once(name, lambda: Encoder(*shared.value))
        for batch in slices(batches, "text"):
            ids = [encoder(text) if text else b"" for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], ["id", "ids"])

    narrow = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    return narrow.mapInArrow(run, f"id {kind}, ids binary").withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, ranks: dict[bytes, int], id_column: str = "doc_id", ids_column: str = "ids") -> DataFrame:
    """(id, decoded): the bytes that the ids stand for, one row per input row; null ids give no bytes."""
    tokens = [b""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        tokens[rank] = token
    shared = encoded.sparkSession.sparkContext.broadcast(tokens)
    kind = encoded.schema[id_column].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = shared.value.__getitem__
        for batch in slices(batches, "ids"):
            out = [b"".join(map(token, array("I", ids))) if ids else b"" for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], ["id", "ids", "decoded"])

    narrow = encoded.select(encoded[id_column].alias("id"), encoded[ids_column].alias("ids"))
    return narrow.mapInArrow(run, f"id {kind}, ids binary, decoded binary").withColumnRenamed("id", id_column)
