"""Grouping of spelling variants by reduced-alphabet neighbourhoods.

Letters are hashed to a few symbols.  Every word generates all one-edit neighbours of its
reduced form, which are few because the alphabet is small, and meets the words whose
reduced form is one of them; one edit of the word is at most one edit of its reduced form.
An edit leaves one half of a word as it is, so a neighbour also carries the letters of the
half that its edit cannot touch, and words that only look alike when reduced rarely meet.  What meets is verified on the words themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.llm.common import mix, staged

#: Symbols of the reduced alphabet.
SYMBOLS = 3
#: Values of a step's arrays.
STEP = 1 << 21
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_factor = 0x5851F42D4C957F2D
_back = np.uint64(pow(_factor, -1, 1 << 64))


def vocabulary(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", letters: int = 7, least: int = 2, spoil: int = 31) -> DataFrame:
    """(word, n) of the words of ``letters`` code points or more with at least ``least`` occurrences.

    Runs of Latin letters are lower-cased (A-Z only).  Where ``spoil`` divides the CRC-32 of
    "id:run", the code point at its remainder by the run's length is left out.  A null text
    has no words, a null id counts as an empty one.
    """
    run = F.explode(F.regexp_extract_all(docs[text_column], F.lit(f"[A-Za-zÀ-ÿ]{{{letters},}}"), F.lit(0)))
    runs = docs.select(F.coalesce(docs[id_column].cast("string"), F.lit("")).alias("id"), run.alias("run"))
    runs = runs.select("id", F.translate("run", UPPER, LOWER).alias("run"))
    h, size = F.col("h"), F.length("run")
    at = F.pmod(h, size.cast("long")).cast("int")
    short = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, size))
    words = runs.withColumn("h", F.crc32(F.concat_ws(":", "id", "run").cast("binary")))
    words = words.select(F.when(F.pmod(h, F.lit(spoil)) == 0, short).otherwise(F.col("run")).alias("word")).where(F.length("word") >= letters)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def reduced(points: np.ndarray) -> np.ndarray:
    """A symbol from 1 to SYMBOLS for each code point."""
    return (mix(points.astype(np.uint64)) >> np.uint64(40)) % np.uint64(SYMBOLS) + np.uint64(1)


def _sealed(value: np.ndarray, length: int, half: np.ndarray, last: bool) -> np.ndarray:
    """Join keys of reduced forms (a row for each word) with a half; the low bit tells which one."""
    key = mix(mix(value + np.uint64(length)) + half[:, None])
    return key & ~np.uint64(1) | np.uint64(last)


def _halves(points: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first and of the last ``size`` letters."""
    out = []
    for part in (points[:, :size], points[:, -size:]):
        h = np.zeros(len(part), np.uint64)
        for k in range(size):
            h = mix(h + part[:, k].astype(np.uint64) + np.uint64(1))
        out.append(h)
    return out[0], out[1]


def _powers(n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n + 1, _factor, np.uint64))])


def own_keys(points: np.ndarray) -> np.ndarray:
    """The keys of each word of one length (a row of code points each): halves as long as a word of any near length has."""
    c = reduced(points)
    n = c.shape[1]
    value = (c * _powers(n)[:n]).sum(axis=1, dtype=np.uint64)[:, None]
    keys = []
    for size in sorted({(n - 1) // 2, n // 2}):
        first, last = _halves(points, size)
        keys += [_sealed(value, n, first, False), _sealed(value, n, last, True)]
    return np.concatenate(keys, axis=1)


def neighbour_keys(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place of the word, key) of all reduced forms within one edit of the words of one length.

    Edits that come to the same form are made once, at the first place they can be.  In the
    second half they leave the first half, else the last one; a run of one symbol that reaches
    over the border leaves it open where the edit was, so both keys are made.  A half is half
    of the shorter word.
    """
    c = reduced(points)
    m, n = c.shape
    power = _powers(n)
    terms = c * power[:n]
    before = np.concatenate([np.zeros((m, 1), np.uint64), np.cumsum(terms, axis=1)], axis=1)
    total = before[:, -1:]
    places, keys = [], []

    def add(value: np.ndarray, length: int, wanted: np.ndarray, late: bool) -> None:
        key = _sealed(value, length, halves[min(n, length) // 2][late], late)
        places.append(np.nonzero(wanted)[0])
        keys.append(key[wanted])

    halves = {size: _halves(points, size) for size in {(n - 1) // 2, n // 2}}
    every = np.ones((m, 1), bool)
    add(total, n, every, False)
    add(total, n, every, True)
    # A symbol left out: the first of its run.
    value = before[:, :-1] + (total - before[:, 1:]) * _back
    new = np.ones((m, n), bool)
    new[:, 1:] = c[:, 1:] != c[:, :-1]
    half = (n - 1) // 2
    add(value[:, half:], n - 1, new[:, half:], False)
    add(value[:, :half], n - 1, new[:, :half], True)
    over = np.logical_and.accumulate(c[:, half - 1 :: -1] == c[:, half : half + 1], axis=1)[:, ::-1]
    add(value[:, :half], n - 1, new[:, :half] & over, False)
    half = n // 2
    for s in range(1, SYMBOLS + 1):
        symbol = np.uint64(s)
        # Another symbol in its place.
        value = total + (symbol - c) * power[:n]
        other = c != symbol
        add(value[:, half:], n, other[:, half:], False)
        add(value[:, :half], n, other[:, :half], True)
        # One more symbol: in front of a run of its own.
        value = before + symbol * power[: n + 1] + (total - before) * np.uint64(_factor)
        new = np.ones((m, n + 1), bool)
        new[:, 1:] = other
        add(value[:, half:], n + 1, new[:, half:], False)
        add(value[:, :half], n + 1, new[:, :half], True)
        over = np.logical_and.accumulate(c[:, half - 1 :: -1] == symbol, axis=1)[:, ::-1]
        add(value[:, :half], n + 1, new[:, :half] & over, False)
    return np.concatenate(places), np.concatenate(keys)


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, code points) of the words of each length, in steps of bounded size."""
    texts = words.to_pylist()
    lengths = np.array([len(t) for t in texts])
    for n in np.unique(lengths):
        own = np.flatnonzero(lengths == n)
        step = max(1, STEP // (int(n) * (2 * SYMBOLS + 2)))
        for at in range(0, len(own), step):
            some = own[at : at + step]
            raw = "".join([texts[k] for k in some.tolist()]).encode("utf-32-le")
            yield some, np.frombuffer(raw, "<u4").reshape(len(some), int(n))


def _keyed(words: DataFrame, neighbours: bool) -> DataFrame:
    """``words`` (word, ...) once for each of its keys, with the key."""
    names = words.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, points in _by_length(batch.column(0)):
                if neighbours:
                    place, key = neighbour_keys(points)
                else:
                    key = own_keys(points).ravel()
                    place = np.repeat(np.arange(len(some)), len(key) // len(some))
                rows = batch.take(pa.array(some[place]))
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), *rows.columns], ["key", *names])

    schema = ", ".join(["key long", *(f"{f.name} {f.dataType.simpleString()}" for f in words.schema)])
    return words.mapInArrow(run, schema)


def near_words(words: DataFrame) -> DataFrame:
    """(word, near, n) for ``words`` (word, n): all pairs one inserted, deleted or replaced code point apart, both ways.

    Words are distinct and have at least 3 code points.
    """
    left = _keyed(words.select("word"), True)
    right = _keyed(words.select(F.col("word").alias("near"), "n"), False)
    met = left.join(right, "key")
    half = F.floor(F.least(F.length("word"), F.length("near")) / 2).cast("int")
    starts = F.substring("word", F.lit(1), half) != F.substring("near", F.lit(1), half)
    once = (F.col("key").bitwiseAND(F.lit(1).cast("long")) == 0) | starts
    return met.where(once & (F.levenshtein("word", "near", 1) == 1)).select("word", "near", "n")


def variants(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word of ``vocabulary``.

    The form of a word is its near word of the largest n (ties: the smallest in code-point
    order) if that n is at least ``ratio`` times its own, else null; the root is where the
    forms lead.  n grows with every form, so there are no cycles and few steps.  Repeated
    rows count as often as they are there; other columns are not looked at.
    """
    words = staged(vocabulary(docs, id_column, text_column), "words")
    best = F.min(F.struct((-F.col("n")).alias("less"), "near"))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    whole = words.join(near.withColumnRenamed("word", "own"), F.col("word") == F.col("own"), "left")
    form_n = -F.col("best.less")
    formed = form_n >= ratio * F.col("n")
    whole = whole.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.near")).alias("form"), F.when(formed, form_n).alias("form_n"))
    whole = staged(whole, "forms")
    leads = whole.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:  # each round doubles the steps taken
        on = leads.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = staged(leads.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        leads = further.select("word", "root")
        if further.where("moved").isEmpty():
            break
    ends = leads.select(F.col("word").alias("own"), F.col("root").alias("end"))
    return whole.join(ends, F.col("word") == F.col("own"), "left").select("word", "form", F.coalesce("end", "word").alias("root"), "n", "n_near", "form_n")
