"""Near-duplicates by min-max hashing.

Each permutation of the shingle space gives two signature values, its minimum and its
maximum over a document's shingles, so n values cost n / 2 hash evaluations.  Bands of
the minima and maxima of two permutations find candidates, the whole signature drops
hopeless ones, and full shingle sets confirm the rest.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.llm.common import Trees, components, forget, merged, mix, once, same, slices, staged

#: Permutations of the signature, and of the finer one for documents that have candidates.
PERMUTATIONS = 96
FINE = 256
#: Bands of ROWS minima and as many maxima of the same permutations: sets of similarity 0.8 meet with probability 0.9999.
BANDS = 18
ROWS = 2
_seed = np.random.default_rng(20240501)
FACTORS = (_seed.integers(0, 1 << 32, FINE, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
SHIFTS = _seed.integers(0, 1 << 32, FINE, dtype=np.uint64).astype(np.uint32)
REMEMBERED = 200_000
#: Buckets of up to so many sets compare every pair; larger ones go by pivots.
SMALL = 8
PIVOT_ROUNDS = 4
#: Rows of a bucket that are compared with as many others in one step.
BLOCK = 256


class _Words(dict):
    """Word -> 64-bit hash."""

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(self) >= REMEMBERED:
            self.clear()
        if len(word) <= 64:
            self[word] = value
        return value


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles of ``text``.

    Words are runs without ASCII white space, A-Z lower-cased.  Fewer words than ``width``
    make one shingle; no word makes none.
    """
    words = text.encode().lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(once("words", _Words).__getitem__, words), np.uint64, len(words))
    if len(w) < width:
        return np.array([xxhash.xxh3_64_intdigest(w.tobytes(), seed=len(w))], np.uint64)
    n = len(w) - width + 1
    h = mix(w[:n])
    for k in range(1, width):
        h = mix(h + w[k : k + n])
    return np.unique(h)


def signature(h: np.ndarray, n: int = PERMUTATIONS) -> tuple[np.ndarray, np.ndarray]:
    """Minima and maxima of the shingles under ``n`` permutations, chunk by chunk."""
    low, high = np.full(n, 0xFFFFFFFF, np.uint32), np.zeros(n, np.uint32)
    base = (h >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(base), 2048):
        v = FACTORS[:n, None] * base[None, at : at + 2048] + SHIFTS[:n, None]
        np.minimum(low, v.min(axis=1), out=low)
        np.maximum(high, v.max(axis=1), out=high)
    return low, high


def band_keys(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """One key per band, from both ends of ROWS permutations."""
    used = BANDS * ROWS
    key = np.arange(BANDS, dtype=np.uint64)
    for values in (low[:used], high[:used]):
        for r in range(ROWS):
            key = mix(key + values.reshape(BANDS, ROWS)[:, r].astype(np.uint64) + np.uint64(1))
    return key.view(np.int64)


def sketch(low: np.ndarray, high: np.ndarray) -> bytes:
    """A byte of each signature value."""
    return mix(np.concatenate([low, high]).astype(np.uint64)).astype(np.uint8).tobytes()


def enough(values: int, least: float) -> float:
    """The share of equal bytes that sets of similarity ``least`` fall under once in 30,000 times."""
    share = least - 4 * np.sqrt(least * (1 - least) / values)
    return share + (1 - share) / 256


def _signed(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches, "text", 4 << 20):
            n, first, second, bands, sketches = [], [], [], [], []
            for text in batch.column(1).to_pylist():
                h = shingles(text, width)
                n.append(len(h))
                if len(h):
                    digest = xxhash.xxh3_128_intdigest(h.tobytes())
                    low, high = signature(h)
                    first.append((digest >> 64) - (1 << 63))
                    second.append((digest & (1 << 64) - 1) - (1 << 63))
                    bands.append(band_keys(low, high))
                    sketches.append(sketch(low, high))
                else:
                    first.append(None)
                    second.append(None)
                    bands.append(None)
                    sketches.append(None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                ["id", "n", "d1", "d2", "bands", "sketch"],
            )

    return docs.mapInArrow(run, "id long, n long, d1 long, d2 long, bands array<long>, sketch binary")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """(id, s, fine): full sets and fine sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", 4 << 20):
            sets = [shingles(t, width) for t in batch.column(1).to_pylist()]
            fine = [sketch(*signature(h, FINE)) for h in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([h.tobytes() for h in sets], pa.binary()), pa.array(fine, pa.binary())], ["id", "s", "fine"])

    return docs.mapInArrow(run, "id long, s binary, fine binary")


def _alike(pairs: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b, s, t) of sketches that may have a similarity of ``least``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s, t = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
                kept = pa.array((s == t).mean(axis=1) >= enough(s.shape[1], least))
                yield pa.RecordBatch.from_arrays([batch.column(i).filter(kept) for i in (0, 1)], ["a", "b"])

    return pairs.select("a", "b", "s", "t").mapInArrow(run, "a long, b long")


def _across(blocks: DataFrame, per_cent: int) -> DataFrame:
    """Links (a, b) between components, from rows of two blocks (h, x, y) of one bucket.

    A block lists (id, c, n, bands, fine, s, main).  Two sets are compared in the first bucket
    that holds both, once; sketches come first, full sets decide, and of the links found a
    spanning forest of the components is returned, so the rows stay few in a dense group.
    """
    least = per_cent / 100

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def side(cell: pa.Scalar):
            own = cell.values
            fine = np.frombuffer(b"".join(own.field("fine").to_pylist()), np.uint8).reshape(len(own), -1)
            bands = own.field("bands").flatten().to_numpy().reshape(len(own), -1)
            return *(own.field(k).to_numpy(zero_copy_only=False) for k in ("id", "c", "n", "main")), bands, fine, own.field("s")

        for batch in batches:
            for h, x, y in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                (i, c, n, _, p, f, s), (j, d, m, main, q, g, t) = side(x), side(y)
                need = enough(f.shape[1], least)
                joined = Trees()
                a, b = [], []
                for k in range(len(i)):
                    near = (d != c[k]) & (np.minimum(n[k], m) >= least * np.maximum(n[k], m) * (1 - 1e-9)) & (main | (i[k] < j))
                    at = np.flatnonzero(near)
                    if not len(at):
                        continue
                    meet = q[at] == p[k]
                    at = at[p[k][meet.argmax(axis=1)] == h]
                    at = at[(g[at] == f[k]).mean(axis=1) >= need]
                    for o in at.tolist():
                        if not joined.same(int(c[k]), int(d[o])) and linked(s[k].as_buffer(), t[o].as_buffer(), per_cent):
                            joined.join(int(c[k]), int(d[o]))
                            a.append(i[k])
                            b.append(j[o])
                yield pa.RecordBatch.from_arrays([pa.array(np.array(a, np.int64)), pa.array(np.array(b, np.int64))], ["a", "b"])

    return blocks.select("h", "x", "y").mapInArrow(run, "a long, b long")


def linked(s, t, per_cent: int) -> bool:
    """100 * intersection >= per_cent * union of two sorted sets of 64-bit hashes."""
    both = np.concatenate([np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= per_cent * (len(both) - common)


def _confirmed(pairs: DataFrame, per_cent: int) -> DataFrame:
    """Pairs (a, b, s, t) of full sets with 100 * intersection >= per_cent * union."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [linked(s.as_buffer(), t.as_buffer(), per_cent) for s, t in zip(batch.column(2), batch.column(3))]
            kept = pa.array(kept, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(kept) for i in (0, 1)], ["a", "b"])

    return pairs.select("a", "b", "s", "t").mapInArrow(run, "a long, b long")


def _with_both(pairs: DataFrame, table: DataFrame, value: str) -> DataFrame:
    """Pairs (a, b) with the values of both ids as s and t."""
    one = table.select(F.col("id").alias("b"), F.col(value).alias("t"))
    two = table.select(F.col("id").alias("a"), F.col(value).alias("s"))
    return pairs.join(one, "b").join(two, "a")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = 5, per_cent: int = 80) -> DataFrame:
    """(id, n_shingles, component_id, kept), one row per input row.

    Documents link where 100 * intersection >= per_cent * union of their shingle sets.  Equal
    sets link without comparison and go on as one.  Texts without words and null ids link
    with nothing; a null id is kept and has no component.  Rows that share an id are one
    document.  Other columns are not carried.

    A band bucket of at most SMALL sets compares all its pairs.  A larger one compares its
    sets with a pivot, in each round another one, as long as it holds sets of different
    components.  Once most of them are in the largest component of their bucket, or after
    the last round, the sketches of the others are compared with the whole bucket, block by
    block, so no link depends on the choice of pivots and no task holds a whole bucket.
    """
    rows = docs.select(docs[id_column].cast("long").alias("id"), docs[text_column].alias("text"))
    least = per_cent / 100
    signed = staged(_signed(rows, width), "signed")
    real = signed.where("n > 0 AND id IS NOT NULL")
    groups = staged(real.groupBy("d1", "d2").agg(F.min("id").alias("rep")), "sets")
    reps = real.join(groups.withColumnsRenamed({"d1": "g1", "d2": "g2"}), (F.col("id") == F.col("rep")) & (F.col("d1") == F.col("g1")) & (F.col("d2") == F.col("g2")))
    reps = reps.select("id", "n", "bands", "sketch")

    keyed = reps.select("id", "n", F.explode("bands").alias("h"))
    sizes = keyed.groupBy("h").agg(F.count("*").alias("size"), F.min("id").alias("low"), F.max("id").alias("top"), F.min(F.struct("id", "n")).getField("n").alias("low_n"))
    buckets = staged(keyed.join(sizes.where("low < top"), "h").select("h", "id", "n", "size", "low", "low_n"), "buckets")
    involved = buckets.select("id").distinct()
    sketches = staged(reps.join(involved, "id").select("id", "sketch"), "sketches")

    def fits(n, m):
        return F.least(n, m) * 100 >= F.greatest(n, m) * per_cent

    small = buckets.where(F.col("size") <= SMALL).select("h", "id", "n")
    other = small.select("h", F.col("id").alias("b"), F.col("n").alias("m"))
    every = small.join(other, "h").where((F.col("id") < F.col("b")) & fits(F.col("n"), F.col("m"))).select(F.col("id").alias("a"), "b")
    star = buckets.where((F.col("size") > SMALL) & (F.col("id") != F.col("low")) & fits(F.col("n"), F.col("low_n")))
    pairs = every.union(star.select(F.col("low").alias("a"), F.col("id").alias("b"))).distinct()
    candidates = staged(_alike(_with_both(pairs, sketches, "sketch"), least), "candidates")
    large = staged(buckets.where(F.col("size") > SMALL).select("h", "id", "n"), "large")
    wanted = candidates.select(F.col("a").alias("id")).union(candidates.select("b")).union(large.select("id")).distinct()
    # The plan is the same at every size: texts go by id, whatever the number of wanted ids.
    chosen = rows.join(wanted.hint("merge"), "id", "left_semi")
    sets = staged(_sets(chosen, width), "shingles")
    edges = staged(_confirmed(_with_both(candidates, sets, "s"), per_cent), "edges")
    classes = staged(components(edges), "classes")

    for turn in range(PIVOT_ROUNDS + 1):
        placed = large.join(classes, "id", "left").select("h", "id", "n", F.coalesce("component", "id").alias("c"))
        counts = placed.groupBy("h", "c").agg(F.count("*").alias("k"), F.min_by(F.struct("id", "n"), F.xxhash64("id", "h", F.lit(turn))).alias("one"))
        pivot = F.min_by(F.struct("one.id", "c", "one.n"), F.xxhash64("one.id", "h", F.lit(turn)))
        mixed = counts.groupBy("h").agg(F.count("*").alias("classes"), F.sum("k").alias("rows"), F.max(F.struct("k", "c")).alias("largest"), pivot.alias("pivot"))
        mixed = mixed.where("classes > 1").select("h", "rows", "pivot", F.col("largest.c").alias("main"), (F.col("rows") - F.col("largest.k")).alias("rest"))
        mixed = staged(mixed, "mixed")
        work = mixed.agg(F.sum("rest").alias("rest"), F.sum("rows").alias("rows")).first()
        if not work["rows"]:
            break
        last = turn == PIVOT_ROUNDS or 2 * work["rest"] <= work["rows"]
        if last:
            left = placed.join(mixed.select("h", "main", "rows"), "h").withColumn("main", F.col("c") == F.col("main"))
            left = left.join(reps.select("id", "bands"), "id").join(sets.select("id", "fine", "s"), "id")
            member = F.struct("id", "c", "n", "main", "bands", "fine", "s").alias("one")

            def blocks(members: DataFrame, name: str) -> DataFrame:
                number = F.pmod(F.xxhash64("id"), F.ceil(F.col("rows") / BLOCK)).alias("block")
                return members.select("h", number, member).groupBy("h", "block").agg(F.collect_list("one").alias(name)).select("h", name)

            new = _across(blocks(left.where(~F.col("main")), "x").join(blocks(left, "y"), "h"), per_cent)
        else:
            met = placed.join(mixed, "h").where((F.col("c") != F.col("pivot.c")) & fits(F.col("n"), F.col("pivot.n")))
            pairs = met.select(F.least("id", "pivot.id").alias("a"), F.greatest("id", "pivot.id").alias("b"))
            more = staged(_alike(_with_both(pairs.distinct(), sets, "fine"), least), "candidates")
            new = _confirmed(_with_both(more, sets, "s"), per_cent)
        new = staged(new, "edges")
        if not new.isEmpty():
            classes = merged(classes, new)
        if last:
            break

    whole = signed.select("id", "n", "d1", "d2").join(groups, ["d1", "d2"], "left")
    whole = whole.join(classes.withColumnRenamed("id", "rep"), "rep", "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component", "rep", "id"))
    return whole.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(same(F.col("id"), component), F.lit(True)).alias("kept"))
