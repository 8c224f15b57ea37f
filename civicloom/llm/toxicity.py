"""Toxicity by a classifier chain.

Categories are predicted one after the other by linear models; each later model also
sees the probabilities of the earlier ones.  For training these come from models that
have not seen the row (out of fold), for prediction from the models fitted on all folds.
The labels know one category, ``toxic``, which comes last; the earlier ones are groups of
toxic rows that share their features, found among the training rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civicloom.llm.common import forget, slices, staged

FINAL = "toxic"
#: Groups of toxic rows that come before it.
GROUPS = 2
PREFIXES = (4, 5, 6)
WORD = re.compile(r"[^\W\d_]+")
REMEMBERED = 200_000
#: Features of a chain, and the labelled rows that must hold one.
MOST_FEATURES = 4096
GROUPED_BY = 1024
LEAST_ROWS = 3


def cut(word: str) -> list[int]:
    """Features of a word, as 32-bit hashes: itself and its beginnings, so that endings do not hide a stem."""
    return [crc32(f.encode()) for f in ("=" + word, *(word[:n] for n in PREFIXES if len(word) >= n))]


def example(words: set[str]) -> np.ndarray:
    """Features of a row."""
    return np.array(sorted({f for w in words for f in cut(w)}), np.uint32)


def grouped(rows: list[np.ndarray], toxic: np.ndarray, n: int, k: int = GROUPS, rounds: int = 25) -> np.ndarray:
    """(row, group): to which of ``k`` groups a toxic row belongs, by the cosine of its features with their mean.

    ``rows`` are places of features under ``n``.  The GROUPED_BY features that tell most
    count, each by how much more often toxic rows have it.  The first mean is the row nearest to all, the next the row that
    is farthest from those before, so the groups depend on the rows alone; no row
    belongs to a group where there are fewer toxic rows than two a group.
    """
    out = np.zeros((len(rows), k), bool)
    own = np.flatnonzero(toxic)
    if len(own) < 2 * k or not n:
        return out
    flat = np.concatenate([rows[i] for i in own])
    held = np.repeat(np.arange(len(own)), [len(rows[i]) for i in own])
    clean = [rows[i] for i in np.flatnonzero(~toxic)]
    other = np.bincount(np.concatenate([*clean, np.zeros(0, np.int64)]).astype(np.int64), minlength=n)
    share = (np.bincount(flat, minlength=n) + 0.5) / (len(own) + 1)
    weight = np.maximum(np.log(share) - np.log((other + 0.5) / (len(clean) + 1)), 0.0)
    best = np.argsort(-weight * np.sqrt(share), kind="stable")[:GROUPED_BY]
    column = np.full(n, -1)
    column[best] = np.arange(len(best))
    held, flat = held[column[flat] >= 0], flat[column[flat] >= 0]
    x = np.zeros((len(own), len(best)), np.float32)
    x[held, column[flat]] = weight[flat]
    size = np.linalg.norm(x, axis=1, keepdims=True)
    x = np.divide(x, size, out=x, where=size > 0)
    chosen = [int(np.argmax(x @ x.mean(axis=0)))]
    while len(chosen) < k:
        chosen.append(int(np.argmin((x @ x[chosen].T).max(axis=1))))
    means = x[chosen]
    for _ in range(rounds):
        group = np.argmax(x @ means.T, axis=1)
        new = np.array([x[group == g].mean(axis=0) if (group == g).any() else means[g] for g in range(k)])
        new /= np.maximum(np.linalg.norm(new, axis=1, keepdims=True), 1e-12)
        if np.allclose(new, means, atol=1e-6):
            break
        means = new
    out[own, group] = True
    return out


@dataclass(frozen=True)
class Chain:
    """``features`` gives each feature its place; row i of ``weights`` is category i: features, earlier probabilities, bias."""

    names: tuple[str, ...]
    features: dict[int, int]
    weights: list[np.ndarray]
    threshold: float

    def probabilities(self, rows: list[np.ndarray]) -> np.ndarray:
        n = len(self.features)
        out = np.zeros((len(rows), len(self.names)))
        lengths = np.array([len(r) for r in rows])
        flat = np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
        owner = np.repeat(np.arange(len(rows)), lengths)
        for i, w in enumerate(self.weights):
            score = np.bincount(owner, w[flat], len(rows)) + w[-1]
            score += out[:, :i] @ w[n : n + i]
            out[:, i] = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
        return out


def _fit(flat: np.ndarray, owner: np.ndarray, extra: np.ndarray, y: np.ndarray, n: int, ridge: float, rounds: int = 80) -> np.ndarray:
    """Logistic regression on binary features plus dense ``extra`` columns, by accelerated gradient steps."""
    m, k = len(y), extra.shape[1]
    held = np.bincount(flat, minlength=n).astype(float)
    size = np.concatenate([held, (extra**2).sum(0), [m]])
    per_row = np.bincount(owner, minlength=m).max(initial=0) + k + 1
    step = 1.0 / (0.25 * np.minimum(size * np.sqrt(per_row), size.sum()) + ridge)
    w, v, t = np.zeros(n + k + 1), np.zeros(n + k + 1), 1.0
    base = np.log((y.sum() + 0.5) / (m - y.sum() + 0.5))
    w[-1] = v[-1] = base
    for _ in range(rounds):
        score = np.bincount(owner, v[flat], m) + extra @ v[n : n + k] + v[-1]
        gap = 1 / (1 + np.exp(-np.clip(score, -30, 30))) - y
        grad = np.concatenate([np.bincount(flat, gap[owner], n), extra.T @ gap, [gap.sum()]]) + ridge * v * np.append(np.ones(n + k), 0)
        new = v - step * grad
        if ((v - new) * (new - w)).sum() > 0:  # overshot: start the momentum anew
            t = 1.0
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v = new + (t - 1) / after * (new - w)
        w, t = new, after
    return w


def fit(rows: list[tuple[np.ndarray, bool]], groups: int = GROUPS, folds: int = 3, most_features: int = MOST_FEATURES, least_rows: int = LEAST_ROWS, ridge: float = 1.0) -> Chain:
    """The chain from rows (features, toxic); row i is in fold i mod ``folds``.

    Features are those in ``least_rows`` rows or more whose share differs most between
    toxic and other rows.  The threshold on the last probability is the one that makes the
    fewest out-of-fold errors.  Without rows of both labels nothing is toxic.
    """
    names = (*(f"group_{g + 1}" for g in range(groups)), FINAL)
    y = np.array([t for _, t in rows], float)
    if not len(rows) or not 0 < y.sum() < len(y):
        return Chain(names, {}, [np.append(np.zeros(i), -30.0) for i in range(len(names))], 0.5)
    flat = np.concatenate([f for f, _ in rows])
    owner = np.repeat(np.arange(len(rows), dtype=np.int32), [len(f) for f, _ in rows])
    kinds, held = np.unique(flat, return_counts=True)
    kinds, held = kinds[held >= least_rows], held[held >= least_rows]
    toxic, times = np.unique(flat[y[owner] > 0], return_counts=True)
    at = np.minimum(np.searchsorted(toxic, kinds), max(len(toxic) - 1, 0))
    bad = np.where(toxic[at] == kinds, times[at], 0) if len(toxic) else np.zeros(len(kinds))
    rate = np.log((bad + 0.5) / (y.sum() + 1)) - np.log((held - bad + 0.5) / (len(y) - y.sum() + 1))
    best = np.argsort(-np.abs(rate) * np.sqrt(held), kind="stable")[:most_features]
    chosen = np.sort(kinds[best])
    features = {int(f): j for j, f in enumerate(chosen)}
    place = np.minimum(np.searchsorted(chosen, flat), max(len(chosen) - 1, 0))
    hit = chosen[place] == flat if len(chosen) else np.zeros(len(flat), bool)
    flat, owner = place[hit], owner[hit].astype(np.int64)
    lengths = np.bincount(owner, minlength=len(rows))
    member = grouped(np.split(flat, np.cumsum(lengths)[:-1]), y > 0, len(features), groups)
    truth = [*member.T.astype(float), y]
    fold = np.arange(len(rows)) % folds
    earlier = np.zeros((len(rows), 0))
    weights = []
    for target in truth:
        own = np.zeros(len(rows))
        for k in range(folds):
            learn, test = fold != k, fold == k
            place = np.cumsum(learn) - 1
            hit = learn[owner]
            w = _fit(flat[hit], place[owner[hit]], earlier[learn], target[learn], len(features), ridge)
            score = np.bincount(owner, w[flat], len(rows)) + earlier @ w[len(features) : -1] + w[-1]
            own[test] = 1 / (1 + np.exp(-np.clip(score[test], -30, 30)))
        weights.append(_fit(flat, owner, earlier, target, len(features), ridge))
        earlier = np.column_stack([earlier, own])
    p = earlier[:, -1]
    grid = np.linspace(0.2, 0.8, 25)
    errors = np.array([((p >= g) != (y > 0)).sum() for g in grid])
    best = grid[errors == errors.min()]
    return Chain(names, features, weights, float(best[len(best) // 2]))


def words_of(text: str | None) -> set[str]:
    return set(WORD.findall(text.lower())) if text else set()


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "toxic", most_rows: int = 16_000, groups: int = GROUPS) -> Chain:
    """The chain from at most ``most_rows`` labelled documents, those whose ids have the smallest hash.

    ``most_rows`` bounds what the driver and the broadcast hold.  Rows without id or label
    are no training rows; an id labelled more than once is toxic if any of its labels is.
    """
    marks = labels.select(labels[id_column].alias("id"), labels[label_column].alias("y")).dropna()
    marks = marks.groupBy("id").agg(F.max("y").alias("y")).orderBy(F.xxhash64("id"), "id").limit(most_rows)
    texts = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            features = [example(words_of(t)).view(np.int32) for t in batch.column(2).to_pylist()]
            toxic = pa.array([y > 0 for y in batch.column(1).to_pylist()], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(features, pa.list_(pa.int32())), toxic], ["id", "features", "toxic"])

    def reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [f.values.to_numpy() for f in batch.column(1)]
            kept = [f[np.isin(f, chosen.value)].tobytes() for f in own]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(kept, pa.binary()), batch.column(2)], ["id", "features", "toxic"])

    # ``marks`` has most_rows rows at most: a proven bound, so texts are not shuffled.
    joined = texts.join(F.broadcast(marks), "id").select(F.col("id").cast("long").alias("id"), F.col("y").cast("int").alias("y"), "text")
    sample = staged(joined.mapInArrow(run, "id long, features array<int>, toxic boolean").dropDuplicates(["id"]), "sample")
    toxic = F.col("toxic").cast("int")
    total = sample.agg(F.count("*").alias("n"), F.coalesce(F.sum(toxic), F.lit(0)).alias("bad")).first()
    # What tells toxic rows from others is counted by Spark; the driver gets the best features and the rows cut to them.
    counts = sample.select(F.explode("features").alias("f"), toxic.alias("y")).groupBy("f").agg(F.count("*").alias("n"), F.sum("y").alias("bad"))
    clean = total["n"] - total["bad"]
    rate = F.log((F.col("bad") + 0.5) / (total["bad"] + 1)) - F.log((F.col("n") - F.col("bad") + 0.5) / (clean + 1))
    best = counts.where(F.col("n") >= LEAST_ROWS).orderBy((F.abs(rate) * F.sqrt("n")).desc(), "f").limit(MOST_FEATURES)
    chosen = docs.sparkSession.sparkContext.broadcast(np.array([r["f"] for r in best.select("f").collect()], np.int32))
    rows = sample.mapInArrow(reduced, "id long, features binary, toxic boolean").collect()
    rows.sort(key=lambda r: (r["id"] * 0x9E3779B97F4A7C15) % 2**64)
    return fit([(np.frombuffer(r["features"], np.uint32), r["toxic"]) for r in rows], groups)


def judge(model: Chain):
    """A function from texts to (probabilities, rejected); texts without words are not rejected."""
    known: dict[str, tuple[int, ...]] = {}
    get = model.features.get

    def judged(texts) -> tuple[np.ndarray, np.ndarray]:
        rows = []
        for text in texts:
            found: set[int] = set()
            for word in words_of(text):
                own = known.get(word)
                if own is None:
                    own = tuple(j for j in map(get, cut(word)) if j is not None)
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[word] = own
                if own:
                    found.update(own)
            rows.append(np.fromiter(found, np.int64, len(found)))
        p = model.probabilities(rows)
        return p, (p[:, -1] >= model.threshold) & np.array([len(r) > 0 for r in rows], bool)

    return judged


def score(docs: DataFrame, chain: Chain, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, p_<category>..., rejected, kept), one row per input row; texts without words are kept."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    kind = docs.schema[id_column].dataType.simpleString()
    columns = [f"p_{n}" for n in chain.names]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        judged = judge(shared.value)
        for batch in slices(batches, "text"):
            p, bad = judged(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(p[:, i]) for i in range(p.shape[1])), pa.array(bad), pa.array(~bad)],
                ["id", *columns, "rejected", "kept"],
            )

    fields = ", ".join([f"id {kind}", *(f"{c} double" for c in columns), "rejected boolean", "kept boolean"])
    narrow = docs.select(docs[id_column].alias("id"), docs[text_column].alias("text"))
    return narrow.mapInArrow(run, fields).withColumnRenamed("id", id_column)


def accepted(docs: DataFrame, chain: Chain, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``score`` keeps, each judged where it stands: nothing is shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        judged = judge(shared.value)
        for batch in slices(batches, text_column):
            yield batch.filter(pa.array(~judged(batch.column(text_column).to_pylist())[1]))

    return docs.mapInArrow(run, docs.schema)
