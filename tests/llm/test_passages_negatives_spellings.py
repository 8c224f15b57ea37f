"""Repeated passages, hard negatives and spelling variants against plain Python."""

import random

import numpy as np
import pytest

from civicloom.llm import hilbert_negatives, prefix_trees, queries, spelling
from tests.llm import brute

SCHEMA = "doc_id long, text string, id int, word string, n string, bucket int, label int"
VECTORS = "vec_id long, embedding array<float>, label int, q string, width int, block long"


def prose(seed, n, kinds=4000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(kinds)}é" for _ in range(n))


def mixed(seed, passages, n):
    """Prose with some of ``passages`` in it, cut anywhere."""
    r = random.Random(seed)
    out = []
    for k in range(n):
        out.append(prose(f"{seed}-{k}", r.randrange(1, 30)))
        own = r.choice(passages).split()
        lo = r.randrange(len(own))
        out.append(" ".join(own[lo : lo + r.randrange(5, 60)]))
    return r.choice([" ", "\n", " \t\r"]).join(out)


def same(got, want):
    return sorted(got, key=repr) == sorted(want, key=repr)


@pytest.fixture(scope="module")
def passages():
    return [prose(k, 80) for k in range(4)]


@pytest.fixture(scope="module")
def rows(passages):
    texts = [None, "", " \n\t", "one", "a " * 12, "a " * 13, "b " * 400, "c " * 400, "x" * 5000 + " " + prose(5, 20), "x" * 5000 + " " + prose(5, 20) + " tail"]
    texts += ["y" * 5001 + " " + prose(5, 20), prose(6, 140_000), prose(6, 140_000)[700_000:] + " end", passages[0], passages[0], passages[0].replace(" ", "\n\n")]
    texts += [mixed(k, passages, 6) for k in range(60)] + ["\x1c\x1d \x85 \u2003 日本語 🙂 " * 30, "\x1c\x1d \x85 \u2003 日本語 🙂 " * 20]
    ids = list(range(len(texts)))
    random.Random(3).shuffle(ids)
    return list(zip(ids, texts))


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, "w", "n", 2, 3) for i, t in rows], SCHEMA).repartition(3)


def removed(docs, **more):
    return [(r["doc_id"], r["n_words"], r["kept"]) for r in prefix_trees.remove_passages(docs, **more).collect()]


@pytest.mark.parametrize("more", [{}, {"group": 2}, {"group": 8, "bucket_bytes": 1 << 14}])
def test_passages(spark, rows, more):
    assert same(removed(frame(spark, rows), **more), brute.passages(rows))


def test_passages_of_odd_rows(spark, rows, passages):
    more = [*rows, *rows[13:18], (None, passages[0]), (None, passages[1]), (None, passages[1]), (None, None), (None, prose(8, 30))]
    assert same(removed(frame(spark, more)), brute.passages(more))
    assert same(removed(frame(spark, more), group=2), brute.passages(more))
    assert removed(frame(spark, []).limit(0)) == []


def test_passage_spans(spark, passages):
    got = {r["doc_id"]: [tuple(s) for s in r["spans"]] for r in prefix_trees.remove_passages(frame(spark, [(1, passages[0]), (2, "new " + passages[0] + " new"), (3, passages[0])])).collect()}
    assert got == {1: [], 2: [(1, 81)], 3: [(0, 80)]}


def test_prefix_lengths():
    name = np.array([1 << 32 | 1, 1 << 32 | 1, 2 << 32 | 1, 2 << 32 | 2, 2 << 32 | 2, 3 << 32 | 1, 3 << 32 | 1], np.uint64)
    held = np.array([1, 1, 1, 2, 1, 3, 3], np.uint8)
    assert prefix_trees.split(name, held, 2).tolist() == [4, 4, -1, 0, 0, 0, 0]
    assert prefix_trees.split(name, held, 3).tolist() == [4, 4, -1, 4, 4, 0, 0]
    two = np.array([1 << 32 | 1, 1 << 32 | 2], np.uint64)
    assert prefix_trees.split(two, np.array([2, 2], np.uint8), 3).tolist() == [8, 8]


def vectors(seed, n, width=12, hot=0):
    r = np.random.default_rng(seed)
    v = r.normal(size=(n, width)) / np.sqrt(width)
    v[: n // 3] = v[r.integers(n // 3, n, n // 3)] + r.normal(size=(n // 3, width)) * 0.02
    v[:hot] = v[0]
    return [(int(i), [float(np.float32(x)) for x in v[k]], int(r.integers(0, 4))) for k, i in enumerate(r.permutation(n))]


def mined(spark, rows, **more):
    df = spark.createDataFrame([(i, v, l, "q", 1, 2) for i, v, l in rows], VECTORS).repartition(3)
    return [tuple(r) for r in hilbert_negatives.mine(df, **more).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]


@pytest.mark.parametrize("hot", [0, 400])
def test_negatives(spark, hot):
    rows = vectors(5, 1500, hot=hot)
    want = brute.hard_negatives(rows, every=20)
    assert len(want) > 300
    assert same(mined(spark, rows, every=20), want)


def test_negatives_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    odd = [(None, [0.5] * 12, 1), (2000, None, 1), (2001, [0.5] * 12, None), (2100, [nan] * 12, 1), (2200, [inf] + [0.0] * 11, 1), (2300, [], 1), (2400, [None] + [1.0] * 11, 1)]
    odd += [(2500 + k, [0.0] * 12, 1 + k % 2) for k in range(30)] + [(2700 + 10 * k, [0.25 * k, 1.0, -0.5], k % 3) for k in range(40)] + [(3100, [1.0], 1), (3200, [2e5] * 12, 2), (3201, [2e5] * 12, 2), (3202, [1.9e5] * 12, 1)]
    rows = vectors(6, 600) + odd
    want = brute.hard_negatives(rows)
    assert same(mined(spark, rows), want)
    assert same(mined(spark, rows + rows[:200] + odd), want)  # repeated rows count once
    assert mined(spark, rows + [(9000, [1e30] * 12, 1)]) and mined(spark, []) == []


def test_curve_visits_neighbours():
    grid = np.array([[a, b, c] for a in range(4) for b in range(4) for c in range(4)])
    place = hilbert_negatives.hilbert(grid, 2)
    assert sorted(place.tolist()) == list(range(64))
    assert np.abs(np.diff(grid[np.argsort(place)], axis=0)).sum(axis=1).max() == 1


def test_zone_bounds_hold():
    r = np.random.default_rng(2)
    a, b = r.integers(-300, 300, (5, 7)), r.integers(-300, 300, (40, 7))
    low, high = hilbert_negatives.bounds(a, b.min(0)[None], b.max(0)[None])
    s = hilbert_negatives.scores(a, b)
    assert (s == a @ b.T).all() and (low <= s).all() and (s <= high).all()


def spelled(seed, n):
    """Few letters and many near words, so that reduced words and halves meet often."""
    r = random.Random(seed)
    words = ["".join(r.choice("abÀéÉ×") for _ in range(r.randrange(6, 12))) for _ in range(60)]
    out = []
    for _ in range(n):
        w = list(r.choice(words))
        if r.random() < 0.5:
            k = r.randrange(len(w))
            w[k : k + r.randrange(2)] = r.choice(["", "a", "b", "é", "aa"])
        out += ["".join(w)] * r.choice([1, 1, 2, 25])
    return r.choice([" ", "1", "\u0100"]).join(out)


def test_spellings(spark):
    rows = [(k, spelled(k, 60)) for k in range(40)] + [(90, None), (91, ""), (92, "information informatoin Information " * 20), (None, "information informations"), (93, "z" * 3000 + " " + "z" * 3001 + " " + "z" * 3000 + " " + "z" * 3001)]
    rows += rows[:3] + [(100, "abcdefghij " * 400 + "abcdefghik " * 25 + "abcdefghkk " * 2)]
    docs = frame(spark, rows)
    got = [tuple(r) for r in spelling.variants(docs).select("word", "form", "root", "n", "n_near", "form_n").collect()]
    want = brute.spellings(rows)
    assert any(w[1] for w in want) and any(w[1] and w[2] != w[1] for w in want)
    assert same(got, want)
    assert spelling.variants(docs.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["op11_prefix_trees", "op12_hilbert_negatives", "op13_spelling_variants"])
def test_query_columns(spark, name):
    folder = "/root/testdata/sf0.001"
    got = queries.QUERIES[name](spark, folder)
    if name == "op12_hilbert_negatives":
        want = brute.hard_negatives([(r["vec_id"], r["embedding"], r["label"]) for r in queries.table(spark, folder, "embeddings").collect()])
        columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    else:
        docs = [(r["doc_id"], r["text"]) for r in queries.table(spark, folder, "documents").collect()]
        if name == "op11_prefix_trees":
            want = [(i, n, n - len(k.encode().split()), brute.sha(k.encode())) for i, n, k in brute.passages(docs)]
            columns = ["doc_id", "n_words", "n_removed", "kept_sha256"]
        else:
            want, columns = brute.spellings(docs), ["word", "form", "root", "n", "n_near", "form_n"]
    assert same([tuple(r) for r in got.select(*columns).collect()], want)
