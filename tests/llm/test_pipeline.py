"""Every stage on small tables, against plain Python on the stage's own input."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from civicloom.llm import pii, toxicity
from tests.llm import brute
from tests.llm.test_operators import BASE, PASSAGE, TEXTS

FOLDER = "/root/testdata/sf0.001"


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    tables = [docs]
    for _, stage in corpus_pipeline.STAGES:
        tables.append(stage(spark, tables[-1], FOLDER).cache())
    return tables


def test_columns_and_rows_stay(stages):
    for before, after in zip(stages, stages[1:-1]):
        assert after.columns == before.columns
        assert {r[0] for r in after.select("doc_id").collect()} <= {r[0] for r in before.select("doc_id").collect()}
    assert stages[2].count() == stages[3].count() == stages[4].count()


def test_toxic_documents_go_and_clean_ones_stay(spark, stages):
    marks = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").dropna().collect()}
    left = set(texts(stages[1]))
    known = [i for i in marks if i in texts(stages[0])]
    assert sum((i in left) == (marks[i] > 0) for i in known) <= 0.1 * len(known)
    chain = toxicity.train(stages[0], spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert left == {r["doc_id"] for r in toxicity.score(stages[0], chain).where("kept").collect()}


def test_one_document_of_each_group_stays(stages):
    rows = list(texts(stages[1]).items())
    _, component = brute.near_duplicates(rows, 5)
    assert set(texts(stages[2])) == {i for i in component if component[i] == i}


def test_repeats_are_cut(stages):
    got = texts(stages[3])
    for i, (_, kept, _) in brute.repeats(list(texts(stages[2]).items())).items():
        assert got[i] == kept.decode("utf-8", "ignore")


def test_personal_data_is_masked(stages):
    got = texts(stages[4])
    for i, text in texts(stages[3]).items():
        assert not brute.base_spans(got[i])
        if not pii.loose_spans(text, []) and not brute.base_spans(text):
            assert got[i] == text


def test_pieces_cover_every_text(stages):
    from tokenizers import Tokenizer

    from civicloom.llm import queries

    tokenizer = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    total = stages[5].groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for i, t in texts(stages[4]).items()}
    assert {r["doc_id"]: r["n"] for r in total} == want


@pytest.fixture(scope="module")
def odd(spark):
    """(rows in the order of ids, table): repeated rows, one id with two texts, null ids; ``name`` tells rows apart."""
    rows = [(i * 3 % 97, t) for i, t in enumerate(TEXTS)]
    rows += [*rows[8:14], (rows[14][0], "another text"), (None, BASE), (None, None), (None, PASSAGE), (None, PASSAGE), (None, "you idiot"), (None, "good day"), (2000, "idiot"), (2000, "good")]
    table = spark.createDataFrame([(i, t, str(k)) for k, (i, t) in enumerate(rows)], "doc_id long, text string, name string")
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    return [(str(k), *rows[k]) for k in order], table


def test_each_odd_row_has_its_own_toxicity_verdict(spark, odd, monkeypatch, tmp_path):
    rows, table = odd
    example = toxicity.example
    chain = toxicity.fit([(example({"good"}), False), (example({"idiot"}), True)] * 6)
    monkeypatch.setattr(toxicity, "train", lambda *_: chain)
    table.selectExpr("doc_id", "1 AS toxic").write.parquet(f"{tmp_path}/labels.parquet")
    left = {(r["name"], r["doc_id"], r["text"]) for r in corpus_pipeline.drop_toxic(spark, table, str(tmp_path)).collect()}
    assert {"you idiot", "idiot"}.isdisjoint(t for *_, t in left)
    assert {(i, t) for _, i, t in left} >= {(None, "good day"), (2000, "good"), (None, None)}


def test_one_odd_row_of_each_group_stays(spark, odd):
    rows, table = odd
    _, component = brute.near_duplicates([(k, t) for k, (_, _, t) in enumerate(rows)], 5)
    got = corpus_pipeline.drop_near_copies(spark, table, FOLDER)
    assert got.columns == table.columns
    assert sorted(r["name"] for r in got.collect()) == sorted(rows[k][0] for k in component if component[k] == k)


def test_repeats_are_cut_from_each_odd_row(spark, odd):
    rows, table = odd
    want = brute.repeats([(k, t) for k, (_, _, t) in enumerate(rows)])
    got = corpus_pipeline.cut_repeats(spark, table, FOLDER).collect()
    assert len(got) == len(rows)
    texts_of = {r["name"]: r["text"] for r in got}
    assert texts_of == {name: None if t is None else want[k][1].decode("utf-8", "ignore") for k, (name, _, t) in enumerate(rows)}


def test_run_on_an_empty_table(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{FOLDER}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
