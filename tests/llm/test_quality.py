import numpy as np
import pytest
from pyspark.sql import functions as F

from churnflow.llm import quality as q
from churnflow.llm.common import held_out


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet")


@pytest.fixture(scope="module")
def scores(tables):
    return {r.doc_id: r for r in q.quality_scores(*tables).collect()}


def test_accuracy_on_held_out_rows(tables, scores):
    documents, labels = tables
    truth = [(scores[r.doc_id], r.quality) for r in labels.collect()]
    judged = [(s.predicted == y) for s, y in truth if s.held_out]
    assert len(scores) == documents.count() and len(judged) > 50
    assert np.mean(judged) > 0.95
    good, bad = ([s.score for s, y in truth if s.held_out and y == value] for value in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97


def test_held_out_labels_teach_nothing(tables, scores):
    documents, labels = tables
    wrong = labels.withColumn("quality", F.when(held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    other = {r.doc_id: r.score for r in q.quality_scores(documents.withColumn("lang", F.lit("xx")), wrong).collect()}
    assert other == {i: r.score for i, r in scores.items()}


def test_fold_is_the_crc_of_the_id(scores):
    import zlib

    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in scores.items())


def test_odd_rows(spark, docs_of, messy):
    labels = spark.createDataFrame([(5, 1, "x"), (5, 0, "x"), (6, None, "x"), (None, 1, "x"), (8, 0, "x"), (999, 1, "x")], "doc_id long, quality int, key string")
    rows = q.quality_scores(docs_of(messy), labels).collect()
    assert len(rows) == len(messy)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= q.THRESHOLD) and isinstance(r.held_out, bool) for r in rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in q.quality_scores(docs_of(messy), none).collect()} == {0.5}
    assert q.quality_scores(docs_of([]), labels).count() == 0


def test_rejected_documents_go(tables, scores):
    documents, labels = tables
    kept = q.of_good_quality(documents, labels)
    assert kept.columns == documents.columns
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in scores.items() if r.predicted}


def test_sample_is_bounded(tables):
    documents, labels = tables
    assert q.quality_scores(documents, labels, sample=40).count() == documents.count()


def test_temperature_calibrates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(4000, 6))
    y = (rng.random(4000) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(float)
    net = q.train(x, y)
    p = net.probability(x)
    for low in (0.1, 0.5, 0.8):
        some = (p >= low) & (p < low + 0.15)
        assert abs(y[some].mean() - p[some].mean()) < 0.08


def test_word_vectors_add_up_over_tasks(docs_of):
    rows = [(i, "the cat sat on the mat " * (i % 3 + 1)) for i in range(12)]
    one, many = (q.word_vectors(docs_of(rows, n)) for n in (1, 5))
    assert np.array_equal(one, many)


def brute_tokens(text):
    import re

    return re.findall(rb"[A-Za-z0-9\x80-\xff]+|[!-/:-@\[-`{-~]+", text.encode())


def test_tokens_equal_a_pattern(messy):
    import pandas as pd
    import pyarrow as pa

    texts = [t or "" for _, t in messy] + ["a.b", "", "x", "...", "é!é", "tail\x7f\x00head"]
    rows, begins = q.token_rows(pa.array(texts))
    for text, since, until in zip(texts, begins, begins[1:]):
        want = pd.util.hash_array(np.array([*brute_tokens(text), b""], dtype=object), categorize=False)[:-1] % np.uint64(q.ROWS)
        assert rows[since:until].tolist() == want.tolist()


@pytest.mark.parametrize("part", [1, 3, 50])
def test_long_texts_in_parts(docs_of, messy, monkeypatch, part):
    """Vectors and pooled numbers are the same however documents are taken apart."""
    from churnflow.llm import wordids

    docs = docs_of([(i, t) for i, t in messy if t is None or len(t) < 3000] + [(77, "a b. c d! " * 40)], 2)
    vectors = q.word_vectors(docs)
    whole = sorted((repr(r.doc_id), r.x) for r in q.pooled(docs, vectors).collect())
    monkeypatch.setattr(q, "PART", part)
    monkeypatch.setattr(q, "AT_ONCE", 2 * part)
    monkeypatch.setattr(wordids, "TEXT_BYTES", 100)
    assert np.array_equal(q.word_vectors(docs), vectors)
    parts = sorted((repr(r.doc_id), r.x) for r in q.pooled(docs, vectors).collect())
    assert [i for i, _ in parts] == [i for i, _ in whole]
    assert np.allclose([x for _, x in parts], [x for _, x in whole], atol=1e-5)
