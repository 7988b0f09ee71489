import numpy as np
import pytest
from pyspark.sql import functions as F

from churnflow.llm import language as lang


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="module")
def found(documents):
    return {r.doc_id: r for r in lang.languages(documents).collect()}


def test_accuracy_on_held_out_rows(documents, found):
    truth = {r.doc_id: r.lang for r in documents.select("doc_id", "lang").collect()}
    held = [found[i].lang_pred == x for i, x in truth.items() if found[i].held_out]
    assert len(found) == len(truth) and len(held) > 100 and np.mean(held) > 0.95


def test_held_out_languages_teach_nothing(documents, found):
    from churnflow.llm.common import held_out

    other = documents.withColumn("lang", F.when(held_out(F.col("doc_id")), F.lit("zz")).otherwise(F.col("lang"))).withColumn("source", F.lit("x"))
    again = {r.doc_id: r for r in lang.languages(other).collect()}
    assert {i: (r.lang_pred, r.score) for i, r in again.items()} == {i: (r.lang_pred, r.score) for i, r in found.items()}


def test_odd_rows(docs_of, messy):
    rows = [(i, t, "en") for i, t in messy] + [(400 + i, "der die das und ist " * 5, "de") for i in range(20)] + [(500, "12 34 !", None)]
    got = lang.languages(docs_of(rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        text = dict((i, t) for i, t, _ in rows)[r.doc_id] if r.doc_id is not None else None
        if r.doc_id is not None:
            assert (r.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
        assert 0 <= r.score <= 1 and (r.score == 0 or r.lang_pred in ("en", "de"))


@pytest.mark.parametrize("text", ["½", "²", "①", "Ⅷ", "1 2_3", "٣٤", ""])
def test_numbers_are_no_letters(docs_of, text):
    rows = [(i, "der die das und ist " * 5, "de") for i in range(5)] + [(i, "the and of to in " * 5, "en") for i in range(5, 9)] + [(99, text, "en")]
    assert [(r.lang_pred, r.score) for r in lang.languages(docs_of(rows)).collect() if r.doc_id == 99] == [("und", 0.0)]


def test_languages_are_bounded(docs_of, monkeypatch):
    monkeypatch.setattr(lang, "LANGUAGES", 2)
    rows = [(i, f"text in language {i % 7}", f"l{i % 7}" if i % 7 else "most") for i in range(100)] + [(200 + i, "more text", "most") for i in range(9)]
    found = {r.lang_pred for r in lang.languages(docs_of(rows)).collect()}
    assert len(found) <= 2 and len(set(lang.sample_of(docs_of(rows))[1])) == 2 and "most" in lang.sample_of(docs_of(rows))[1]


def test_nothing_to_learn(docs_of):
    assert {(r.lang_pred, r.score) for r in lang.languages(docs_of([(1, "text", None), (2, None, "en")])).collect()} == {("und", 0.0)}
    assert lang.languages(docs_of([])).count() == 0
    alone = lang.languages(docs_of([(1, "some text", "en"), (3, "other", "en")])).collect()
    assert {(r.lang_pred, r.score) for r in alone} == {("en", 1.0)}


def test_every_position_has_probabilities_that_pool():
    net = lang.train(["the cat and the dog " * 20, "le chat et le chien " * 20] * 10, ["en", "fr"] * 10)
    raws = ["the dog and the cat".encode(), b"", ("le chien " * 40).encode()]
    x, inside = lang._laid_out(*lang._cut(raws[0]))
    rows = {t: p for t, p in lang.position_probabilities(net, x, inside)}
    assert len(rows) == lang.SEGMENT and all(np.allclose(p.sum(0), 1, atol=1e-5) for p in rows.values())
    mean = np.mean([rows[t][:, 0] for t in range(len(raws[0]))], axis=0)
    pooled = lang.document_probabilities(net, raws)
    assert np.allclose(pooled[0], mean, atol=1e-5) and not pooled[1].any()
    assert net.languages[pooled[0].argmax()] == "en" and net.languages[pooled[2].argmax()] == "fr"
    assert np.allclose(lang.document_probabilities(net, raws[:1]), pooled[:1], atol=1e-5)
