"""Ranked search against scores summed document by document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from churnflow.llm import ranked

_TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return _TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(documents, benchmark, k=20):
    docs = [(i, Counter(terms(t))) for i, t in documents]
    docs = [(i, c, sum(c.values())) for i, c in docs if c]
    n_docs, total = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    out = []
    items = {}
    for item, text in benchmark:
        if item is not None and text is not None:
            items[item] = min(items.get(item, text), text)
    for item, text in items.items():
        scores = []
        for i, c, n in docs:
            m = 100 - 25 + (25 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m))
                        for t in terms(text) if t in c)
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=repr)


def got(spark, docs, benchmark, k=20):
    items = spark.createDataFrame([(*b, "x", "y") for b in benchmark], "item_id long, text string, block string, words string")
    found = ranked.ranked(docs, items, k)
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted((tuple(r) for r in found.collect()), key=repr)


BENCHMARK = [
    (1, "shared1 shared2 the-3 w17 w18 shared1"), (2, "aaaa AAAA b"), (3, ""), (4, None), (None, "word"), (5, "nowhere to be found"),
    (6, "é 漢字 w1 w2 w3"), (6, "é 漢字 w1 w2 w3"), (7, "zz"), (7, "no id"), (8, "huge"), (9, "!!!"),
]


@pytest.mark.parametrize("block", [2, 512])
def test_messy_rows(spark, docs_of, messy, monkeypatch, block):
    monkeypatch.setattr(ranked, "BLOCK", block)
    assert got(spark, docs_of(messy), BENCHMARK) == brute(messy, BENCHMARK)


def test_ties_and_small_k(spark, docs_of):
    rows = [(i % 40, f"same words {'more' if i % 3 else ''}") for i in range(120)]
    for k in (1, 7):
        assert got(spark, docs_of(rows), [(1, "same more"), (2, "words")], k) == brute(rows, [(1, "same more"), (2, "words")], k)


def test_random_rows_are_skipped_and_found(spark, docs_of):
    rng = random.Random(3)
    words = [f"v{i}" for i in range(300)]
    weights = [1 / (i + 1) for i in range(300)]
    rows = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 60)))) for i in range(1500)]
    items = [(i, " ".join(rng.choices(words, weights, k=rng.randint(1, 40)))) for i in range(30)]
    assert got(spark, docs_of(rows, 7), items, 5) == brute(rows, items, 5)


def test_items_in_blocks(spark, docs_of, messy, monkeypatch):
    monkeypatch.setattr(ranked, "TERMS_AT_ONCE", 5)
    assert got(spark, docs_of(messy), BENCHMARK) == brute(messy, BENCHMARK)


def test_empty_tables(spark, docs_of):
    assert got(spark, docs_of([]), [(1, "a")]) == []
    assert got(spark, docs_of([(1, "a")]), []) == []
    assert got(spark, docs_of([(1, None), (2, "")]), [(1, "a")]) == []


def test_joint_maxima_bound_every_document():
    """A pair's joint maximum is no more than its terms' own maxima, and no less than what any document gets."""
    rng = np.random.default_rng(1)
    terms_, docs = np.divmod(rng.choice(60, 25, replace=False), 10)
    matrix, row = ranked._matrix(terms_, rng.integers(1, 100, 25), docs, 10, 6)
    pairs = np.array([(0, 1, 1, 2), (2, 1, 3, 1), (4, 2, -1, 0)])
    joint = ranked._joint(matrix, row, pairs)
    own = np.array([matrix[row[a]].max() * c + (matrix[row[b]].max() * d if d else 0) for a, c, b, d in pairs])
    assert (joint.max(axis=1) <= own).all() and joint.max(axis=1)[2] == own[2]


def test_long_text_in_stretches(monkeypatch):
    from churnflow.llm import wordids

    monkeypatch.setattr(wordids, "TEXT_BYTES", 64)
    text = " ".join(f"w{i % 7}" for i in range(500))
    known = pa.array([f"w{i}".encode() for i in range(5)], pa.binary())
    n, begins, ids, tfs = ranked._frequencies(pa.array([text]), known)
    assert len(wordids.stretches(pa.array([text]))) > 5
    assert n.tolist() == [500] and dict(zip(ids.tolist(), tfs.tolist())) == {i: sum(j % 7 == i for j in range(500)) for i in range(5)}
