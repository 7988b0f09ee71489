import random

import numpy as np
import pytest

from churnflow.llm import substrings as s
from churnflow.llm.packing import narrow, pack56, unpack56, wide


def brute(rows, window):
    words = [(i, s.words_of(t)) for i, t in rows]
    first = {}
    for i, w in words:
        if i is not None:
            for k in range(len(w) - window + 1):
                gram = tuple(w[k : k + window])
                first[gram] = min(first.get(gram, i), i)
    out = []
    for i, w in words:
        hit = set()
        if i is not None:
            for k in range(len(w) - window + 1):
                if first[tuple(w[k : k + window])] < i:
                    hit.update(range(k, k + window))
        out.append((i, len(w), len(hit), b" ".join(x for k, x in enumerate(w) if k not in hit).decode()))
    return sorted(map(repr, out))


def got(df):
    return sorted(repr((r.doc_id, r.n_words, sum(x.end - x.start for x in r.removed), r.kept)) for r in df.collect())


@pytest.mark.parametrize("window, chunk", [(50, s.CHUNK), (50, 100), (4, 1000), (1, 37)])
def test_equals_brute_force(docs_of, messy, window, chunk):
    rng = random.Random(window)
    parts = [" ".join(rng.choice("abcde") for _ in range(rng.randint(1, 30))) for _ in range(12)]
    rows = messy + [(200 + i, "  ".join(rng.choice(parts) for _ in range(rng.randint(0, 5)))) for i in range(60)]
    assert got(s.without_repeated_windows(docs_of(rows), window, chunk)) == brute(rows, window)


def test_spans_are_maximal(docs_of):
    text = " ".join(f"w{i}" for i in range(20))
    rows = [(1, text), (2, f"a {text} b {' '.join(text.split()[:6])}")]
    found = {r.doc_id: r for r in s.without_repeated_windows(docs_of(rows), 5).collect()}
    assert [(x.start, x.end) for x in found[2].removed] == [(1, 21), (22, 28)]
    assert found[2].kept == "a b" and found[1].removed == []


def test_empty_table(docs_of):
    assert s.without_repeated_windows(docs_of([])).count() == 0


def test_packing():
    x = np.sort(np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 100))
    for ids in (x, np.array([5]), np.array([7, 7, 8, 300]), np.array([], np.int64)):
        assert wide(narrow(ids)).tolist() == ids.tolist() or not len(ids)
    h = np.random.default_rng(2).integers(0, 1 << 63, 50).astype(np.uint64) * np.uint64(2)
    for one in h:
        bucket = int(one) >> 54
        assert unpack56(pack56(np.array([one])), bucket, 10)[0] == one
