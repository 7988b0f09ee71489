"""Fill-in-middle against a text-by-text version, and the rank index against the offsets it was fitted to."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnflow.llm import infilling


def brute(doc_id, text):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted(x % (len(lines) + 1) for x in h[:2])
    prefix, middle, suffix = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")):
        return doc_id, len(lines), "plain", None, None, text, text
    form = "spm" if h[3] % 100 < 50 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, len(lines), form, len(prefix), len(middle), output, text


def check(docs, rows):
    done = infilling.transformed(docs).withColumn("restored", infilling.restored(F.col("output"), F.col("form")))
    assert done.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    assert sorted(map(repr, map(tuple, done.collect()))) == sorted(repr(brute(*r)) for r in rows)


def test_messy_rows(docs_of, messy):
    check(docs_of(messy), messy)


def test_lines_and_marks(docs_of):
    rng = random.Random(5)
    bits = ["\n", "a", "é\n", "<P>", "<", "P>", "S>", "<M", ">", "漢字", "\r\n", "line of some length\n", " ", "👍"]
    rows = [(i, "".join(rng.choices(bits, [9, 9, 5, .1, 3, 3, 3, 3, 3, 3, 3, 9, 1, 1], k=rng.randint(0, 60)))) for i in range(400)]
    check(docs_of(rows, 4), rows)


def test_empty_table(docs_of):
    check(docs_of([]), [])


def test_long_text_among_short_ones(docs_of):
    rng = random.Random(6)
    long = "".join("x" * rng.choice([0, 3, 50, 4000]) + "\n" for _ in range(4000))
    rows = [(1, "a\nb"), (2, long), (3, long + "end"), (4, "\n" * 5000)]
    check(docs_of(rows, 1), rows)


@pytest.mark.parametrize("steps", [[1] * 500, [0] * 20, [7] * 90 + [900] * 50 + [1] * 400, [100_000, 1, 1, 5, 10**9, 3], [], None])
def test_rank_index_is_exact_and_bounded(steps):
    steps = random.Random(1).choices(range(2000), k=3000) if steps is None else steps
    offsets = np.cumsum([5, *steps])
    index = infilling.RankIndex.fit(offsets)
    ranks = np.arange(len(offsets))
    assert (index.at(ranks) == offsets).all()
    assert index.residuals.dtype == np.int8 and np.abs(index.predicted(ranks) - offsets).max() <= infilling.BOUND + 1
    assert len(index.ranks) <= max(1, len(offsets) // 2 + 1)


def test_even_lines_need_one_segment():
    assert len(infilling.RankIndex.fit(np.arange(0, 10**6, 40)).ranks) == 1


def test_rates(docs_of):
    rows = [(i, "a\nb\nc") for i in range(300)]
    plain = infilling.transformed(docs_of(rows), rate=0)
    assert {r.form for r in plain.collect()} == {"plain"}
    assert {r.form for r in infilling.transformed(docs_of(rows), suffix_first=100).collect()} == {"spm"}
