"""Packing: pieces as the tokenizer library makes them, sequences without gaps, and nearly as few as can be."""

import itertools
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from churnflow.llm import binslack, wordids
from churnflow.llm.queries import QUERIES, tokenizer_path


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def ids_of(library, text):
    return [*library.encode(text or "", add_special_tokens=False).ids, 0]


def want(library, rows, capacity):
    out = Counter()
    for doc_id, text in rows:
        ids = ids_of(library, text)
        for piece, start in enumerate(range(0, len(ids), capacity)):
            part = ids[start : start + capacity]
            out[doc_id, piece, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    return out


def check(found, library, rows, capacity=2048):
    found = found.collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found) == want(library, rows, capacity)
    inside = defaultdict(list)
    for r in found:
        inside[r.sequence_id].append((r.offset, r.length))
    for spans in inside.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    assert sorted(inside) == list(range(len(inside)))
    return len(inside), sum(r.length for r in found)


def test_messy_rows(spark, docs_of, messy, library):
    for capacity in (2048, 16):
        n, tokens = check(binslack.packed(docs_of(messy), tokenizer_path(), capacity), library, messy, capacity)
        assert n <= -(-tokens // capacity) + 1


def test_whole_table(spark, sf_dir, library):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_packing"](spark, sf_dir)
    assert found.dtypes == [("doc_id", "bigint"), ("piece", "int"), ("start", "bigint"), ("length", "bigint"), ("ids_crc32", "bigint"),
                            ("sequence_id", "bigint"), ("offset", "bigint")]
    n, tokens = check(found, library, rows)
    assert n <= -(-tokens // 2048) + 1


def test_empty_table(docs_of):
    assert binslack.packed(docs_of([]), tokenizer_path()).count() == 0


def test_sequences_hold_the_tokens(docs_of, messy, library):
    found = binslack.packed(docs_of(messy), tokenizer_path(), 64, with_ids=True).cache()
    tokens = {r.sequence_id: r.ids for r in binslack.sequences(found).collect()}
    for r in found.collect():
        assert tokens[r.sequence_id][r.offset : r.offset + r.length] == r.ids and len(r.ids) == r.length
    assert Counter(itertools.chain(*tokens.values())) == Counter(i for _, t in messy for i in ids_of(library, t))


def test_fullest_combination():
    """The bitset finds what trying everything finds."""
    rng = random.Random(4)
    for _ in range(300):
        lengths = Counter(rng.randint(1, 30) for _ in range(rng.randint(1, 9)))
        chosen = binslack.fullest(lengths, 40)
        items = list(lengths.elements())
        first = max(items)
        items.remove(first)
        best = max(s for r in range(len(items) + 1) for c in itertools.combinations(items, r) if (s := first + sum(c)) <= 40)
        assert sum(n * m for n, m in chosen.items()) == best
        assert all(m <= lengths[n] for n, m in chosen.items()) and chosen[first] >= 1


def test_combinations_do_not_grow_with_the_table():
    counts = {n: 10**9 + 7 * n for n in range(1, 2049)}
    todo = binslack.plan(counts)
    # No two pieces of over half share a sequence, and no three of half.
    assert todo.sequences == sum(c for n, c in counts.items() if n > 1024) + -(-counts[1024] // 2)
    assert len(todo.length) < 2048 * 12
    sequence, offset = todo.place(np.array([2048, 1]), np.array([5, 10**9]))
    assert offset[0] == 0 and 0 <= sequence.max() < todo.sequences


def test_words_equal_the_library(library):
    rng = random.Random(1)
    bits = ["a", "B", "é", "É", "ß", "×", "÷", "'", "'s", "'ll", "1", "23", "²", "½", " ", "\n", "\t", " ", "́", "क़", "য়", "<|",
            "<|endoftext|>", "<|startoftext|>", "!", "?", ".", "Σ", "ς", "İ", "漢", "👍", "\x00", "\x0b", "\x1c", "\x85", " ", "ﬁ", "ª", "µ", "Ÿ"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randint(0, 25))) for _ in range(5000)] + [""]
    ids, begins = wordids.WordIds(tokenizer_path()).encode(pa.array(texts))
    for i, text in enumerate(texts):
        assert ids[begins[i] : begins[i + 1]].tolist() == ids_of(library, text)[:-1], text


def test_words_in_stretches_and_with_little_memory(library, monkeypatch):
    monkeypatch.setattr(wordids, "TEXT_BYTES", 100)
    monkeypatch.setattr(wordids, "KEPT_BYTES", 2000)
    words = wordids.WordIds(tokenizer_path())
    texts = [" ".join(f"Long{i}x{j}, it's" for i in range(200)) for j in range(3)] + ["x" * 1000, " " * 700, "short"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    done = [words.encode(b.column("text")) for b in wordids.by_bytes(iter([batch]))]
    assert [ids[s:e].tolist() for ids, at in done for s, e in zip(at, at[1:])] == [ids_of(library, t)[:-1] for t in texts]
    assert words.held < 20_000 * 150
