import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from churnflow.llm import bpe, wordids

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "a<|endoftext|>b c", "<|startoftext|>", "İstanbul ΑΣ ΣΑΣ σ", "é ́x", "x\x0by\x0cz\x85w q r", "it's we'll 'S I'M don' t",
    "1234 ٣٤", "a" * 5000, "ab " * 3000, "가 ᆨ", "👩‍👩‍👧 z", "\x00\x01 a\x00b", "<|endoftext|> <|endoftext|>x", " lead", "trail \n",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(encoder, texts):
    ids, begins = encoder.encode(pa.array(texts, pa.string()))
    return [ids[s:e].tolist() for s, e in zip(begins, begins[1:])]


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return ids, library.decode(ids, skip_special_tokens=False)


def test_equals_the_library(spark, docs_of, messy, library, sf_dir):
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(300).collect()]
    rows = messy + [(600 + i, t) for i, t in enumerate(ODD + texts)]
    got = bpe.encode_decode(docs_of(rows), PATH).collect()
    assert sorted(repr((r.doc_id, list(r.ids), r.decoded)) for r in got) == sorted(repr((i, *expected(library, t))) for i, t in rows)


@pytest.mark.parametrize("bits", [0, 1, 3])
def test_cuts_inside_words_are_repaired(library, monkeypatch, bits):
    monkeypatch.setattr(bpe, "CUT_BITS", bits) if bits else monkeypatch.setattr(bpe, "cuts", lambda data, begins: np.arange(1, len(data) + 1))
    monkeypatch.setattr(bpe, "HASHED_BYTES", 500)
    rng = random.Random(bits)
    pieces = ["a", "Bb", "'s", " ", "\n", "é", "<|endoftext|>", "12", "--", "ß", "漢", "👍", "\t", "longword", "\x0b"]
    texts = ODD[:9] + ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 120))) for _ in range(150)]
    encoder = bpe.Encoder(PATH)
    for _ in range(2):  # the second time, all chunks are known
        for text, ids in zip(texts, ids_of(encoder, texts)):
            assert ids == expected(library, text)[0], text


def test_letters_that_normalization_takes_apart(library):
    # Letters of Hindi, Bengali, Gurmukhi, Oriya, Tibetan and Hebrew that NFC writes as a letter and a combining mark.
    letters = [chr(c) for c in (0x95D, 0x9DF, 0xA5E, 0xB5C, 0xF43, 0xFB1D, 0xFB2A, 0xFB2C)]
    texts = [f"{word}{mark}" for c in letters for word in (c, f"ab{c}", f"{c}ab", f"AB{c}") for mark in ("", *".,!?;:")]
    texts += ["한,", "한글.", "É! é?", " ".join(texts)]
    for text, ids in zip(texts, ids_of(bpe.Encoder(PATH), texts)):
        assert ids == expected(library, text)[0]


def test_memory_is_bounded(library, monkeypatch):
    monkeypatch.setattr(wordids, "KEPT_BYTES", 5000)
    monkeypatch.setattr(bpe, "CHUNK_BYTES_KEPT", 2000)
    monkeypatch.setattr(bpe, "TEXT_BYTES", 200)
    encoder = bpe.Encoder(PATH)
    for i in range(30):
        texts = [f"text number {i} has words {j} " * 5 for j in range(i, i + 4)]
        for text, ids in zip(texts, ids_of(encoder, texts)):
            assert ids == expected(library, text)[0]
        # A batch may go beyond the bound before the next one forgets.
        assert encoder.held <= 2000 + 4 * 700 + 700 * 200 and encoder.words.held <= 5000 + 700 * 151


def test_nothing_is_remembered_between_tasks(docs_of):
    """Neither the module nor anything it imports keeps an encoder once its task is over."""
    import gc

    rows = [(i, f"some words {i}") for i in range(50)]

    def count(batches):
        gc.collect()
        held = sum(isinstance(o, (bpe.Encoder, wordids.WordIds)) for o in gc.get_objects())
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([held] * batch.num_rows)], names=["held"])

    docs = docs_of(rows, 8)
    bpe.encode_decode(docs, PATH).count()
    # The same workers serve these tasks.
    assert {r.held for r in docs.select("doc_id").mapInArrow(count, "held long").collect()} == {0}


def test_shared_passages_are_cut_alike():
    rng = random.Random(1)
    passage = bytes(rng.randrange(97, 123) for _ in range(4000))
    pieces = []
    for before in (b"", b"something else "):
        raw, at, own = before + passage, 0, []
        for end in bpe.cuts(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])).tolist():
            own.append(raw[at:end])
            at = end
        assert b"".join(own) == raw
        pieces.append(own)
    assert len(set(pieces[0]) & set(pieces[1])) >= len(pieces[0]) - 1


def test_decoders_of_other_tokenizers():
    path = public_tokenizers.path("byte_bpe_50k.json")
    other = Tokenizer.from_file(path)
    ids = other.encode("some text", add_special_tokens=False).ids
    assert bpe.Encoder(path).decode(pa.array([ids], pa.list_(pa.int32()))).to_pylist() == [other.decode(ids, skip_special_tokens=False)]


def test_empty_table(docs_of):
    assert bpe.encode_decode(docs_of([]), PATH).count() == 0
