"""Removal of repeated word windows, counted by Rabin-Karp hashes.

Every window of a document gets a rolling 64-bit hash. The hash's upper bits name a bucket, and each bucket meets in one
task, which tells the first document of every window and sends the others word. Hashes travel packed, many to a
row. A task that reads documents first settles what repeats among its own, and sends on only the first document
of each window: a window found in a third of all documents reaches its bucket once per chunk of words, not once
per document. At last each document's repeated windows merge into maximal intervals, which are cut out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnflow.llm.common import documents_of
from churnflow.llm.packing import Rolling, bucket_of, group_of, in_groups, narrow, pack56, runs, unpack56, wide

WINDOW = 50
#: Windows that a reading task holds before it sends them on.
CHUNK = 3_000_000
#: Words, as estimated from the length of all texts, to a bucket; bytes of text to a group of the last step.
BUCKET_WORDS, GROUP_BYTES = 1 << 19, 1 << 21


def window_hashes(words: list[bytes], window: int) -> np.ndarray:
    """The hash of every window of so many consecutive words; none if there are fewer words."""
    if len(words) < window:
        return np.zeros(0, np.uint64)
    return Rolling(pd.util.hash_array(np.array(words, dtype=object), categorize=False)).every(window)


def words_of(text: str | None) -> list[bytes]:
    """Runs without ASCII white space."""
    return (text or "").encode("utf-8", "surrogatepass").split()


#: kind 0 asks a bucket (``at``) for the first document of hashes, kind 1 is word for a group (``at``) of documents.
_MESSAGE = "kind int, at long, docs binary, hashes binary"
_MESSAGES = pa.schema([("kind", pa.int32()), ("at", pa.int64()), ("docs", pa.binary()), ("hashes", pa.binary())])

_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()),
    ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.string()),
])


def _messages(kind: int, at: np.ndarray, docs: np.ndarray, packed: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One row for each value of ``at``, its documents ascending."""
    order = np.lexsort((docs, at))
    at, docs, packed = at[order], docs[order], packed[order]
    starts = runs(at)
    ends = np.append(starts[1:], len(at))
    for i in range(0, len(starts), 256):
        some = list(zip(starts[i : i + 256], ends[i : i + 256]))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(some), kind, np.int32)), pa.array(at[starts[i : i + 256]]),
            pa.array([narrow(docs[s:e]) for s, e in some], pa.binary()),
            pa.array([packed[s:e].astype("<u8").tobytes() if kind else pack56(packed[s:e]) for s, e in some], pa.binary()),
        ], schema=_MESSAGES)


def _after_first(h: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which entries, sorted by hash and document, are the first of their hash, and which a later document's first."""
    new = np.append(True, h[1:] != h[:-1])
    other = np.append(True, docs[1:] != docs[:-1]) | new
    least = docs[np.flatnonzero(new)[np.cumsum(new) - 1]]
    return new, other & (docs > least)


def repeated_windows(documents: DataFrame, window: int, bits: int, n_groups: int, chunk: int = CHUNK) -> DataFrame:
    """(at, docs, hashes): for each group of documents, documents and windows that also start in a smaller one."""

    def settled(h: np.ndarray, docs: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], Iterator[pa.RecordBatch]]:
        order = np.lexsort((docs, h))
        h, docs = h[order], docs[order]
        first, later = _after_first(h, docs)
        return (h[first], docs[first]), _messages(1, group_of(docs[later], n_groups), docs[later], h[later])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def send() -> Iterator[pa.RecordBatch]:
            h = np.concatenate([x for _, x in held])
            docs = np.repeat(np.array([d for d, _ in held], np.int64), [len(x) for _, x in held])
            held.clear()
            (h, docs), word = settled(h, docs)
            yield from word
            yield from _messages(0, bucket_of(h, bits), docs, h)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                if doc_id.is_valid and len(h := window_hashes(words_of(text.as_py()), window)):
                    held.append((doc_id.as_py(), h))
                    n += len(h)
                    if n >= chunk:
                        yield from send()
                        n = 0
        if held:
            yield from send()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, held = None, []

        def told() -> Iterator[pa.RecordBatch]:
            if held:
                h, docs = np.concatenate([h for h, _ in held]), np.concatenate([d for _, d in held])
                held.clear()
                yield from settled(h, docs)[1]

        for batch in batches:
            asks = pc.equal(batch.column("kind"), 0)
            yield batch.filter(pc.invert(asks))
            for row in batch.filter(asks).to_pylist():
                if row["at"] != bucket:
                    yield from told()
                    bucket = row["at"]
                held.append((unpack56(row["hashes"], bucket, bits), wide(row["docs"])))
        yield from told()

    asked = documents_of(documents).mapInArrow(read, _MESSAGE)
    return asked.repartition("at").sortWithinPartitions("kind", "at").mapInArrow(answer, _MESSAGE).drop("kind")


def _cut(words: list[bytes], hit: np.ndarray, window: int) -> tuple[list[tuple[int, int]], list[bytes]]:
    """Maximal intervals covered by windows that start where ``hit`` is true, and the words outside."""
    starts = np.flatnonzero(hit)
    edge = np.flatnonzero(np.diff(starts) > window)
    spans = list(zip(starts[np.append(0, edge + 1)].tolist(), (starts[np.append(edge, len(starts) - 1)] + window).tolist())) if len(starts) else []
    kept, at = [], 0
    for s, e in spans:
        kept += words[at:s]
        at = e
    return spans, kept + words[at:]


def without_repeated_windows(documents: DataFrame, window: int = WINDOW, chunk: int = CHUNK) -> DataFrame:
    """Per row: ``doc_id``, ``n_words``, ``removed`` (maximal intervals of words, end exclusive), ``kept`` (the other
    words joined by one space).

    A word goes if a window of consecutive words that covers it also starts in a document with a smaller id.
    Windows are told apart by 64-bit hashes. A null text has no words. Rows without an id are left whole and
    nobody's earlier copy. Rows that share an id don't touch one another, and a window of any of them counts for the id.
    """
    length = documents_of(documents).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = max(10, (length // 6 // BUCKET_WORDS).bit_length())
    n_groups = max(64, length // GROUP_BYTES)

    def finish(docs: pa.Table, word: pa.Table) -> pa.Table:
        told: dict[int, np.ndarray] = {}
        if word.num_rows:
            ids = np.concatenate([wide(b.as_py()) for b in word["docs"]])
            h = np.concatenate([np.frombuffer(b.as_py(), "<u8") for b in word["hashes"]])
            order = np.argsort(ids, kind="stable")
            ids, h = ids[order], h[order]
            starts = runs(ids)
            told = {int(ids[s]): x for s, x in zip(starts, np.split(h, starts[1:]))}
        out = []
        for doc_id, text in zip(docs["doc_id"].to_pylist(), docs["text"]):
            words = words_of(text.as_py())
            h = told.get(doc_id)
            spans, kept = _cut(words, np.isin(window_hashes(words, window), h), window) if h is not None else ([], words)
            out.append({"doc_id": doc_id, "n_words": len(words), "removed": [{"start": s, "end": e} for s, e in spans],
                        "kept": b" ".join(kept).decode("utf-8", "surrogatepass")})
        return pa.Table.from_pylist(out, schema=_RESULT)

    told = repeated_windows(documents, window, bits, n_groups, chunk)
    return in_groups(documents, n_groups).groupBy("at").cogroup(told.groupBy("at")).applyInArrow(
        finish, "doc_id long, n_words long, removed array<struct<start: int, end: int>>, kept string")
