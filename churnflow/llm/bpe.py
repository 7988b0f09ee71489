"""Encoding and decoding with a public word-level BPE vocabulary, reusing content-defined chunks.

Texts are cut where a rolling hash of the last bytes has a given form, so that a passage is cut alike in every
document. A chunk that was seen before isn't encoded again: of every different chunk, the ids between its first and its
last white space are kept. A cut may fall inside a word, and the tokens beside it are then not those of the whole text:
each join is repaired by encoding the text across it anew, from the last white space before the cut to the first after
it, over as many chunks as lie between. White space ends every token of this vocabulary, so beyond these two places old
and new tokens agree.

All of this is done for a batch of texts at once, as arrays. What is remembered is bounded in bytes and ends with its task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnflow.llm.common import documents_of
from churnflow.llm.packing import Rolling, mixed
from churnflow.llm.wordids import WordIds, by_bytes

#: Bytes that the rolling hash sees; a cut is made after about every 2**CUT_BITS bytes.
SEEN, CUT_BITS = 12, 7
#: Bytes of text taken at once, bytes hashed at once, and what remembered chunks take at most.
TEXT_BYTES, HASHED_BYTES, CHUNK_BYTES_KEPT = 4 << 20, 1 << 20, 32 << 20
#: What a remembered chunk costs beside four times its bytes.
_CHUNK_BYTES = 200
_OF_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
#: White space that ends a token whatever stands beside it.
_SPACE = np.isin(np.arange(256), list(b" \t\n\r"))


def cuts(data: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Ends of chunks: where the hash of the SEEN bytes before, all of one text, has zeros in its upper bits, and where a
    text ends."""
    found = [begins[1:]]
    for at in range(0, len(data), HASHED_BYTES):
        h = Rolling(_OF_BYTE[data[at : at + HASHED_BYTES + SEEN - 1]]).every(SEEN)
        found.append(np.flatnonzero(h >> np.uint64(64 - CUT_BITS) == 0) + at + SEEN)
    ends = np.unique(np.concatenate(found))
    # The bytes seen before a text's end needn't be its own.
    text = np.searchsorted(begins, ends - 1, side="right") - 1
    own = (begins[text] <= ends - SEEN) | np.isin(ends, begins[1:])
    return ends[own & (ends > 0)]


def _stretches(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.StringArray:
    """Ascending stretches of the bytes that share none."""
    step = np.zeros(len(data) + 1, np.int32)
    np.add.at(step, starts, 1)
    np.subtract.at(step, ends, 1)
    kept = data[np.cumsum(step[:-1], dtype=np.int8).astype(bool)]
    bounds = np.append(0, np.cumsum(ends - starts)).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(kept))


def _gather(ids: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    at = np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)
    return ids[at + np.arange(len(at))]


class Encoder:
    """Encodes batches of texts. One task's helper: what it remembers goes with it."""

    def __init__(self, path: str):
        self.words = WordIds(path)
        self.tokenizer = self.words.tokenizer
        self.tokens = pa.array(
            [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size(with_added_tokens=True))], pa.string())
        self._forget()

    def _forget(self) -> None:
        #: Numbers of chunks. Of each: bytes before its first white space (-1 without any) and behind its last, where the
        #: ids between them are, and how many.
        self.chunks: dict[bytes, int] = {}
        self.head, self.tail, self.start, self.size = (np.zeros(0, np.int64) for _ in range(4))
        self.ids = np.zeros(0, np.int32)
        self.held = 0

    def _encoded(self, text: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """As ``words.encode``, a bounded number of bytes at a time."""
        parts, begins = [np.zeros(0, np.int32)], [np.zeros(1, np.int64)]
        for batch in by_bytes(iter([pa.RecordBatch.from_arrays([text], names=["text"])]), size=TEXT_BYTES):
            ids, ends = self.words.encode(batch.column("text"))
            begins.append(ends[1:] + begins[-1][-1])
            parts.append(ids)
        return np.concatenate(parts), np.concatenate(begins)

    def _learn(self, new: pa.BinaryArray, names: list[bytes]) -> None:
        offsets = np.frombuffer(new.buffers()[1], np.int32)[new.offset : new.offset + len(new) + 1].astype(np.int64)
        data = np.frombuffer(new.buffers()[2], np.uint8)
        space = np.flatnonzero(_SPACE[data[: offsets[-1]]])
        first, last = np.searchsorted(space, offsets[:-1]), np.searchsorted(space, offsets[1:]) - 1
        some = last >= first
        head, tail = np.full(len(new), -1), np.zeros(len(new), np.int64)
        since, until = space[first[some]], space[last[some]] + 1
        head[some] = since - offsets[:-1][some]
        tail[some] = offsets[1:][some] - until
        ids, begins = self._encoded(_stretches(data, since, until))
        start, size = np.zeros(len(new), np.int64), np.zeros(len(new), np.int64)
        start[some], size[some] = begins[:-1] + len(self.ids), np.diff(begins)
        self.chunks.update(zip(names, range(len(self.chunks), len(self.chunks) + len(names))))
        self.head, self.tail, self.start, self.size, self.ids = (
            np.concatenate(pair) for pair in ((self.head, head), (self.tail, tail), (self.start, start), (self.size, size), (self.ids, ids)))
        self.held += 4 * int(offsets[-1]) + _CHUNK_BYTES * len(names)

    def encode(self, text: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text's ids begin, with their number at the end."""
        offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
        begins = offsets - offsets[0]
        ends = cuts(data, begins)
        chunks = pa.BinaryArray.from_buffers(
            pa.binary(), len(ends), [None, pa.py_buffer(np.append(0, ends).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
        coded = chunks.dictionary_encode()
        if self.held > CHUNK_BYTES_KEPT:
            self._forget()
        different = coded.dictionary.to_pylist()
        new = [i for i, piece in enumerate(different) if piece not in self.chunks]
        if new:
            self._learn(coded.dictionary.take(pa.array(new)), [different[i] for i in new])
        of = np.array([self.chunks[piece] for piece in different], np.int64)
        chunk = of[np.asarray(coded.indices)] if len(coded) else np.zeros(0, np.int64)
        # What is taken over of each chunk with white space, as places in the batch.
        some = self.head[chunk] >= 0
        chunk, starts, ends = chunk[some], np.append(0, ends)[:-1][some], ends[some]
        since, until = starts + self.head[chunk], ends - self.tail[chunk]
        # What lies between, before and behind in each text is encoded anew.
        of_text = np.searchsorted(begins, starts, side="right") - 1
        before = np.searchsorted(of_text, np.arange(len(begins)))
        joins, join_begins = self._encoded(_stretches(
            data, np.insert(until, before[:-1], begins[:-1]), np.insert(since, before[1:], begins[1:])))
        # Each join is followed by what is taken over behind it, if anything in its text.
        sizes = np.zeros((len(since) + len(text), 2), np.int64)
        sizes[:, 0] = np.diff(join_begins)
        followed = np.delete(np.arange(len(sizes)), before[1:] + np.arange(len(text)))
        sizes[followed, 1] = self.size[chunk]
        own = np.repeat(np.tile([True, False], len(sizes)), sizes.ravel())
        out = np.empty(len(own), np.int32)
        out[own] = joins
        out[~own] = _gather(self.ids, self.start[chunk], self.size[chunk])
        total = np.append(0, np.cumsum(sizes.sum(axis=1)))
        return out, total[before + np.arange(len(begins))]

    def decode(self, ids: pa.ListArray) -> pa.Array:
        """The text of each list of ids."""
        if self.tokenizer.decoder is not None:
            return pa.array(self.tokenizer.decode_batch(ids.to_pylist(), skip_special_tokens=False), pa.string())
        # Without a decoder, the library joins the token strings with spaces.
        return pc.binary_join(pa.ListArray.from_arrays(ids.offsets, self.tokens.take(ids.values)), " ")


def encode_decode(documents: DataFrame, path: str) -> DataFrame:
    """Per row: ``doc_id``, ``ids`` (as the tokenizer at ``path`` encodes the whole text, without added special tokens)
    and ``decoded`` (as it decodes them, special tokens kept).

    A null text is empty and gives no ids; rows that repeat are kept, and so is a null id.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in by_bytes(batches, size=TEXT_BYTES):
            ids, begins = encoder.encode(batch.column("text"))
            lists = pa.ListArray.from_arrays(pa.array(begins.astype(np.int32)), pa.array(ids))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists, encoder.decode(lists)], names=["doc_id", "ids", "decoded"])

    return documents_of(documents).withColumn("text", F.coalesce("text", F.lit(""))).mapInArrow(run, "doc_id long, ids array<int>, decoded string")


def digests() -> list[Column]:
    """``n_tokens``, and hashes of the decimal ids, joined by a space, and of the decoded text."""
    return [
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    ]
