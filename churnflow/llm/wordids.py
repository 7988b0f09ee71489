"""Token ids of whole columns of text, each different piece of a text encoded once per task.

The tokenizer of ``bpe`` never joins bytes across white space, and takes letters, single digits and other signs apart.
A column's bytes are cut at these places as arrays, equal pieces are found by Arrow's dictionary encoding, and only the
pieces not seen before reach the tokenizer. Pieces whose cutting depends on more than their bytes (letters beyond
Latin-1, contractions, control characters, the strings of special tokens) stay whole between white space.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes of text taken at once, and bytes of remembered pieces at most.
TEXT_BYTES, KEPT_BYTES = 8 << 20, 96 << 20
#: What a remembered piece costs beside its bytes: a bytes object, its place in the table, its ids.
_PIECE_BYTES = 150
#: Pieces sent to the tokenizer in one line, between two special tokens.
_IN_LINE = 64

_SPACE, _LETTER, _DIGIT, _SIGN, _HARD = range(5)


def _kinds() -> np.ndarray:
    kind = np.full(256, _HARD, np.uint8)
    kind[0x21:0x7F] = _SIGN
    for c in range(0x21, 0x7F):
        if chr(c).isalpha():
            kind[c] = _LETTER
        elif chr(c).isdigit():
            kind[c] = _DIGIT
    kind[list(b" \t\n\r")] = _SPACE
    # What follows an apostrophe may belong to it.
    kind[ord("'")] = _HARD
    return kind


_KIND = _kinds()
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def pieces(text: pa.StringArray) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The pieces of all texts, one after another, and where each text's pieces begin, with their number at the end."""
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        return pa.array([], pa.binary()).dictionary_encode(), np.zeros(len(text) + 1, np.int64)
    kind, low = _KIND[data], _LOWER[data]
    # The letters of Latin-1 are pairs of bytes that begin with C3.
    pair = np.flatnonzero(data[:-1] == 0xC3)
    second = data[pair + 1]
    letter = (second != 0x97) & (second != 0xB7)
    kind[pair[letter]] = kind[pair[letter] + 1] = _LETTER
    low[pair[letter & (second < 0x9F)] + 1] += 32
    kind[np.flatnonzero((data[:-1] == ord("<")) & (data[1:] == ord("|")))] = _HARD
    seen = kind != _SPACE
    word = seen.copy()
    word[1:] &= ~seen[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    word[begins] = seen[begins]
    start = word.copy()
    start[1:] |= seen[1:] & ((kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT))
    hard = np.flatnonzero(kind == _HARD)
    if len(hard):
        at = np.flatnonzero(word)
        whole = np.unique(np.searchsorted(at, hard, side="right") - 1)
        ends = np.append(at[1:], len(data))
        # Marks the bytes of whole words, by what opens and closes them.
        step = np.zeros(len(data) + 1, np.int8)
        step[at[whole]] += 1
        np.subtract.at(step, ends[whole], 1)
        inside = np.cumsum(step[:-1], dtype=np.int8).astype(bool)
        start = np.where(inside, word, start)
        low = np.where(inside, data, low)
    first = np.flatnonzero(start[seen])
    kept = low[seen]
    bounds = np.append(first, len(kept)).astype(np.int32)
    array = pa.BinaryArray.from_buffers(pa.binary(), len(first), [None, pa.py_buffer(bounds), pa.py_buffer(kept)])
    return array.dictionary_encode(), np.searchsorted(np.flatnonzero(start), offsets).astype(np.int64)


def stretches(text: pa.StringArray) -> list[pa.StringArray]:
    """The column itself, or the stretches of a single long text, of about TEXT_BYTES each, that end with white space."""
    if len(text) != 1:
        return [text]
    first, last = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + 2].tolist()
    if last - first <= 2 * TEXT_BYTES:
        return [text]
    space = np.flatnonzero(_KIND[np.frombuffer(text.buffers()[2], np.uint8)[first:last]] == _SPACE) + first
    cut = space[np.unique(np.searchsorted(space, np.arange(first + TEXT_BYTES, last, TEXT_BYTES)).clip(max=max(len(space) - 1, 0)))] if len(space) else space
    bounds = np.unique([first, *cut.tolist(), last]).astype(np.int32)
    return [pa.StringArray.from_buffers(1, pa.py_buffer(bounds[i : i + 2].copy()), text.buffers()[2]) for i in range(len(bounds) - 1)]


class WordIds:
    """Encodes columns of texts as the tokenizer at ``path`` does, without added special tokens. One task's helper: what
    it remembers is bounded in bytes and goes with it."""

    def __init__(self, path: str):
        # One thread: the cores belong to other tasks.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        special = next(iter(sorted(self.tokenizer.get_added_tokens_decoder())))
        self.between, self.between_id = self.tokenizer.id_to_token(special), special
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 16, np.int32)
        self.ends = np.zeros(1 << 14, np.int64)
        self.held = 0

    def _append(self, ids: np.ndarray, sizes: np.ndarray, new: list[bytes]) -> None:
        n = len(self.place)
        end = int(self.ends[n])
        while len(self.ids) < end + len(ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.ends) < n + len(new) + 1:
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ids[end : end + len(ids)] = ids
        self.ends[n + 1 : n + 1 + len(new)] = end + np.cumsum(sizes)
        self.place.update(zip(new, range(n, n + len(new))))
        self.held += sum(map(len, new)) + _PIECE_BYTES * len(new)

    def _learn(self, new: list[bytes]) -> None:
        marked = self.between.encode()
        plain = [p for p in new if marked not in p]
        lines = [self.between.join(p.decode("utf-8") for p in plain[i : i + _IN_LINE]) for i in range(0, len(plain), _IN_LINE)]
        for i in range(0, len(lines), 256):
            some = self.tokenizer.encode_batch_fast(lines[i : i + 256], add_special_tokens=False)
            ids = np.concatenate([x for e in some for x in (np.array(e.ids, np.int32), [self.between_id])])
            cut = np.flatnonzero(ids == self.between_id)
            self._append(np.delete(ids, cut), np.diff(cut, prepend=-1) - 1, plain[i * _IN_LINE : (i + 256) * _IN_LINE])
        for p in new:
            if marked in p:
                ids = np.array(self.tokenizer.encode(p.decode("utf-8"), add_special_tokens=False).ids, np.int32)
                self._append(ids, np.array([len(ids)]), [p])

    def encode(self, text: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after another, and where each text's ids begin, with their number at the end.

        A very long text is taken in stretches that end with white space, where no token crosses.
        """
        parts = stretches(text)
        if len(parts) == 1:
            return self._encode(text)
        ids = np.concatenate([self._encode(part)[0] for part in parts])
        return ids, np.array([0, len(ids)])

    def _encode(self, text: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        found, begins = pieces(text)
        if self.held > KEPT_BYTES:
            self._forget()
        different = found.dictionary.to_pylist()
        self._learn([p for p in different if p not in self.place])
        place = np.array([self.place[p] for p in different], np.int64)
        codes = place[np.asarray(found.indices)] if len(found) else np.zeros(0, np.int64)
        starts, sizes = self.ends[codes], self.ends[codes + 1] - self.ends[codes]
        total = np.append(0, np.cumsum(sizes))
        at = np.repeat(starts - total[:-1], sizes)
        at += np.arange(total[-1])
        return self.ids[at], total[begins]


def by_bytes(batches: Iterator[pa.RecordBatch], column: str = "text", size: int = TEXT_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``size`` bytes of text; a longer text is a batch of its own."""
    for batch in batches:
        text = batch.column(column)
        if not batch.num_rows:
            continue
        offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]
        at = 0
        while at < len(text):
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, side="right")) - 1)
            yield batch.slice(at, end - at)
            at = end
