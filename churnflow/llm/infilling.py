"""Fill-in-middle transformation, its cuts found through a learned rank index.

A text is cut at line ends only. The offsets of all boundaries of a batch, rank by rank, are fitted by straight segments
that miss none by more than a bound; what each misses is stored in a byte. The offset of any boundary is then its
segment's prediction and the stored residual: two small lookups, however long the text, and exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnflow.llm.common import documents_of
from churnflow.llm.wordids import by_bytes

#: Percent of documents that are transformed, and of those the percent with the suffix first.
RATE, SUFFIX_FIRST, SEED = 100, 50, 7
#: What a segment may miss an offset by; with rounding, residuals fit one signed byte.
BOUND = 125

# What stands before the prefix, the suffix and the middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
_MARKS = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE))


@dataclass(frozen=True)
class RankIndex:
    """Ascending offsets by rank, as segments (first rank, its offset, slope) and one residual per rank."""

    ranks: np.ndarray
    offsets: np.ndarray
    slopes: np.ndarray
    residuals: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, bound: int = BOUND) -> RankIndex:
        """Each segment is as long as some slope from its first offset stays within the bound of all of it."""
        ranks, firsts, slopes = [], [], []
        low, high, rank, first = 0.0, np.inf, 0, 0
        for i, y in enumerate(offsets.tolist()):
            if not i:
                ranks, firsts, first = [0], [y], y
                continue
            run, rise = i - rank, y - first
            a, b = max(low, (rise - bound) / run), min(high, (rise + bound) / run)
            if a <= b:
                low, high = a, b
                continue
            slopes.append((low + high) / 2 if high < np.inf else low)
            ranks.append(i)
            firsts.append(y)
            low, high, rank, first = 0.0, np.inf, i, y
        if ranks:
            slopes.append((low + high) / 2 if high < np.inf else low)
        index = cls(np.array(ranks, np.int64), np.array(firsts, np.int64), np.array(slopes), np.zeros(len(offsets), np.int8))
        index.residuals[:] = offsets - index.predicted(np.arange(len(offsets)))
        return index

    def predicted(self, rank: np.ndarray) -> np.ndarray:
        segment = np.searchsorted(self.ranks, rank, side="right") - 1
        return self.offsets[segment] + np.rint(self.slopes[segment] * (rank - self.ranks[segment])).astype(np.int64)

    def at(self, rank: np.ndarray) -> np.ndarray:
        """The exact offsets."""
        return self.predicted(rank) + self.residuals[rank]


def draws(doc_id: int | None, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document; without an id, those of an empty number."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in range(0, 16, 4))


def boundaries(data: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The offsets of all boundaries, text by text, where those of each text begin, with their number at the end.

    A text of n lines has n + 1 boundaries: its start and the end of each line; its last line may lack a line feed.
    """
    ends = np.flatnonzero(data == 0x0A) + 1
    # A rest behind the last line feed is a line.
    full = begins[1:] > begins[:-1]
    last = begins[1:][full]
    rest = last[data[last - 1] != 0x0A] if len(last) else last
    inner = np.sort(np.concatenate([ends, rest]))
    lines = np.searchsorted(inner, begins, side="right")
    at = np.insert(inner, lines[:-1], begins[:-1])
    return at, lines + np.arange(len(begins))


def transformed(documents: DataFrame, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """Per row: ``doc_id``, ``n`` (lines), ``form`` (plain, psm or spm), ``prefix_chars`` and ``middle_chars`` (code points; null
    if plain) and ``output``.

    A null text is empty. Empty texts and those that hold one of the marks stay plain. Cuts and form follow from the seed
    and ``doc_id`` alone, so rows that repeat get the same; a null id draws as an empty number. Nothing is shuffled.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches):
            text = batch.column("text")
            begins = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1].astype(np.int64)
            whole = memoryview(text.buffers()[2] or b"")[begins[0] : begins[-1]]
            begins -= begins[0]
            data = np.frombuffer(whole, np.uint8)
            offsets, first = boundaries(data, begins)
            index = RankIndex.fit(offsets)
            n = np.diff(first) - 1
            drawn = np.array([draws(i, seed) for i in batch.column("doc_id").to_pylist()], np.int64).reshape(-1, 4)
            h1, h2 = drawn[:, 0] % (n + 1), drawn[:, 1] % (n + 1)
            one, two = (index.at(first[:-1] + h).tolist() for h in (np.minimum(h1, h2), np.maximum(h1, h2)))
            forms, outputs, sizes = [], [], []
            for i, (since, until) in enumerate(zip(begins[:-1].tolist(), begins[1:].tolist())):
                raw = bytes(whole[since:until])
                if not raw or drawn[i, 2] % 100 >= rate or any(m in raw for m in _MARKS):
                    forms.append("plain")
                    outputs.append(raw)
                    sizes.append((None, None))
                    continue
                prefix, middle, suffix = raw[: one[i] - since], raw[one[i] - since : two[i] - since], raw[two[i] - since :]
                p, s, m = _MARKS
                spm = drawn[i, 3] % 100 < suffix_first
                forms.append("spm" if spm else "psm")
                outputs.append(b"".join((s, suffix, p, prefix, m, middle) if spm else (p, prefix, s, suffix, m, middle)))
                sizes.append((len(prefix.decode("utf-8")), len(middle.decode("utf-8"))))
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n), pa.array(forms, pa.string()), pa.array([a for a, _ in sizes], pa.int64()),
                pa.array([b for _, b in sizes], pa.int64()), pa.array(outputs, pa.binary()).cast(pa.string()),
            ], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return documents_of(documents).withColumn("text", F.coalesce("text", F.lit(""))).mapInArrow(
        cut, "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made from. A text with a mark of its own is plain, so all marks are ours."""
    parts = F.split(output, "<[PSM]>")
    prefix, suffix = (F.when(form == "spm", F.get(parts, F.lit(b))).otherwise(F.get(parts, F.lit(a))) for a, b in ((1, 2), (2, 1)))
    return F.when(form == "plain", output).otherwise(F.concat(prefix, F.get(parts, F.lit(3)), suffix))
