"""Packing documents into sequences by minimum bin slack, over counts of lengths.

Documents become pieces of at most one sequence's capacity, and pieces of one length are alike, so that the whole table
is known by how many pieces there are of each length: one number per length up to the capacity, whatever the size of
the corpus. For each sequence, a subset-sum over the lengths that are left, kept as a bitset, finds the fullest feasible
combination with the longest piece left; the combination is taken as often as its lengths last, since nothing fuller
turns up while less is left. So every combination uses up a length, and there are no more combinations than
lengths. Pieces are numbered within their length without a sort: each task numbers its own, and running totals of the
tasks' counts shift them. A piece's number then tells its sequence and its place there.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnflow.llm.common import documents_of, stored
from churnflow.llm.wordids import WordIds, by_bytes

CAPACITY = 2048
#: The id that ends every document.
END = 0

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part long, nth long"


def fullest(lengths: Mapping[int, int], capacity: int) -> dict[int, int]:
    """The fullest combination within the capacity that holds the greatest length; of equally full ones, one of long pieces.

    ``lengths`` counts what is left of each length.
    """
    descending = sorted((n for n, count in lengths.items() if count), reverse=True)
    first = descending[0]
    room = capacity - first
    mask, reach = (1 << (room + 1)) - 1, 1
    steps: list[tuple[int, int, int]] = []
    for n in descending:
        left = min(lengths[n] - (n == first), room // n)
        many = 1
        while left > 0 and not reach >> room & 1:
            many = min(many, left)
            steps.append((n, many, reach))
            reach = (reach | reach << n * many) & mask
            left, many = left - many, 2 * many
        if reach >> room & 1:
            break
    at, chosen = reach.bit_length() - 1, {first: 1}
    for n, many, before in reversed(steps):
        if not before >> at & 1:
            at -= n * many
            chosen[n] = chosen.get(n, 0) + many
    return chosen


@dataclass(frozen=True)
class Plan:
    """Which numbers of which length go where: rows sorted by length and first number."""

    length: np.ndarray
    since: np.ndarray
    many: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray
    sequences: int

    def place(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the pieces with these lengths and, within them, numbers."""
        # Both keys as one: numbers stay below 2**44, capacities below 2**19.
        row = np.searchsorted((self.length << 44) + self.since, (length << 44) + number, side="right") - 1
        repeat, copy = np.divmod(number - self.since[row], self.many[row])
        return self.sequence[row] + repeat, self.offset[row] + copy * length


def plan(counts: Mapping[int, int], capacity: int = CAPACITY) -> Plan:
    """Combinations for all pieces, given how many there are of each length."""
    left = {n: count for n, count in counts.items() if count}
    used = dict.fromkeys(left, 0)
    rows, sequences = [], 0
    while left:
        chosen = fullest(left, capacity)
        times = min(left[n] // many for n, many in chosen.items())
        offset = 0
        for n, many in chosen.items():
            rows.append((n, used[n], many, sequences, offset))
            used[n] += many * times
            left[n] -= many * times
            if not left[n]:
                del left[n]
            offset += n * many
        sequences += times
    columns = np.array(sorted(rows), np.int64).reshape(-1, 5).T
    return Plan(*columns, sequences)


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Per piece: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``ids`` if wanted, and its number ``nth``
    among the pieces of its length that the task ``part`` made."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, part = WordIds(path), TaskContext.get().partitionId()
        made = np.zeros(capacity + 1, np.int64)
        for batch in by_bytes(batches):
            ids, begins = words.encode(batch.column("text"))
            # Every document ends with a token of its own.
            flat = np.insert(ids, begins[1:], END).astype("<u4")
            begins = begins + np.arange(len(begins))
            per_row = -(-np.diff(begins) // capacity)
            row = np.repeat(np.arange(len(per_row)), per_row)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
            start = piece * capacity
            since = begins[row] + start
            until = np.minimum(since + capacity, begins[row + 1])
            length = until - since
            crc = [zlib.crc32(flat[s:e]) for s, e in zip(since.tolist(), until.tolist())]
            # Numbers continue, per length, where the batch before ended.
            order = np.argsort(length, kind="stable")
            sizes = np.bincount(length, minlength=capacity + 1)
            nth = np.empty(len(length), np.int64)
            nth[order] = np.arange(len(length)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(made, sizes)
            made += sizes
            columns = [
                batch.column("doc_id").take(pa.array(row)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length),
                pa.array(np.array(crc, np.int64)), pa.array(np.full(len(row), part)), pa.array(nth),
            ]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(pa.array(np.append(since, until[-1:]).astype(np.int32)), pa.array(flat.view("<i4"))))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = _PIECES + (", ids array<int>" if with_ids else "")
    names = [field.split()[0] for field in schema.split(", ")]
    return documents_of(documents).withColumn("text", F.coalesce("text", F.lit(""))).mapInArrow(cut, schema)


def packed(documents: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """Per piece of a document: ``doc_id``, ``piece``, ``start``, ``length``, ``ids_crc32``, ``sequence_id`` (from 0, without
    gaps), ``offset`` in the sequence and, if wanted, ``ids``.

    A document is its ids by the tokenizer at ``path`` and END; only longer ones than ``capacity`` are cut. A null
    text is empty, so it is one END. Rows that repeat, whole or by their id, are documents of their own, and a null id is
    kept. No documents, no pieces.
    """
    # Numbers within a task hold for one run of it, so they are written before anything counts them.
    made = stored(pieces(documents, path, capacity, with_ids), "packing-pieces")
    counts = stored(made.groupBy("length", "part").agg(F.count("*").alias("n")), "packing-counts")
    # At most one row per length.
    totals = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    todo = plan(totals, capacity)
    earlier = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    before = counts.select("length", "part", F.coalesce(earlier, F.lit(0)).alias("before"))
    names = [c for c in made.columns if c not in ("part", "nth")]

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = np.asarray(batch.column("length"))
            sequence, offset = todo.place(length, np.asarray(batch.column("number")))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    numbered = made.join(before, ["length", "part"]).select(*names, (F.col("nth") + F.col("before")).alias("number"))
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema if f.name in names)
    return numbered.mapInArrow(put, f"{schema}, sequence_id long, offset long")


def sequences(pieces_with_ids: DataFrame) -> DataFrame:
    """(sequence_id, ids): the tokens of each sequence, from ``packed(..., with_ids=True)``. A sequence holds few pieces."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    return pieces_with_ids.groupBy("sequence_id").agg(F.flatten(F.transform(inside, lambda x: x.ids)).alias("ids"))
