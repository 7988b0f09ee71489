"""Removal of repeated byte strings with enhanced suffix arrays and the tree of their common-prefix intervals.

A string of LENGTH bytes names one of its short grams as its anchor: the one with the least hash, the leftmost if tied.
Equal strings name the same gram at the same place, so it is enough to compare documents around equal grams. Per
anchor, the bytes that any string with that anchor can reach, its context, decide:

* anchors that occur once are dropped (counted by hash, in buckets; what repeats inside one task is settled there);
* of equal contexts only the first goes on, the others are repeats as a whole;
* different contexts of one anchor form a sparse suffix array: sorted by the bytes from the anchor on, with the
  common prefixes of neighbours. A stack scan of the prefixes yields the tree of common-prefix intervals; inside each
  interval, the same scan over the bytes before the anchor tells whether its members differ to the left, and yields
  every maximal repeat with all its occurrences, not only neighbours. All but the first occurrence go;
* anchors with more than DENSE different contexts, such as those at the edges of a passage that very many documents share,
  don't meet in one task: the hash of every string around them is dealt out instead.

Equal hashes (64 bits) of contexts and of dealt-out strings are taken for equal strings.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnflow.functions.running import running_totals
from churnflow.llm.common import documents_of, keyed, stored
from churnflow.llm.packing import Rolling, bucket_of, group_of, in_groups, mixed, narrow, pack56, runs, unpack56, wide

LENGTH, GRAM, DENSE = 100, 32, 500
#: Anchors, or strings, that a reading task holds before it sends them on.
CHUNK = 1_000_000
#: Bytes of text to a bucket of anchors, and to a group of documents.
BUCKET_BYTES, GROUP_BYTES = 1 << 22, 1 << 21
_OF_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))

#: What is sent. REPEAT: stretches (start, width) of ``docs`` that repeat. ANCHOR: hash, context's hash, place. STRING: hash,
#: place. SPARSE, DENSE_: places of anchors whose contexts are asked for.
REPEAT, ANCHOR, STRING, SPARSE, DENSE_ = range(5)
_MESSAGE = "kind int, at long, docs binary, h binary, c binary, pos binary, width binary"
_MESSAGES = pa.schema([("kind", pa.int32()), ("at", pa.int64()), *((n, pa.binary()) for n in ("docs", "h", "c", "pos", "width"))])


def bytes_of(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _rolling(raw: bytes) -> Rolling:
    return Rolling(_OF_BYTE[np.frombuffer(raw, np.uint8)])


def anchors(raw: bytes, length: int, gram: int, rolling: Rolling) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the grams that are the anchor of at least one string of ``length`` bytes."""
    h = rolling.every(gram)
    width = length - gram + 1
    if len(h) < width:
        return np.zeros(0, np.int64), h[:0]
    # The place in the lower half makes the leftmost of equal upper halves the least.
    least = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(h), dtype=np.uint64)
    span = 1
    while 2 * span <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: len(least) - (width - span)], least[width - span :])
    at = (least & np.uint64(0xFFFFFFFF)).astype(np.int64)
    at = at[runs(at)]
    return at, h[at]


def intervals(common: Sequence[int]) -> Iterator[tuple[int, int, int]]:
    """(depth, first, end) of all common-prefix intervals, inner ones first.

    ``common[i]`` is the length that entries i and i + 1 share. An interval is a longest run of at least two entries
    that all share ``depth``; intervals of depth 0 are left out.
    """
    stack = [(0, 0)]
    for i, depth in enumerate([*common, 0]):
        first = i
        while depth < stack[-1][0]:
            deep, first = stack.pop()
            yield deep, first, i + 1
        if depth > stack[-1][0]:
            stack.append((depth, first))


def _shared(a: bytes, b: bytes) -> int:
    """How many bytes two strings share from their beginnings."""
    n = min(len(a), len(b))
    differ = int.from_bytes(a[:n]) ^ int.from_bytes(b[:n])
    return n - (differ.bit_length() + 7) // 8


def maximal_repeats(contexts: list[tuple[tuple[int, int], bytes, bytes]], length: int) -> Iterator[tuple[int, int, list[tuple[int, int]]]]:
    """(left, right, occurrences): groups of places that share ``left`` bytes before and ``right`` bytes from the
    place on, at least ``length`` in all, and can't be extended without losing one.

    ``contexts`` are (place, bytes before it from right to left, bytes from it on).
    """
    by_right = sorted(contexts, key=lambda c: c[2])
    for right, first, end in intervals([_shared(a[2], b[2]) for a, b in zip(by_right, by_right[1:])]):
        by_left = sorted(by_right[first:end], key=lambda c: c[1])
        before = [_shared(a[1], b[1]) for a, b in zip(by_left, by_left[1:])]
        if right + max(before) < length:
            continue
        whole = [] if min(before) else [(0, 0, len(by_left))]
        for left, a, b in (*intervals(before), *whole):
            # Members that all go on with the same byte are a longer repeat, which an inner interval yields.
            following = {c[2][right : right + 1] for c in by_left[a:b]}
            if left + right >= length and (len(following) > 1 or following == {b""}):
                yield left, right, [c[0] for c in by_left[a:b]]


def _rows(kind: int, at: np.ndarray, docs: np.ndarray, **cells: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One message for each value of ``at``, its documents ascending."""
    order = np.lexsort((docs, at))
    at, docs, cells = at[order], docs[order], {n: x[order] for n, x in cells.items()}
    starts = runs(at)
    ends = np.append(starts[1:], len(at))
    packed = {n: (pack56 if n == "h" else np.ndarray.tobytes) for n in cells}
    for i in range(0, len(starts), 256):
        some = list(zip(starts[i : i + 256], ends[i : i + 256]))
        yield pa.RecordBatch.from_arrays([
            pa.array(np.full(len(some), kind, np.int32)), pa.array(at[starts[i : i + 256]]),
            pa.array([narrow(docs[s:e]) for s, e in some], pa.binary()),
            *(pa.array([packed[n](cells[n][s:e]) for s, e in some], pa.binary()) if n in cells else pa.nulls(len(some), pa.binary())
              for n in ("h", "c", "pos", "width")),
        ], schema=_MESSAGES)


class _Repeats:
    """How each step sends stretches, asks for contexts, and deals out hashes."""

    def __init__(self, length: int, gram: int, dense: int, bits: int, n_groups: int):
        self.length, self.gram, self.dense, self.bits, self.n_groups = length, gram, dense, bits, n_groups
        self.reach = length - gram

    def stretches(self, docs: np.ndarray, start: np.ndarray, width: np.ndarray) -> Iterator[pa.RecordBatch]:
        return _rows(REPEAT, group_of(docs, self.n_groups), docs, pos=start.astype("<u4"), width=width.astype("<u2"))

    def asked(self, kind: int, some: np.ndarray, h: np.ndarray, docs: np.ndarray, pos: np.ndarray) -> Iterator[pa.RecordBatch]:
        return _rows(kind, group_of(docs[some], self.n_groups), docs[some], pos=pos[some].astype("<u4"), c=h[some].astype("<u8"))

    def around(self, pos: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Where the contexts of places in ``n`` bytes begin and end."""
        return np.maximum(pos - self.reach, 0), np.minimum(pos + self.length, n)

    # Anchors: h, context's hash, document, place, and the context's bytes before and from the place on.

    def settle_anchors(self, h, c, docs, pos, left, right):
        """Of equal contexts the first stays; the others are sent as repeats."""
        order = np.lexsort((pos, docs, c, h))
        h, c, docs, pos, left, right = (x[order] for x in (h, c, docs, pos, left, right))
        new = np.append(True, (h[1:] != h[:-1]) | (c[1:] != c[:-1])) if len(h) else np.zeros(0, bool)
        # A row that is there twice is one occurrence.
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = ~new & ((docs != docs[head]) | (pos != pos[head]))
        word = self.stretches(docs[later], (pos - left)[later], (left.astype(np.int64) + right)[later])
        return tuple(x[new] for x in (h, c, docs, pos, left, right)), word

    def read(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def send():
            found, word = self.settle_anchors(*map(np.concatenate, zip(*held)))
            held.clear()
            yield from word
            h, c, docs, pos, left, right = found
            # An anchor with too many contexts here alone needs no count: its bucket gets just enough of them to see that.
            starts = runs(h)
            beyond = np.arange(len(h)) - np.repeat(starts, np.diff(np.append(starts, len(h)))) > self.dense
            yield from self.asked(DENSE_, beyond, h, docs, pos)
            h, c, docs, pos, left, right = (x[~beyond] for x in found)
            yield from _rows(ANCHOR, bucket_of(h, self.bits), docs, h=h, c=c.astype("<u8"), pos=pos.astype("<u4"),
                             width=(left.astype("<u2") << 8) | right.astype("<u2"))

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                raw = bytes_of(text.as_py()) if doc_id.is_valid else b""
                if len(raw) >= self.length:
                    rolling = _rolling(raw)
                    pos, h = anchors(raw, self.length, self.gram, rolling)
                    start, end = self.around(pos, len(raw))
                    c = rolling.between(start, end) + mixed(((pos - start) * 256 + end - pos).astype(np.uint64))
                    held.append((h, c, np.full(len(pos), doc_id.as_py(), np.int64), pos, pos - start, end - pos))
                    n += len(pos)
                    if n >= CHUNK:
                        yield from send()
                        n = 0
        if held:
            yield from send()

    def count(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Asks for the contexts of anchors that occur more than once with different contexts."""
        for at, rows in _by_bucket(batches, ANCHOR):
            if rows is None:
                yield at
                continue
            h, c = (np.concatenate(x) for x in ([unpack56(r["h"], at, self.bits) for r in rows], [np.frombuffer(r["c"], "<u8") for r in rows]))
            docs, pos = np.concatenate([wide(r["docs"]) for r in rows]), np.concatenate([np.frombuffer(r["pos"], "<u4") for r in rows]).astype(np.int64)
            width = np.concatenate([np.frombuffer(r["width"], "<u2") for r in rows])
            (h, _, docs, pos, _, _), word = self.settle_anchors(h, c, docs, pos, (width >> 8).astype(np.int64), (width & 255).astype(np.int64))
            yield from word
            starts = runs(h)
            size = np.diff(np.append(starts, len(h)))
            each = np.repeat(size, size)
            for kind, some in ((SPARSE, (each > 1) & (each <= self.dense)), (DENSE_, each > self.dense)):
                yield from self.asked(kind, some, h, docs, pos)

    def contexts(self, texts: pa.Table, asked: pa.Table) -> pa.Table:
        """The contexts asked for: bytes for suffix arrays, or hashes of all strings around an anchor."""
        raws = {d: bytes_of(t.as_py()) for d, t in zip(texts["doc_id"].to_pylist(), texts["text"]) if d is not None}
        sparse, strings = {n: [] for n in _CONTEXTS.names}, []
        for row in asked.to_pylist():
            docs, pos, hs = wide(row["docs"]), np.frombuffer(row["pos"], "<u4").astype(np.int64), np.frombuffer(row["c"], "<u8")
            for s, e in zip(starts := runs(docs), np.append(starts[1:], len(docs))):
                doc = int(docs[s])
                raw, at = raws[doc], pos[s:e]
                start, end = self.around(at, len(raw))
                if row["kind"] == SPARSE:
                    sparse["kind"] += [SPARSE] * len(at)
                    sparse["at"] += bucket_of(hs[s:e], self.bits).tolist()
                    sparse["h"] += hs[s:e].view(np.int64).tolist()
                    sparse["doc"] += [doc] * len(at)
                    sparse["pos"] += at.tolist()
                    sparse["left"] += [raw[b:p][::-1] for b, p in zip(start.tolist(), at.tolist())]
                    sparse["right"] += [raw[p:x] for p, x in zip(at.tolist(), end.tolist())]
                else:
                    every = _rolling(raw).every(self.length)
                    mine = np.zeros(len(every) + 1, np.int64)
                    np.add.at(mine, np.minimum(start, len(every)), 1)
                    np.add.at(mine, np.minimum(np.maximum(end - self.length + 1, start), len(every)), -1)
                    where = np.flatnonzero(np.cumsum(mine[:-1]) > 0)
                    strings.append((every[where], np.full(len(where), doc, np.int64), where))
        none = pa.nulls(len(sparse["at"]), pa.binary())
        out = [pa.table(sparse | {"more": none, "hashes": none}, schema=_CONTEXTS)]
        if strings:
            (h, docs, pos), word = self.settle_strings(*map(np.concatenate, zip(*strings)))
            for rows in (word, _rows(STRING, bucket_of(h, self.bits), docs, h=h, pos=pos.astype("<u4"))):
                for batch in rows:
                    got = pa.table({"kind": batch["kind"], "at": batch["at"], "left": batch["docs"], "right": batch["pos"], "more": batch["width"], "hashes": batch["h"]})
                    out.append(pa.Table.from_pylist(got.to_pylist(), schema=_CONTEXTS))
        return pa.concat_tables(out)

    def settle_strings(self, h, docs, pos):
        order = np.lexsort((pos, docs, h))
        h, docs, pos = h[order], docs[order], pos[order]
        new = np.append(True, h[1:] != h[:-1]) if len(h) else np.zeros(0, bool)
        head = np.flatnonzero(new)[np.cumsum(new) - 1]
        later = ~new & ((docs != docs[head]) | (pos != pos[head]))
        return (h[new], docs[new], pos[new]), self.stretches(docs[later], pos[later], np.full(later.sum(), self.length))

    def compare(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The repeats among contexts of one anchor, and among hashes of strings."""
        for at, rows in _by_bucket(batches, SPARSE, STRING):
            if rows is None:
                word = at.to_pylist()
                yield pa.RecordBatch.from_pylist(
                    [{"kind": REPEAT, "at": r["at"], "docs": r["left"], "pos": r["right"], "width": r["more"]} for r in word], schema=_MESSAGES)
                continue
            strings = [r for r in rows if r["kind"] == STRING]
            if strings:
                h = np.concatenate([unpack56(r["hashes"], at, self.bits) for r in strings])
                docs, pos = np.concatenate([wide(r["left"]) for r in strings]), np.concatenate([np.frombuffer(r["right"], "<u4") for r in strings])
                yield from self.settle_strings(h, docs, pos.astype(np.int64))[1]
            by_anchor: dict[int, list] = {}
            for r in rows:
                if r["kind"] == SPARSE:
                    by_anchor.setdefault(r["h"], []).append(((r["doc"], r["pos"]), r["left"], r["right"]))
            told = [
                (doc, pos - left, left + right)
                for some in by_anchor.values() for left, right, places in maximal_repeats(some, self.length)
                for first in [min(places)] for doc, pos in places if (doc, pos) != first
            ]
            if told:
                yield from self.stretches(*(np.array(x, np.int64) for x in zip(*told)))


_CONTEXTS = pa.schema([
    ("kind", pa.int32()), ("at", pa.int64()), ("h", pa.int64()), ("doc", pa.int64()), ("pos", pa.int64()),
    ("left", pa.binary()), ("right", pa.binary()), ("more", pa.binary()), ("hashes", pa.binary()),
])


def _by_bucket(batches: Iterator[pa.RecordBatch], *kinds: int) -> Iterator[tuple]:
    """(bucket, its rows) for rows of these kinds, which come sorted by bucket; (batch, None) for the others."""
    bucket, held = None, []
    for batch in batches:
        ours = pc.is_in(batch.column("kind"), pa.array(kinds, pa.int32()))
        if (rest := batch.filter(pc.invert(ours))).num_rows:
            yield rest, None
        for row in batch.filter(ours).to_pylist():
            if row["at"] != bucket and held:
                yield bucket, held
                held = []
            bucket = row["at"]
            held.append(row)
    if held:
        yield bucket, held


_RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_bytes", pa.int64()),
    ("removed", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept", pa.binary()),
])


def _merged(start: np.ndarray, width: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs that the stretches cover."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate((start + width)[order])
    gap = np.flatnonzero(start[1:] > end[:-1])
    return list(zip(start[np.append(0, gap + 1)].tolist(), end[np.append(gap, len(end) - 1)].tolist()))


def _finish(texts: pa.Table, word: pa.Table) -> pa.Table:
    told: dict[int, list[tuple[int, int]]] = {}
    if word.num_rows:
        ids = np.concatenate([wide(b.as_py()) for b in word["docs"]])
        start, width = (np.concatenate([np.frombuffer(b.as_py(), t) for b in word[n]]).astype(np.int64) for n, t in (("pos", "<u4"), ("width", "<u2")))
        order = np.argsort(ids, kind="stable")
        ids, start, width = ids[order], start[order], width[order]
        for s, e in zip(starts := runs(ids), np.append(starts[1:], len(ids))):
            told[int(ids[s])] = _merged(start[s:e], width[s:e])
    out = []
    for doc_id, text in zip(texts["doc_id"].to_pylist(), texts["text"]):
        raw, kept, at = bytes_of(text.as_py()), [], 0
        spans = [(s, min(e, len(raw))) for s, e in told.get(doc_id, []) if s < len(raw)]
        for s, e in spans:
            kept.append(raw[at:s])
            at = e
        kept.append(raw[at:])
        out.append({"doc_id": doc_id, "n_bytes": len(raw), "removed": [{"start": s, "end": e} for s, e in spans], "kept": b"".join(kept)})
    return pa.Table.from_pylist(out, schema=_RESULT)


def without_repeated_strings(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, dense: int = DENSE) -> DataFrame:
    """Per row: ``doc_id``, ``n_bytes``, ``removed`` (maximal stretches of bytes, end exclusive), ``kept`` (the other bytes).

    A byte goes if a string of ``length`` bytes that covers it also starts earlier: in a document with a smaller id, or
    before in the same one. A null text is empty. Rows without an id are left whole and are nobody's earlier copy.
    Rows that repeat id and text are one document, and lose the same stretches. Different texts under one id are documents
    of their own, in the order of their hashes. ``length`` is at most 255.
    """
    rows = keyed(documents)
    texts_of_id = rows.where("doc_id IS NOT NULL").groupBy("doc").agg(F.min("key").alias("least"), F.max("key").alias("most"))
    if texts_of_id.where("least <> most").isEmpty():
        return _without_repeated(documents, length, gram, dense)
    # Numbers in the order of ids and hashes take the place of the ids.
    different = rows.where("doc_id IS NOT NULL").select(F.lit(0).alias("all"), F.struct("doc", "key").alias("at"), F.lit(1).alias("one")).distinct()
    numbers = stored(running_totals(different, "all", "at", ["one"]).select("at.doc", "at.key", F.col("before_one").alias("number")), "numbers")
    numbered = rows.join(numbers, ["doc", "key"], "left").select(F.col("number").alias("doc_id"), "text")
    done = _without_repeated(numbered, length, gram, dense).withColumnRenamed("doc_id", "number")
    return done.join(numbers, "number", "left").select(F.col("doc").alias("doc_id"), "n_bytes", "removed", "kept")


def _without_repeated(documents: DataFrame, length: int, gram: int, dense: int) -> DataFrame:
    size = documents_of(documents).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_groups = max(64, size // GROUP_BYTES)
    step = _Repeats(length, gram, dense, max(10, (size // BUCKET_BYTES).bit_length()), n_groups)
    texts = in_groups(documents, n_groups)
    counted = stored(
        documents_of(documents).mapInArrow(step.read, _MESSAGE)
        .repartition("at").sortWithinPartitions("kind", "at").mapInArrow(step.count, _MESSAGE), "anchors")
    asked = counted.where(F.col("kind").isin(SPARSE, DENSE_)).select("at", "kind", "docs", "pos", "c")
    contexts = (
        texts.groupBy("at").cogroup(asked.groupBy("at"))
        .applyInArrow(lambda t, a: step.contexts(t, a) if a.num_rows else _CONTEXTS.empty_table(), "kind int, at long, h long, doc long, pos long, left binary, right binary, more binary, hashes binary")
    )
    compared = contexts.repartition("at", "h").sortWithinPartitions("kind", "at").mapInArrow(step.compare, _MESSAGE)
    word = counted.where(F.col("kind") == REPEAT).unionByName(compared).select("at", "docs", "pos", "width")
    return texts.groupBy("at").cogroup(word.groupBy("at")).applyInArrow(_finish, "doc_id long, n_bytes long, removed array<struct<start: int, end: int>>, kept binary")

