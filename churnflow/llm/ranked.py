"""Ranked lexical search by MaxScore with bounds of term pairs.

A document's score for an item is the sum of what the item's terms give it. Every item's terms are paired, rare with
rare. The index cuts the documents into blocks and keeps, for each block, the impacts of the items' terms and, for each
pair, the greatest joint impact in any document of the block: less than the sum of the terms' own maxima wherever the best
documents of one lack the other. A search starts from a threshold per item, the k-th best sum of its leading pairs,
which no final result falls below; it grows as results come in. The joint maxima bound a block, and rule it out
for an item, or bound what pairs not yet added can give a document, and rule that out. What remains is summed in full.

Items are searched in blocks of bounded size, and everything that is kept by item or term belongs to one such block.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnflow.llm.common import documents_of, lowered, split_words, stored
from churnflow.llm.wordids import by_bytes, stretches

K = 20
#: Terms of the items searched at once, about; pairs of an item whose sum gives the first threshold.
TERMS_AT_ONCE, LEADING = 200_000, 4
#: Documents in a block, and impacts in it at most unless one document has more.
BLOCK, BLOCK_IMPACTS = 512, 400_000
#: Scores of one task that are merged in one group before the last merge.
SALTS = 64
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

_IN_TERM = np.zeros(256, bool)
_IN_TERM[0x30:0x3A] = _IN_TERM[0x41:0x5B] = _IN_TERM[0x61:0x7B] = _IN_TERM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def terms_of(text: pa.StringArray) -> tuple[pa.BinaryArray, np.ndarray]:
    """All terms of all texts, and where each text's begin, with their number at the end."""
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        return pa.array([], pa.binary()), np.zeros(len(text) + 1, np.int64)
    seen = _IN_TERM[data]
    start = seen.copy()
    start[1:] &= ~seen[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    start[begins] = seen[begins]
    kept = _LOWER[data[seen]]
    bounds = np.append(np.flatnonzero(start[seen]), len(kept)).astype(np.int32)
    array = pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(kept)])
    return array, np.searchsorted(np.flatnonzero(start), offsets).astype(np.int64)


def _frequencies(text: pa.StringArray, vocabulary: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Per text its number of terms and where its distinct known terms begin; of these, ids and frequencies."""
    sizes, keys, counts = np.zeros(len(text), np.int64), [], []
    for stretch in stretches(text):
        found, begins = terms_of(stretch)
        sizes += np.diff(begins)
        at = pc.index_in(found, value_set=vocabulary)
        known = np.flatnonzero(np.asarray(at.is_valid()))
        row = np.repeat(np.arange(len(text)), np.diff(begins))[known]
        key, n = np.unique(row * len(vocabulary) + np.asarray(at.fill_null(0))[known], return_counts=True)
        keys.append(key)
        counts.append(n)
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    row, term = np.divmod(key, max(len(vocabulary), 1))
    return sizes, np.searchsorted(row, np.arange(len(text) + 1)), term, np.bincount(inverse, np.concatenate(counts)).astype(np.int64)


@dataclass(frozen=True)
class Items:
    """A block of items over a vocabulary: each distinct pair (terms a and b, how often each counts; b is -1 for none)."""

    ids: list
    vocabulary: list[bytes]
    pairs: np.ndarray
    #: Of each item, the rows of ``pairs`` that are its own, rarest terms first.
    of: list[np.ndarray]

    @classmethod
    def of_texts(cls, items: list[tuple[object, list[str]]], frequency: dict[bytes, int]) -> Items:
        """Pairs the terms that any document has, rarest first; terms without a document give nothing."""
        vocabulary = sorted(frequency)
        number = {t: i for i, t in enumerate(vocabulary)}
        rows, of = {}, []
        for _, words in items:
            count = Counter(w.encode("utf-8") for w in words)
            order = sorted((t for t in count if t in number), key=lambda t: (frequency[t], t))
            mine = []
            for a, b in zip(order[::2], [*order[1::2], None]):
                pair = (number[a], count[a], -1 if b is None else number[b], 0 if b is None else count[b])
                mine.append(rows.setdefault(pair, len(rows)))
            of.append(np.array(mine, np.int64))
        return cls([i for i, _ in items], vocabulary, np.array(list(rows), np.int64).reshape(-1, 4), of)


def _weights(frequencies: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in frequencies.tolist()], np.int64)


def _matrix(terms: np.ndarray, impacts: np.ndarray, document: np.ndarray, size: int, n_terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Impacts as one row per term of the block, and the row of every term of the vocabulary; row 0 is empty."""
    local = np.unique(terms)
    row = np.zeros(n_terms + 1, np.int64)
    row[local] = np.arange(1, len(local) + 1)
    out = np.zeros((len(local) + 1, size), np.int64)
    out[row[terms], document] = impacts
    return out, row


def _joint(matrix: np.ndarray, row: np.ndarray, pairs: np.ndarray, documents: np.ndarray | slice = slice(None)) -> np.ndarray:
    """What each pair gives each document. Term -1 is the empty row, which is the last of ``row``."""
    a, b = (matrix[row[pairs[:, j]]][:, documents] for j in (0, 2))
    return a * pairs[:, 1:2] + b * pairs[:, 3:4]


def _top(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if len(scores) > 4 * k:
        least = np.partition(scores, -k)[-k]
        some = np.flatnonzero(scores >= least)
        return some[np.lexsort((ids[some], -scores[some]))[:k]]
    return np.lexsort((ids, -scores))[:k]


_INDEX = (
    "docs array<long>, begins array<int>, terms array<int>, impacts array<long>, pairs array<int>, joint array<long>, "
    "lead_items array<int>, lead_scores array<long>"
)


def _lists(values: list[np.ndarray], kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, values)]).astype(np.int32)), pa.array(np.concatenate(values).astype(kind.to_pandas_dtype()), kind))


def _index(found: DataFrame, items: Items, weights: np.ndarray, documents: int, terms: int, k: int) -> DataFrame:
    """Blocks of documents: impacts, joint maxima of the pairs that occur, and the task's best sums of leading pairs."""
    pairs, of, width = items.pairs, items.of, len(items.vocabulary)
    lead = [own[:LEADING] for own in of]
    different = np.unique(np.concatenate([*lead, np.zeros(0, np.int64)])) if lead else np.zeros(0, np.int64)
    place = [np.searchsorted(different, own) for own in lead]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[np.ndarray] = [np.zeros(0, np.int64) for _ in of]
        for batch in batches:
            n, sizes = np.asarray(batch.column("n")), np.asarray(pc.list_value_length(batch.column("terms")))
            begins = np.append(0, np.cumsum(sizes))
            term, tf = np.asarray(batch.column("terms").flatten()), np.asarray(batch.column("tfs").flatten()).astype(np.int64)
            m = 100 - 25 + (25 * n * documents) // terms
            impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 12 * np.repeat(m, sizes)))
            ids, at = batch.column("doc_id"), 0
            while at < batch.num_rows:
                end = min(at + BLOCK, batch.num_rows, max(at + 1, int(np.searchsorted(begins, begins[at] + BLOCK_IMPACTS, side="right")) - 1))
                since, until = begins[at], begins[end]
                matrix, row = _matrix(term[since:until], impact[since:until], np.repeat(np.arange(end - at), sizes[at:end]), end - at, width)
                present = np.flatnonzero((row[pairs[:, 0]] > 0) | (row[pairs[:, 2]] > 0))
                joint = np.zeros(len(pairs), np.int64)
                for some in np.array_split(present, max(1, len(present) * (end - at) // (1 << 21))):
                    joint[some] = _joint(matrix, row, pairs[some]).max(axis=1, initial=0)
                sums = _joint(matrix, row, pairs[different])
                for i, own in enumerate(place):
                    if joint[different[own]].any():
                        score = np.concatenate([best[i], sums[own].sum(axis=0)])
                        score = score[score > 0]
                        best[i] = np.partition(score, -k)[-k:] if len(score) > k else score
                has = np.flatnonzero(joint)
                yield pa.RecordBatch.from_arrays([
                    pa.ListArray.from_arrays(pa.array([0, end - at], pa.int32()), ids.slice(at, end - at)),
                    _lists([begins[at : end + 1] - since], pa.int32()), _lists([term[since:until]], pa.int32()),
                    _lists([impact[since:until]], pa.int64()), _lists([has], pa.int32()), _lists([joint[has]], pa.int64()),
                    pa.nulls(1, pa.list_(pa.int32())), pa.nulls(1, pa.list_(pa.int64())),
                ], names=names)
                at = end
        yield pa.RecordBatch.from_arrays([
            *(pa.nulls(1, pa.list_(t)) for t in (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64())),
            _lists([np.repeat(np.arange(len(of)), [len(b) for b in best])], pa.int32()),
            _lists([np.concatenate([*best, np.zeros(0, np.int64)])], pa.int64()),
        ], names=names)

    names = [field.split()[0] for field in _INDEX.split(", ")]
    return found.mapInArrow(build, _INDEX)


def _best_of(rows: DataFrame, order: str, k: int) -> DataFrame:
    """(item, best): the k least of the rows' structs by ``order``, first within parts of an item's rows, then of all."""
    least = F.slice(F.sort_array(F.collect_list("x")), 1, k)
    part = (
        rows.select("item", F.expr(order).alias("x")).withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(SALTS)))
        .groupBy("item", "salt").agg(least.alias("xs"))
    )
    return part.select("item", F.explode("xs").alias("x")).groupBy("item").agg(least.alias("best"))


def _search(index: DataFrame, items: Items, thresholds: np.ndarray, k: int) -> DataFrame:
    """Each task's k best (item, doc_id, score) of its blocks."""
    pairs, of, width = items.pairs, items.of, len(items.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = thresholds.copy()
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)) for _ in of]
        for batch in batches:
            for at in np.flatnonzero(np.asarray(batch.column("docs").is_valid())).tolist():
                docs, begins, terms, impacts, some, maxima = (batch.column(c)[at].values for c in names)
                ids, none, size = np.asarray(docs.fill_null(0)), np.asarray(docs.is_null()), len(docs)
                joint = np.zeros(len(pairs), np.int64)
                joint[np.asarray(some)] = np.asarray(maxima)
                document = np.repeat(np.arange(size), np.diff(np.asarray(begins)))
                matrix, row = _matrix(np.asarray(terms), np.asarray(impacts), document, size, width)
                for i, own in enumerate(of):
                    own = own[joint[own] > 0]
                    if joint[own].sum() < least[i] or not len(own):
                        continue
                    own = own[np.argsort(-joint[own], kind="stable")]
                    # What the pairs behind each can still give.
                    rest = joint[own].sum() - np.cumsum(joint[own])
                    alive, score, done, many = np.arange(size), np.zeros(size, np.int64), 0, 2
                    while done < len(own) and len(alive):
                        score = score + _joint(matrix, row, pairs[own[done : done + many]], alive).sum(axis=0)
                        done, many = min(done + many, len(own)), 2 * many
                        stays = score + rest[done - 1] >= max(least[i], 1)
                        alive, score = alive[stays], score[stays]
                    if len(alive):
                        scores, of_ids, nulls = (np.concatenate(x) for x in zip(best[i], (score, ids[alive], none[alive])))
                        top = _top(scores, np.where(nulls, np.iinfo(np.int64).max, of_ids), k)
                        best[i] = scores[top], of_ids[top], nulls[top]
                        if len(top) == k:
                            least[i] = max(least[i], scores[top[-1]])
        sizes = [len(b[0]) for b in best]
        scores, of_ids, nulls = (np.concatenate([b[j] for b in best] or [np.zeros(0, np.int64)]) for j in range(3))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(of)), sizes).astype(np.int32)), pa.array(of_ids, mask=nulls.astype(bool)), pa.array(scores)],
            names=["item", "doc_id", "score"])

    names = index.columns
    return index.mapInArrow(run, "item int, doc_id long, score long")


def _items_of(benchmark: DataFrame) -> DataFrame:
    """``item_id``, its terms, and the block of items it is searched with."""
    words = (
        benchmark.where("item_id IS NOT NULL").groupBy("item_id").agg(F.min(F.col("text").cast("string")).alias("text"))
        .select("item_id", split_words(lowered(F.col("text")), SEPARATORS).alias("words")).where("size(words) > 0")
    )
    words = stored(words, "items")
    total = words.agg(F.sum(F.size("words"))).first()[0] or 0
    return words.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(-(-total // TERMS_AT_ONCE) or 1)))


def ranked(documents: DataFrame, benchmark: DataFrame, k: int = K) -> DataFrame:
    """(item_id, rank, doc_id, score): the k documents with the highest scores above 0 for each item, ties to the smaller id.

    Null and empty texts have no terms. Documents that repeat, whole or by their id, each count and rank by themselves,
    those without an id last among equals. Of items that share an id the smallest text counts; items without an id or
    terms have no results, and neither has any item if there are no documents with terms.
    """
    items = _items_of(benchmark)
    blocks = [r["block"] for r in items.select("block").distinct().orderBy("block").collect()]
    out = None
    for block in blocks:
        some = _ranked(documents, [(r["item_id"], r["words"]) for r in items.where(F.col("block") == block).drop("block").collect()], k, items)
        out = some if out is None else out.unionByName(some)
    if out is None:
        out = items.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)
    return out


def _ranked(documents: DataFrame, rows: list[tuple[object, list[str]]], k: int, items: DataFrame) -> DataFrame:
    vocabulary = sorted({w.encode("utf-8") for _, words in rows for w in words})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pa.array(vocabulary, pa.binary())
        for batch in by_bytes(batches):
            n, begins, terms, tfs = _frequencies(batch.column("text"), known)
            at = pa.array(begins.astype(np.int32))
            some = pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(n), pa.ListArray.from_arrays(at, pa.array(terms.astype(np.int32))),
                pa.ListArray.from_arrays(at, pa.array(tfs.astype(np.int32)))], names=["doc_id", "n", "terms", "tfs"])
            yield some.filter(pa.array(n > 0))

    def document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            total += np.bincount(np.asarray(batch.column("terms").flatten()), minlength=len(vocabulary))
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has.astype(np.int32)), pa.array(total[has])], names=["term", "df"])

    texts = documents_of(documents).withColumn("text", F.coalesce("text", F.lit("")))
    found = stored(texts.mapInArrow(count, "doc_id long, n long, terms array<int>, tfs array<int>"), "ranked-terms")
    totals = found.agg(F.count("*").alias("documents"), F.sum("n").alias("terms")).first()
    # One row per term of this block of items.
    df = {vocabulary[r["term"]]: r["df"] for r in found.select("terms").mapInArrow(document_counts, "term int, df long")
          .groupBy("term").agg(F.sum("df").alias("df")).collect()}
    # Ids of terms are places in the whole vocabulary; terms without a document have no postings.
    chosen = Items.of_texts(rows, {t: df.get(t, 0) for t in vocabulary})
    weights = _weights(np.array([df.get(t, 0) for t in vocabulary], np.int64), totals["documents"])
    index = stored(_index(found, chosen, weights, totals["documents"], totals["terms"] or 1, k), "ranked-index")
    leads = index.where("lead_items IS NOT NULL").select(F.explode(F.arrays_zip("lead_items", "lead_scores")).alias("x")).select(
        F.col("x.lead_items").alias("item"), F.col("x.lead_scores").alias("score"))
    thresholds = np.zeros(len(rows), np.int64)
    # At most k numbers an item.
    for r in _best_of(leads, "struct(-score AS score)", k).collect():
        if len(r["best"]) == k:
            thresholds[r["item"]] = -r["best"][-1]["score"]
    found = _search(index.drop("lead_items", "lead_scores"), chosen, thresholds, k)
    best = _best_of(found, "struct(-score AS score, doc_id IS NULL AS no_id, doc_id)", k)
    names = items.sparkSession.createDataFrame([(i, item_id) for i, (item_id, _) in enumerate(rows)], items.select(F.lit(0).alias("item"), "item_id").schema)
    return best.select("item", F.posexplode("best").alias("rank", "x")).join(names, "item").select(
        "item_id", (F.col("rank") + 1).alias("rank"), F.col("x.doc_id").alias("doc_id"), (-F.col("x.score")).alias("score"))
