"""Quality classifier: random-indexing word vectors, pooled per document, and a small calibrated network.

Every token has a sparse random index vector. A token's word vector is the sum of the index vectors of its neighbours
over all documents, added up by Spark; tokens share a fixed number of hash rows, which bounds the table of word vectors
whatever the vocabulary. A document is the mean and the spread of its tokens' vectors, and the size of
the steps from token to token. A two-layer network, trained in
numpy on a bounded sample of labelled documents, tells the classes apart, and one temperature, fitted on a part of the sample that
the network hasn't seen, calibrates its probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnflow.llm.common import documents_of, held_out, helper, stored
from churnflow.llm.wordids import by_bytes, stretches

#: Hash rows of the table of word vectors, their length, signs in an index vector, and neighbours to each side.
ROWS, DIM, SIGNS, REACH = 1 << 14, 24, 4, 2
#: Labelled documents that the network learns from, at most; it takes those with the least hash.
SAMPLE = 20_000
HIDDEN, STEPS, BATCH, RATE, DECAY = 32, 1500, 256, 3e-3, 1e-4
THRESHOLD = 0.7
#: Tokens that a task handles at once, and tokens of one document that it takes at a time.
AT_ONCE, PART = 200_000, 100_000
#: Kinds of bytes: none of a token, letters and digits (case kept), other visible characters.
_KIND = np.zeros(256, np.uint8)
_KIND[0x21:0x7F] = 2
_KIND[[c for c in range(0x30, 0x7B) if chr(c).isalnum()]] = 1
_KIND[0x80:] = 1


def token_rows(text: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
    """The hash rows of all tokens of all texts, and where each text's begin, with their number at the end. A token is a
    run of letters and digits, or of other visible characters."""
    offsets = np.frombuffer(text.buffers()[1], np.int32)[text.offset : text.offset + len(text) + 1]
    data = np.frombuffer(text.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(len(text) + 1, np.int64)
    kind = _KIND[data]
    start = kind > 0
    start[1:] &= kind[1:] != kind[:-1]
    begins = offsets[:-1][offsets[:-1] < len(data)]
    start[begins] = kind[begins] > 0
    kept = data[kind > 0]
    bounds = np.append(np.flatnonzero(start[kind > 0]), len(kept)).astype(np.int32)
    found = pa.BinaryArray.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(kept)]).dictionary_encode()
    row = (pd.util.hash_array(np.array([*found.dictionary.to_pylist(), b""], dtype=object), categorize=False) % np.uint64(ROWS)).astype(np.int64)
    return row[np.asarray(found.indices)], np.searchsorted(np.flatnonzero(start), offsets)


def index_vectors() -> np.ndarray:
    """The sparse random vectors, the same in every task."""
    rng = np.random.default_rng(1)
    out = np.zeros((ROWS, DIM), np.float32)
    for row in out:
        row[rng.choice(DIM, SIGNS, replace=False)] = rng.choice([-1, 1], SIGNS)
    return out


@dataclass(frozen=True)
class _Group:
    """Parts of documents: their tokens' hash rows beside REACH tokens to each side that a neighbouring part owns."""

    rows: np.ndarray
    #: Where each part begins, with the end of the last; what it owns; whether it is its document's first and last.
    begins: np.ndarray
    own: np.ndarray
    first: np.ndarray
    last: np.ndarray
    ids: list

    @classmethod
    def of(cls, parts: list[tuple]) -> _Group:
        begins = np.append(0, np.cumsum([len(rows) for _, rows, *_ in parts]))
        own = np.zeros(begins[-1], bool)
        for at, (_, _, low, high, _, _) in zip(begins.tolist(), parts):
            own[at + low : at + high] = True
        return cls(np.concatenate([p[1] for p in parts]), begins, own, np.array([p[4] for p in parts]), np.array([p[5] for p in parts]),
                   [p[0] for p in parts])

    def part_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.begins) - 1), np.diff(self.begins))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[_Group]:
    """All documents in order; a long one in several parts, over several groups."""
    held, n = [], 0
    for batch in by_bytes(batches):
        stretched = stretches(batch.column("text"))
        if len(stretched) == 1:
            rows, begins = token_rows(stretched[0])
        else:
            rows = np.concatenate([token_rows(s)[0] for s in stretched])
            begins = np.array([0, len(rows)])
        for doc_id, since, until in zip(batch.column("doc_id").to_pylist(), begins[:-1].tolist(), begins[1:].tolist()):
            for at in range(since, max(until, since + 1), PART):
                end = min(at + PART, until)
                low, high = max(since, at - REACH), min(until, end + REACH)
                held.append((doc_id, rows[low:high], at - low, end - low, at == since, end == until))
                n += high - low
                if n >= AT_ONCE:
                    yield _Group.of(held)
                    held, n = [], 0
    if held:
        yield _Group.of(held)


def _sums(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """The sum of each part's rows; zeros for an empty part."""
    out = np.zeros((len(begins) - 1, values.shape[1]))
    some = np.flatnonzero(np.diff(begins))
    if len(some):
        out[some] = np.add.reduceat(values, begins[some], axis=0, dtype=np.float64)
    return out


def _texts(documents: DataFrame) -> DataFrame:
    return documents_of(documents).withColumn("text", F.coalesce("text", F.lit("")))


def word_vectors(documents: DataFrame) -> np.ndarray:
    """ROWS x DIM sums of neighbours' index vectors over all documents, each scaled to length 1."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, total = index_vectors(), np.zeros((ROWS, DIM))
        for group in _groups(batches):
            rows, part = group.rows, group.part_of()
            around = np.zeros((len(rows), DIM), np.float32)
            of = index[rows]
            for step in range(1, REACH + 1):
                same = (part[step:] == part[:-step])[:, None]
                around[step:] += of[:-step] * same
                around[:-step] += of[step:] * same
            rows, around = rows[group.own], around[group.own]
            order = np.argsort(rows, kind="stable")
            starts = np.flatnonzero(np.diff(rows[order], prepend=-1))
            if len(starts):
                total[rows[order][starts]] += np.add.reduceat(around[order], starts, axis=0)
        some = np.flatnonzero(np.abs(total).sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(total[some, d].astype(np.int64)) for d in range(DIM))], names=["row", *names])

    names = [f"v{d}" for d in range(DIM)]
    schema = "row long, " + ", ".join(f"{n} long" for n in names)
    # ROWS rows at most, whatever the size of the corpus.
    sums = _texts(documents).mapInArrow(gather, schema).groupBy("row").agg(*(F.sum(n).alias(n) for n in names)).toPandas()
    out = np.zeros((ROWS, DIM), np.float32)
    if len(sums):
        out[sums["row"].to_numpy()] = sums[names].to_numpy(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


#: Numbers that describe a document.
WIDTH = 3 * DIM


def pooled(documents: DataFrame, vectors: np.ndarray) -> DataFrame:
    """``doc_id`` and ``x``: mean and spread of the vectors of the document's tokens, and the root mean square of the
    differences of neighbours; zeros without tokens."""
    table = documents.sparkSession.sparkContext.broadcast(vectors)

    def pool(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What the parts so far of a document that goes on in the next group add up to.
        carried = np.zeros(1 + 3 * DIM)
        for group in _groups(batches):
            of = table.value[group.rows]
            own = group.own[:, None]
            moved = np.zeros_like(of)
            np.subtract(of[1:], of[:-1], out=moved[1:])
            moved[group.begins[:-1][np.diff(group.begins) > 0]] = 0
            sums = np.hstack([_sums(x, group.begins) for x in (own.astype(np.float32), of * own, of * of * own, moved * moved * own)])
            document = np.cumsum(group.first) - group.first[0]
            total = np.zeros((document[-1] + 1, sums.shape[1]))
            np.add.at(total, document, sums)
            if not group.first[0]:
                total[0] += carried
            done = len(total) if group.last[-1] else len(total) - 1
            carried = total[-1]
            n, total = total[:done, :1], total[:done, 1:]
            mean, square, moves = total[:, :DIM] / np.maximum(n, 1), total[:, DIM : 2 * DIM] / np.maximum(n, 1), total[:, 2 * DIM :] / np.maximum(n - 1, 1)
            x = np.hstack([mean, np.sqrt(np.maximum(square - mean * mean, 0)), np.sqrt(moves)]).astype(np.float32)
            ids = [i for i, last in zip(group.ids, group.last) if last]
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(np.arange(0, x.size + 1, WIDTH, dtype=np.int32)), pa.array(x.ravel()))],
                names=["doc_id", "x"])

    return _texts(documents).mapInArrow(pool, "doc_id long, x array<float>")


@dataclass
class Network:
    """Two layers on standardized inputs; ``temperature`` divides the last sum."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh((x - self.shift) / self.scale @ self.w1 + self.b1) @ self.w2 + self.b2

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def train(x: np.ndarray, y: np.ndarray, seed: int = 1) -> Network:
    """Fits the network on four fifths of the rows by Adam, and the temperature on the rest.

    With one class only, every score is close to that class; without rows it is a half.
    """
    rng = np.random.default_rng(seed)
    n, d = x.shape
    if n < 10 or y.min() == y.max():
        share = (y.sum() + 0.5) / (n + 1)
        return Network(np.zeros(d), np.ones(d), np.zeros((d, 1)), np.zeros(1), np.zeros(1), float(np.log(share / (1 - share))))
    order = rng.permutation(n)
    fit, rest = order[: n * 4 // 5], order[n * 4 // 5 :]
    shift, scale = x[fit].mean(0), x[fit].std(0) + 1e-6
    p = [rng.normal(0, d**-0.5, (d, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(w) for w in p], [np.zeros_like(w) for w in p]
    z = (x - shift) / scale
    for step in range(1, STEPS + 1):
        some = fit[rng.integers(0, len(fit), BATCH)]
        a = np.tanh(z[some] @ p[0] + p[1])
        error = (1 / (1 + np.exp(-np.clip(a @ p[2] + p[3], -60, 60))) - y[some]) / BATCH
        back = np.outer(error, p[2]) * (1 - a * a)
        for i, g in enumerate((z[some].T @ back + DECAY * p[0], back.sum(0), a.T @ error + DECAY * p[2], error.sum(keepdims=True))):
            m[i] += 0.1 * (g - m[i])
            v[i] += 0.001 * (g * g - v[i])
            p[i] -= RATE * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.999**step)) + 1e-8)
    net = Network(shift, scale, p[0], p[1], p[2], float(p[3][0]))
    logit = net.logits(x[rest])
    loss = [(np.logaddexp(0, np.where(y[rest] > 0, -logit, logit) / t).mean(), t) for t in np.geomspace(0.25, 8, 61)]
    net.temperature = float(min(loss)[1])
    return net


def quality_scores(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``score`` (that the label is 1) and ``predicted`` (score >= threshold).

    Only rows that aren't held out are learned from, at most ``sample`` of them, those with the least hash of their id. Labels
    without an id or a value don't count; of contradicting labels of one id the larger does. Null and empty texts are
    scored like any text, rows that repeat are kept, and without labels every score is a half.
    """
    vectors = word_vectors(documents)
    x = stored(pooled(documents, vectors), "pooled")
    truth = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality"))
        .where(~held_out(F.col("doc_id")))
    )
    learned = x.join(truth, "doc_id").withColumn("h", F.xxhash64("doc_id"))
    n = truth.count()
    if n > 2 * sample:
        # Nearly all rows are told apart from the least ones before they are sorted.
        learned = learned.where(F.pmod("h", F.lit(1 << 20)) < int(1.5 * sample / n * (1 << 20)))
        learned = learned.withColumn("h", F.pmod("h", F.lit(1 << 20)))
    rows = learned.orderBy("h", "doc_id", "x").limit(sample).select("x", "quality").toPandas()
    net = train(np.array(rows["x"].tolist(), np.float64).reshape(-1, WIDTH), rows["quality"].to_numpy(np.float64))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = np.array(batch.column("x").flatten()).reshape(-1, WIDTH).astype(np.float64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(net.probability(got))], names=["doc_id", "score"])

    return x.mapInArrow(score, "doc_id long, score double").select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def of_good_quality(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, that the classifier takes for label 1; rows without an id stay.

    Of rows that share an id, all stay if one is taken for label 1.
    """
    scores = quality_scores(documents, labels, sample, threshold)
    bad = helper(documents, "bad")
    rejected = scores.groupBy("doc_id").agg(F.max("predicted").alias("p")).where("p = 0 AND doc_id IS NOT NULL").select(F.col("doc_id").alias(bad))
    return documents.join(rejected, F.col("doc_id").cast("long") == F.col(bad), "left_anti")
