"""Exact top-k search by inner product, pruned with segment statistics from coarse to fine.

A vector is cut into segments; of each, the sum and the length of what deviates from the segment's mean are kept.
For one segment of w components, the product of two vectors is at most sum*sum/w + deviation*deviation, so adding up
segments bounds the score from above, and the squared distance |q|^2 + |x|^2 - 2 q.x from below. Every step
to shorter segments tightens the bound. A pair whose bound stays below the k-th best score known for its query is
dropped; what is left is computed exactly, in integers.

Rows never move: every task scans its own against a block of queries, which is sent to it, and keeps the k best of each. The
first thresholds come from an exact search among some thousand rows; a task's own findings raise them. So what is sent on is
little more than the result, however many rows there are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnflow.llm.common import stored

SCALE = 256
K = 5
#: Numbers of segments, coarse to fine.
LEVELS = (1, 4, 16)
#: Queries sent to the tasks at once; rows, about, that give the first thresholds.
QUERIES_AT_ONCE, FIRST_ROWS = 20_000, 20_000
#: Bounds, and exact scores, that a task computes at once; the share of pairs left from which on they are taken one by one.
BOUNDS_AT_ONCE, SCORES_AT_ONCE, FEW = 2_000_000, 100_000, 0.05
_NONE = np.iinfo(np.int64).min


def quantized(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """``vec_id`` and ``v``: floor(scale * x) of every component as a long.

    Vectors without an id, null vectors and those with a null, NaN or infinite component are left out. If an id occurs
    more than once, its smallest vector counts.
    """
    x = F.transform("embedding", lambda c: c.cast("double"))
    whole = ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return (
        vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole)
        .select("vec_id", F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"))
        .groupBy("vec_id").agg(F.min("v").alias("v"))
    )


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    """Vectors as rows of one width: what a vector lacks is zero, and what goes beyond has no counterpart in a query."""
    sizes, flat = np.asarray(pc.list_value_length(lists)), np.asarray(lists.flatten())
    if (sizes == width).all():
        return flat.reshape(len(sizes), width)
    row = np.repeat(np.arange(len(sizes)), sizes)
    at = np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    out = np.zeros((len(sizes), width), np.int64)
    out[row[at < width], at[at < width]] = flat[at < width]
    return out


def _statistics(x: np.ndarray, segments: int) -> np.ndarray:
    """Per row, sum / sqrt(width) and deviation of every segment, so that a plain product of two rows is a bound."""
    edges = np.linspace(0, x.shape[1], min(segments, x.shape[1]) + 1).astype(int)[:-1]
    width = np.diff(np.append(edges, x.shape[1]))
    mean = np.add.reduceat(x, edges, axis=1) / np.sqrt(width)
    square = np.add.reduceat(x * x, edges, axis=1)
    return np.hstack([mean, np.sqrt(np.maximum(square - mean * mean, 0))])


class _Best:
    """The k best (score, id) of each query so far, ties to the smaller id, and the scores that others have to reach."""

    def __init__(self, queries: int, k: int, least: np.ndarray):
        self.k, self.least = k, least.copy()
        self.query, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        query, ids, scores = (np.concatenate(pair) for pair in ((self.query, query), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((ids, -scores, query))
        query, ids, scores = query[order], ids[order], scores[order]
        first = np.flatnonzero(np.append(True, query[1:] != query[:-1]))
        nth = np.arange(len(query)) - np.repeat(first, np.diff(np.append(first, len(query))))
        kept = nth < self.k
        self.query, self.ids, self.scores = query[kept], ids[kept], scores[kept]
        full = nth == self.k - 1
        self.least[query[full]] = np.maximum(self.least[query[full]], scores[full])


def _search(rows: DataFrame, q_ids: np.ndarray, q: np.ndarray, least: np.ndarray, k: int) -> DataFrame:
    """(query, vec_id, score): of every task's rows the k best for each query that reach its least score."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, fq = _Best(len(q), k, least), q.astype(np.float64)
        levels = [(n, _statistics(fq, n)) for n in LEVELS] if q.shape[1] else []
        longest = np.sqrt((fq * fq).sum(axis=1).max(initial=0))
        many = max(1, BOUNDS_AT_ONCE // len(q))
        for batch in batches:
            ids = np.asarray(batch.column("vec_id"))
            x = _matrix(batch.column("v"), q.shape[1])
            for at in range(0, len(ids), many):
                _compare(best, levels, longest, q_ids, q, ids[at : at + many], x[at : at + many])
        yield pa.RecordBatch.from_arrays([pa.array(best.query), pa.array(best.ids), pa.array(best.scores)], names=["query", "vec_id", "score"])

    return rows.mapInArrow(run, "query long, vec_id long, score long")


def _compare(best: _Best, levels: list, longest: float, q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
    """Adds to the best what of these rows is among it."""
    fx = x.astype(np.float64)
    # Bounds are rounded: room for it relative to the largest product of lengths.
    reach = longest * np.sqrt((fx * fx).sum(axis=1).max(initial=0))
    least = best.least.astype(np.float64) - (1e-9 * reach + 1e-6)
    alive = ids[:, None] != q_ids[None, :]
    row = query = None
    for n, of_queries in levels:
        of_rows = _statistics(fx, n)
        if row is None:
            # While most pairs are left, a product of matrices bounds all of them at once.
            alive &= of_rows @ of_queries.T >= least
            if alive.mean() < FEW:
                row, query = np.nonzero(alive)
            continue
        kept = [np.zeros(0, bool)]
        for at in range(0, len(row), SCORES_AT_ONCE):
            r, j = row[at : at + SCORES_AT_ONCE], query[at : at + SCORES_AT_ONCE]
            kept.append(np.einsum("ij,ij->i", of_rows[r], of_queries[j]) >= least[j])
        kept = np.concatenate(kept)
        row, query = row[kept], query[kept]
    if row is None and reach < 2.0**53:
        # Whole numbers below 2**53 are exact as doubles, and so are their products and sums here.
        scores = np.where(alive, (fx @ q.astype(np.float64).T), -np.inf)
        if len(ids) > best.k:
            best.least = np.maximum(best.least, np.maximum(np.partition(scores, -best.k, axis=0)[-best.k], _NONE // 2).astype(np.int64))
        row, query = np.nonzero(alive & (scores >= best.least))
        best.add(query, ids[row], scores[row, query].astype(np.int64))
        return
    if row is None:
        row, query = np.nonzero(alive)
    for at in range(0, len(row), SCORES_AT_ONCE):
        r, j = row[at : at + SCORES_AT_ONCE], query[at : at + SCORES_AT_ONCE]
        score = np.einsum("ij,ij->i", x[r], q[j])
        # What was found meanwhile may have raised the least score.
        some = score >= best.least[j]
        best.add(j[some], ids[r[some]], score[some])


def _best_of(found: DataFrame, k: int) -> DataFrame:
    """(query, best): the k best of all tasks, as (-score, vec_id)."""
    best = F.slice(F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k)
    return found.groupBy("query").agg(best.alias("best"))


def top_k(queries: DataFrame, rows: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query with all rows but its own.

    Both sides are ``quantized`` (products have to fit a long). Queries go to the tasks in blocks of bounded size, each a
    scan of the rows. Vectors of different lengths are padded with zeros, an empty vector scores 0. No queries or no other
    rows: no result.
    """
    rows = stored(rows, "vectors")
    queries = stored(queries, "query-vectors")
    n_rows, n_queries = rows.count(), queries.count()
    blocks = -(-n_queries // QUERIES_AT_ONCE)
    first = rows.where(F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) < FIRST_ROWS / max(n_rows, 1) * (1 << 30))
    results = [queries.select(F.col("vec_id").alias("query_id"), F.lit(0).alias("rank"), "vec_id", F.col("vec_id").alias("score")).limit(0)]
    for block in range(blocks):
        some = queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == block).orderBy("vec_id").toArrow()
        if not some.num_rows:
            continue
        q_ids, vectors = np.asarray(some["vec_id"]), some["v"].combine_chunks()
        q = _matrix(vectors, int(pc.max(pc.list_value_length(vectors)).as_py()))
        least = np.full(len(q), _NONE // 2)
        if n_rows > 2 * FIRST_ROWS:
            # One number a query: the k-th best score among some rows is no more than that among all.
            for r in _best_of(_search(first, q_ids, q, least, k), k).where(F.size("best") == k).collect():
                least[r["query"]] = -r["best"][-1]["s"]
        names = rows.sparkSession.createDataFrame(pd.DataFrame({"query": np.arange(len(q_ids)), "query_id": q_ids}), "query long, query_id long")
        best = _best_of(_search(rows, q_ids, q, least, k), k)
        results.append(best.select("query", F.posexplode("best").alias("rank", "b")).join(names, "query").select(
            "query_id", (F.col("rank") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score")))
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
