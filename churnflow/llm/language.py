"""Language identification by a bidirectional gated recurrent network over bytes.

Texts are cut into segments, and many segments of many documents run through the network side by side. Every byte gets
a probability for each language from what was read before it and what comes after it, and a document's probabilities are
the means over all of its bytes. The network is small and its gates are piecewise linear, as every byte of the corpus
passes through it. It is trained in numpy by backpropagation through time, on a bounded sample.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnflow.llm.common import documents_of, held_out, stored

#: Bytes of a segment, units in each direction, segments that run side by side.
SEGMENT, UNITS, SIDE_BY_SIDE = 64, 8, 4096
#: About as many documents of each language are learned from, of each a stretch of so many characters.
SAMPLE, STRETCH = 400, 256
STEPS, BATCH, RATE = 220, 192, 0.02
UNDETERMINED = "und"
#: Languages that are learned at most, the most frequent ones.
LANGUAGES = 256
_LETTER = regex.compile(r"\p{L}")


@dataclass
class Network:
    """Of each direction: what a byte adds to update gate, reset gate and state (3 UNITS x 256), what the last state adds,
    and what a state says about the languages."""

    languages: list[str]
    byte: list[np.ndarray]
    state: list[np.ndarray]
    out: list[np.ndarray]
    bias: np.ndarray


def _gate(x: np.ndarray) -> np.ndarray:
    x *= 0.25
    x += 0.5
    return np.clip(x, 0, 1, out=x)


def _steps(net: Network, way: int, x: np.ndarray, inside: np.ndarray) -> Iterator[tuple[int, np.ndarray, tuple]]:
    """(t, state, what backpropagation needs) for each byte, in reading order of the direction."""
    byte, state, h = net.byte[way], net.state[way], np.zeros((UNITS, x.shape[1]), np.float32)
    for t in range(len(x)) if way == 0 else range(len(x) - 1, -1, -1):
        a, u = np.take(byte, x[t], axis=1), state @ h
        gates = _gate(a[: 2 * UNITS] + u[: 2 * UNITS])
        z, r = gates[:UNITS], gates[UNITS:]
        own = a[2 * UNITS :] + r * u[2 * UNITS :]
        new = np.clip(own, -1, 1)
        last, h = h, (new + z * (h - new)) * inside[t]
        yield t, h, (last, gates, u[2 * UNITS :], own, new)


def _softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=0))
    return e / e.sum(axis=0)


def position_probabilities(net: Network, x: np.ndarray, inside: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(t, languages x segments) for the bytes x[t] of all segments; ``inside`` is 0 behind a segment's end."""
    before = [net.out[0] @ h for _, h, _ in _steps(net, 0, x, inside)]
    for t, h, _ in _steps(net, 1, x, inside):
        yield t, _softmax(before[t] + net.out[1] @ h + net.bias)


def _laid_out(segments: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes by place in the segment, and which places are inside."""
    inside = (np.arange(segments.shape[1])[:, None] < sizes[None, :]).astype(np.float32)
    return np.ascontiguousarray(segments.T).astype(np.intp), inside


def _cut(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = -(-len(raw) // SEGMENT)
    sizes = np.full(n, SEGMENT)
    sizes[-1] = len(raw) - SEGMENT * (n - 1)
    return np.frombuffer(raw.ljust(n * SEGMENT, b"\0"), np.uint8).reshape(n, SEGMENT), sizes


def train(texts: list[str], langs: list[str], seed: int = 1) -> Network:
    """Learns to label the bytes of segments of the texts; languages are the different ``langs``, sorted."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(langs))
    k, number = len(languages), {lang: i for i, lang in enumerate(languages)}
    init = lambda *shape: (rng.normal(0, 0.3, shape)).astype(np.float32)
    net = Network(languages, [init(3 * UNITS, 256) for _ in "ab"], [init(3 * UNITS, UNITS) for _ in "ab"], [init(k, UNITS) for _ in "ab"], np.zeros((k, 1), np.float32))
    cut = [(_cut(raw), number[lang]) for text, lang in zip(texts, langs) if (raw := text.encode("utf-8", "replace"))]
    if k < 2 or not cut:
        return net
    segments, sizes = np.concatenate([c[0] for c, _ in cut]), np.concatenate([c[1] for c, _ in cut])
    of = np.repeat([i for _, i in cut], [len(c[1]) for c, _ in cut])
    by_language = [np.flatnonzero(of == i) for i in range(k)]
    weights = [*net.byte, *net.state, *net.out, net.bias]
    m, v = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, STEPS + 1):
        # As many of each language that has any.
        some = np.concatenate([rng.choice(s, -(-BATCH // k)) for s in by_language if len(s)])
        x, inside = _laid_out(segments[some], sizes[some])
        ways = [list(_steps(net, way, x, inside)) for way in (0, 1)]
        state = [{t: h for t, h, _ in w} for w in ways]
        grads, d_out = [None, None, None, None], [np.zeros_like(w) for w in net.out]
        d_bias, d_logits = np.zeros_like(net.bias), {}
        truth = np.zeros((k, len(some)), np.float32)
        truth[of[some], np.arange(len(some))] = 1
        for t in range(SEGMENT):
            d = (_softmax(net.out[0] @ state[0][t] + net.out[1] @ state[1][t] + net.bias) - truth) * inside[t] / inside.sum()
            d_logits[t] = d
            d_bias += d.sum(axis=1, keepdims=True)
            for way in (0, 1):
                d_out[way] += d @ state[way][t].T
        for way in (0, 1):
            d_byte, d_state, d_h = {}, np.zeros_like(net.state[way]), 0
            for t, _, (last, gates, u, own, new) in reversed(ways[way]):
                d_h = (d_h + net.out[way].T @ d_logits[t]) * inside[t]
                z, r = gates[:UNITS], gates[UNITS:]
                d_own = d_h * (1 - z) * (np.abs(own) < 1)
                d_gates = np.concatenate([d_h * (last - new), d_own * u]) * (0.25 * ((gates > 0) & (gates < 1)))
                back = np.concatenate([d_gates, d_own * r])
                d_byte[t] = np.concatenate([d_gates, d_own])
                d_state += back @ last.T
                d_h = d_h * z + net.state[way].T @ back
            order = np.argsort(x.ravel(), kind="stable")
            seen = x.ravel()[order]
            starts = np.flatnonzero(np.diff(seen, prepend=-1))
            grads[way] = np.zeros_like(net.byte[way])
            grads[way][:, seen[starts]] = np.add.reduceat(np.concatenate([d_byte[t] for t in range(SEGMENT)], axis=1)[:, order], starts, axis=1)
            grads[2 + way] = d_state
        for i, g in enumerate([*grads, *d_out, d_bias]):
            g /= max(1.0, float(np.abs(g).max()) / 0.1)
            m[i] += 0.1 * (g - m[i])
            v[i] += 0.01 * (g * g - v[i])
            rate = RATE * min(1.0, 2 * (1 - step / STEPS) + 0.02)
            weights[i] -= rate * (m[i] / (1 - 0.9**step)) / (np.sqrt(v[i] / (1 - 0.99**step)) + 1e-7)
    return net


def document_probabilities(net: Network, raws: list[bytes]) -> np.ndarray:
    """Means over all bytes of each text, languages by columns; zeros for an empty one."""
    total = np.zeros((len(raws), len(net.languages)))
    held, n = [], 0

    def run() -> None:
        segments, sizes = np.concatenate([s for _, s, _ in held]), np.concatenate([z for _, _, z in held])
        of = np.repeat([i for i, _, _ in held], [len(z) for _, _, z in held])
        # In pieces of even size: the last one would otherwise run nearly empty.
        for some in np.array_split(np.arange(len(sizes)), -(-len(sizes) // SIDE_BY_SIDE)):
            x, inside = _laid_out(segments[some], sizes[some])
            sums = np.zeros((len(net.languages), len(some)), np.float32)
            for t, p in position_probabilities(net, x, inside):
                sums += p * inside[t]
            np.add.at(total, of[some], sums.T)
        held.clear()

    for i, raw in enumerate(raws):
        if raw:
            held.append((i, *_cut(raw)))
            n += len(held[-1][2])
            if n >= 8 * SIDE_BY_SIDE:
                run()
                n = 0
    if held:
        run()
    return total / np.maximum([[len(r)] for r in raws], 1)


def sample_of(documents: DataFrame, size: int = SAMPLE) -> tuple[list[str], list[str]]:
    """About ``size`` stretches of text of each language, from documents that aren't held out, have a language and a letter.

    At most LANGUAGES languages are learned, so what comes to the driver is bounded.
    """
    usable = documents.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"),
    ).where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").isNotNull())
    # Counted over all documents.
    counts = stored(usable.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(LANGUAGES), "languages")
    usable = usable.join(F.broadcast(counts), "lang")
    share = F.least(F.lit(1.0), F.lit(size) / F.col("n"))
    h = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30))
    at = F.pmod(F.xxhash64("text", "doc_id"), F.greatest(F.length("text") - STRETCH, F.lit(1))).cast("int")
    rows = usable.where(h < share * (1 << 30)).select("lang", F.substring("text", at + 1, F.lit(STRETCH)).alias("text")).orderBy("lang", "text").collect()
    rows = [r for r in rows if _LETTER.search(r["text"])]
    return [r["text"] for r in rows], [r["lang"] for r in rows]


def languages(documents: DataFrame, size: int = SAMPLE) -> DataFrame:
    """Per row: ``doc_id``, ``held_out``, ``lang_pred`` and ``score`` (the language's mean probability over all bytes), and
    ``probabilities`` by language.

    Null texts and texts without a letter are ``und`` with score 0; so is everything if no document has a language to
    learn. Rows that repeat are kept, and so is a null ``doc_id``.
    """
    net = train(*sample_of(documents, size))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column("text")]
            known = [bool(net.languages) and _LETTER.search(t) is not None for t in texts]
            p = document_probabilities(net, [t.encode("utf-8", "replace") if k else b"" for t, k in zip(texts, known)])
            best = p.argmax(axis=1) if net.languages else np.zeros(len(texts), int)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"),
                "lang_pred": [net.languages[b] if k else UNDETERMINED for b, k in zip(best, known)],
                "score": pa.array([min(1.0, float(row[b])) if k else 0.0 for row, b, k in zip(p, best, known)], pa.float64()),
                "probabilities": pa.array([list(zip(net.languages, row.tolist())) if k else [] for row, k in zip(p, known)], pa.map_(pa.string(), pa.float64())),
            })

    found = documents_of(documents).mapInArrow(run, "doc_id long, lang_pred string, score double, probabilities map<string, double>")
    return found.withColumn("held_out", held_out(F.col("doc_id")))
