"""SimHash near-duplicates, found by ball hashing that meets in the middle.

Every different fingerprint emits all values within half the radius. Two fingerprints within the radius share
such a value, and a value's ball holds a fixed number of fingerprints, so that groups stay small however often a text is
repeated. Links between fingerprints are verified and joined into components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, islice

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnflow.llm.common import column, documents_of, keyed, marked, stored
from churnflow.llm.graph import components

SHINGLE, RADIUS, SEED = 3, 2, 42
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Shingles whose bits are counted at once.
_AT_ONCE = 1 << 15


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """64 bits; one is set if it is set in over half of the hashes of the text's shingles. No words: 0."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    last = ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]
    spans = zip(starts.tolist(), last.tolist())
    counts, n = np.zeros(64, np.int64), 0
    while some := [xxhash.xxh64_intdigest(line[s:e], SEED) for s, e in islice(spans, _AT_ONCE)]:
        bits = np.unpackbits(np.array(some, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        counts += bits.sum(axis=0, dtype=np.int64)
        n += len(some)
    return int.from_bytes(np.packbits(counts * 2 > n).tobytes(), "big")


def fingerprints(documents: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id`` and ``fp`` (the 64 bits as a signed long) of every row; a null text has no words."""
    return _marks(documents_of(documents), shingle)


def _marks(rows: DataFrame, shingle: int) -> DataFrame:
    """``fp`` beside all columns but ``text``."""

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in batch.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(fp)], names=[*kept, "fp"])

    kept = [c for c in rows.columns if c != "text"]
    return rows.mapInArrow(of, ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in kept) + ", fp long")


def ball(bits: int, radius: int) -> list[int]:
    """All masks with at most ``radius`` of so many bits, as signed longs."""
    masks = [sum(1 << b for b in chosen) for r in range(radius + 1) for chosen in combinations(range(bits), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def linked(different: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Verified links (a, b), a < b, of different fingerprints ``fp`` that connect all pairs within the radius.

    Half the radius, rounded up, is emitted. With an even radius a ball's members are all within the radius of one
    another, and links to its smallest member connect them; with an odd one its pairs are verified one by one.
    """
    half = -(-radius // 2)
    masks = F.array([F.lit(m) for m in ball(64, half)])
    # Each row becomes many: a few small partitions would be as many long tasks. Fingerprints come dealt by their value,
    # so only another expression deals them anew.
    parts = int(different.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = (
        different.repartition(parts, F.xxhash64("fp")).select("fp", F.explode(masks).alias("mask"))
        .select("fp", F.col("fp").bitwiseXOR(F.col("mask")).alias("variant"))
        .groupBy("variant").agg(F.sort_array(F.collect_list("fp")).alias("fps")).where("size(fps) > 1")
    )
    if radius % 2:
        met = met.select("fps", F.explode("fps").alias("a")).select("a", F.explode("fps").alias("b")).where("a < b")
    else:
        met = met.select(F.col("fps")[0].alias("a"), F.explode(F.slice("fps", 2, F.size("fps") - 1)).alias("b"))
    return met.distinct().where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius)


def _roots(different: DataFrame, radius: int) -> DataFrame:
    """(fp, root) of different fingerprints; one without a link is its own root."""
    roots = components(linked(different.select("fp"), radius))
    return different.join(roots, different.fp == roots.node, "left").select(*different.columns, F.coalesce("root", "fp").alias("root"))


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """Per row: ``doc_id``, ``fp`` and ``component_id``, the smallest id reachable over links of at most ``radius`` bits.

    Rows without words, null texts included, have fingerprint 0 and are linked like all others. Rows that repeat are
    kept. A null id is no smallest id, unless a component has no other.
    """
    marks = stored(fingerprints(documents, shingle), "fingerprints")
    rooted = _roots(marks.groupBy("fp").agg(F.min("doc_id").alias("first")), radius)
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of = stored(rooted.join(least, "root").select("fp", "component_id"), "components")
    return marks.join(of, "fp").select("doc_id", "fp", "component_id")


def one_of_each(documents: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each component, with all its columns: the one with the smallest id.

    Of different texts under that id, which are documents of their own, the one with the least hash stays, and of rows that
    repeat id and text, one. A text under an id that another component keeps isn't lost by that. Rows without an id stay.
    """
    marks = stored(_marks(keyed(documents).where("doc_id IS NOT NULL"), shingle), "fingerprints")
    first = F.min(F.struct("doc", "key"))
    rooted = _roots(marks.groupBy("fp").agg(first.alias("first")), radius)
    chosen = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.doc", "first.key")
    # Rows that repeat are rare; only they are looked at side by side.
    counted = stored(marks.groupBy("doc", "key").agg(F.count("*").alias("n")).join(chosen, ["doc", "key"], "left_semi"), "chosen")
    rows, doc, key = marked(documents.where("doc_id IS NOT NULL"))
    once, more = (counted.where(c).select(F.col("doc").alias(doc), F.col("key").alias(key)) for c in ("n = 1", "n > 1"))
    own = [column(c) for c in documents.columns]
    kept = rows.join(once, [doc, key], "left_semi").select(*own)
    if not more.isEmpty():
        kept = kept.unionByName(rows.join(more, [doc, key], "left_semi").dropDuplicates([doc, key]).select(*own))
    return kept.unionByName(documents.where("doc_id IS NULL"))
