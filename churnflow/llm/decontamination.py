"""Benchmark decontamination with a positional inverted index.

The index holds one posting (term, document, position) for every occurrence, in any document, of a term that
occurs in a test item. For each phrase, the postings of its two rarest terms are shifted by the terms' offsets in the
phrase; shifted postings on both lists are where the phrase may begin, and the document's words there decide.
Terms, phrases and term pairs come from the test items only; their tables are broadcast if they are small and
shuffled otherwise. Postings are never grouped by term, so a frequent term doesn't load one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnflow.llm.common import column, keyed, lowered, marked, small, split_words, stored

#: Words of a phrase, and words that may stand between those of a close match.
WINDOW, SLACK = 10, 5
#: What lies between words: ASCII but for digits and letters.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def item_words(text: Column) -> Column:
    return split_words(lowered(text), SEPARATORS)


@dataclass(frozen=True)
class PhraseIndex:
    """``phrases`` (phrase_id, terms, size), ``items`` (phrase_id, item_id), ``vocabulary`` (term, term_id),
    ``postings`` (term_id, doc, key, pos) and ``rarest`` (phrase_id, t1, o1, t2, o2)."""

    phrases: DataFrame
    items: DataFrame
    vocabulary: DataFrame
    postings: DataFrame
    rarest: DataFrame


def phrases_of(benchmark: DataFrame, window: int) -> tuple[DataFrame, DataFrame]:
    """All windows of the items' words, each once, and the items that each is in. Items without an id are left out."""
    cut = (
        benchmark.select(F.col("item_id").cast("string").alias("item_id"), item_words(F.col("text")).alias("w"))
        .where("item_id IS NOT NULL AND size(w) > 0")
        .select("item_id", "w", F.explode(F.sequence(F.lit(1), F.greatest(F.size("w") - window + 1, F.lit(1)))).alias("at"))
        .select("item_id", F.slice("w", F.col("at"), F.lit(window)).alias("terms"))
        .distinct()
    )
    cut = stored(cut, "item-windows")
    phrases = stored(
        cut.select("terms").distinct().select(F.monotonically_increasing_id().alias("phrase_id"), "terms", F.size("terms").alias("size")),
        "phrases",
    )
    return phrases, stored(cut.join(small(phrases), "terms").select("phrase_id", "item_id"), "phrase-items")


def build_index(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> PhraseIndex:
    """Postings of all test terms in all documents, and each phrase's two rarest terms."""
    phrases, items = phrases_of(benchmark, window)
    places = phrases.select("phrase_id", F.posexplode("terms").alias("off", "term"))
    vocabulary = stored(places.select("term").distinct().select("term", F.monotonically_increasing_id().alias("term_id")), "vocabulary")
    known = small(vocabulary)
    postings = stored(
        keyed(documents)
        .select("doc", "key", F.posexplode(item_words(F.col("text"))).alias("pos", "term"))
        .join(known, "term").select("term_id", "doc", "key", "pos"),
        "postings",
    )
    counts = postings.groupBy("term_id").agg(F.count("*").alias("n"))
    # A term without postings leaves its phrases without a match.
    ranked = (
        places.join(known, "term").join(small(counts), "term_id", "left")
        .groupBy("phrase_id")
        .agg(F.sort_array(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "off", "term_id"))).alias("by_n"))
        .where("by_n[0].n > 0")
    )
    second = F.get("by_n", F.lit(1))
    rarest = stored(
        ranked.select(
            "phrase_id", F.get("by_n", F.lit(0)).term_id.alias("t1"), F.get("by_n", F.lit(0)).off.alias("o1"),
            second.term_id.alias("t2"), second.off.alias("o2"),
        ),
        "rarest",
    )
    return PhraseIndex(phrases, items, vocabulary, postings, rarest)


def _candidates(index: PhraseIndex) -> DataFrame:
    """(doc, key, phrase_id, size, start): where both shifted posting lists of a phrase meet."""
    # Phrases that overlap in an item share pairs, and so share the intersection.
    pairs = index.rarest.select("t1", "t2", (F.col("o2") - F.col("o1")).alias("gap")).distinct()
    pairs = stored(pairs.select(F.monotonically_increasing_id().alias("pair"), "t1", "t2", "gap"), "pairs")
    few = small(pairs)
    first = index.postings.join(few, F.col("term_id") == F.col("t1")).select("pair", "t2", "doc", "key", F.col("pos").alias("at"))
    second = index.postings.join(few, F.col("term_id") == F.col("t2")).select(
        "pair", "doc", "key", (F.col("pos") - F.col("gap")).cast("int").alias("at"))
    met = first.where("t2 IS NOT NULL").drop("t2").join(second, ["pair", "doc", "key", "at"]).unionByName(
        first.where("t2 IS NULL").drop("t2"))
    starts = pairs.join(index.rarest, (pairs.t1 == index.rarest.t1) & pairs.t2.eqNullSafe(index.rarest.t2) & (
        pairs.gap.eqNullSafe(index.rarest.o2 - index.rarest.o1))).select("pair", "phrase_id", "o1")
    starts = starts.join(index.phrases.select("phrase_id", "size"), "phrase_id")
    return met.join(small(starts), "pair").select("doc", "key", "phrase_id", "size", (F.col("at") - F.col("o1")).alias("start")).where("start >= 0")


def _near_candidates(index: PhraseIndex, slack: int) -> DataFrame:
    """(doc, key, phrase_id, size, start): where a phrase's two rarest terms stand within its length and ``slack`` words, from the
    first of them; ``size`` is that span. Postings meet by buckets of a span's length."""
    near = small(index.rarest.join(index.phrases, "phrase_id").select("phrase_id", "t1", "t2", (F.col("size") + slack).alias("span")))
    first = index.postings.join(near, F.col("term_id") == F.col("t1")).select(
        "phrase_id", "span", "t2", "doc", "key", "pos", (F.col("pos") / F.col("span")).cast("int").alias("bucket"))
    second = index.postings.join(near, F.col("term_id") == F.col("t2")).select(
        "phrase_id", "doc", "key", F.col("pos").alias("other"),
        F.explode(F.sequence((F.col("pos") / F.col("span")).cast("int") - 1, (F.col("pos") / F.col("span")).cast("int") + 1)).alias("bucket"))
    met = first.where("t2 IS NOT NULL").join(second, ["phrase_id", "doc", "key", "bucket"]).where("abs(pos - other) < span")
    met = met.select("doc", "key", "phrase_id", "span", "pos").unionByName(
        first.where("t2 IS NULL").select("doc", "key", "phrase_id", "span", "pos"))
    return met.select("doc", "key", "phrase_id", F.col("span").alias("size"), F.col("pos").alias("start"))


def _with_words(documents: DataFrame, candidates: DataFrame) -> DataFrame:
    """One row per candidate, and one for a document without any, beside the words of its document."""
    per_document = candidates.groupBy("doc", "key").agg(F.collect_set(F.struct("near", "phrase_id", "size", "start")).alias("found"))
    return (
        keyed(documents).join(per_document, ["doc", "key"], "left")
        .select("doc_id", "doc", "key", "found", item_words(F.col("text")).alias("w"))
        .select("doc_id", "doc", "key", F.size("w").alias("n_words"), "w", F.explode_outer("found").alias("c"))
    )


def contamination(
    documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, index: PhraseIndex | None = None, slack: int | None = None
) -> DataFrame:
    """Per document: ``doc_id``, ``n_words``, ``hits`` (sorted spans of words that are exact phrases; they may
    overlap), ``n_hit`` (words inside any), ``items`` (sorted ids of the items with such phrases) and, with ``slack``, ``near_items``
    (sorted ids of the items with a phrase whose different terms all stand, in any order, within its length plus so many words).

    A null or empty text has no words. An item shorter than the window is one phrase, an item without words or id
    none. Rows that repeat both ``doc_id`` and text count once; a null ``doc_id`` is kept. Without documents the result
    is empty, without items nothing is hit.
    """
    return _judged(documents, index or build_index(documents, benchmark, window), slack).drop("doc", "key")


def _items_of(found: DataFrame, phrases: str, index: PhraseIndex, name: str) -> DataFrame:
    """(doc, key, name): the sorted ids of the items that the phrases are in."""
    return (
        found.select("doc", "key", F.explode(phrases).alias("phrase_id")).join(small(index.items), "phrase_id")
        .groupBy("doc", "key").agg(F.sort_array(F.collect_set("item_id")).alias(name))
    )


def _judged(documents: DataFrame, index: PhraseIndex, slack: int | None = None) -> DataFrame:
    candidates = _candidates(index).withColumn("near", F.lit(False))
    if slack is not None:
        candidates = candidates.unionByName(_near_candidates(index, slack).withColumn("near", F.lit(True)))
    # The words of a phrase, or those around a place where it may be, in any order.
    start, size = F.col("c.start"), F.col("c.size")
    words = F.when(F.col("c.near"), F.slice("w", F.greatest(start - size + 2, F.lit(1)), 2 * size - 1)).otherwise(
        F.slice("w", F.coalesce(start + 1, F.lit(1)), F.coalesce(size, F.lit(0))))
    read = _with_words(documents, candidates).select(
        "doc_id", "doc", "key", "n_words", F.col("c.near").alias("near"), F.col("c.phrase_id").alias("phrase_id"), start.alias("start"), size.alias("size"),
        words.alias("words"))
    phrases = small(index.phrases.select("phrase_id", "terms"))
    inside = F.exists(
        F.sequence(F.lit(1), F.greatest(F.size("words") - F.col("size") + 1, F.lit(1))),
        lambda at: F.size(F.array_except("terms", F.slice("words", at, F.col("size")))) == 0,
    )
    checked = read.join(phrases, "phrase_id", "left")
    exact, close = ~F.col("near") & (F.col("words") == F.col("terms")), F.col("near") & inside
    found = [
        F.sort_array(F.collect_set(F.when(exact, F.struct("start", (F.col("start") + F.col("size")).alias("end"))))).alias("hits"),
        F.collect_set(F.when(exact, F.col("phrase_id"))).alias("phrases"),
    ]
    if slack is not None:
        found.append(F.collect_set(F.when(close, F.col("phrase_id"))).alias("near_phrases"))
    spans = stored(checked.groupBy("doc_id", "doc", "key").agg(F.max("n_words").cast("long").alias("n_words"), *found), "phrase-hits")
    covered = F.aggregate(
        "hits", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end")),
        lambda a, s: F.struct(
            (a.n + F.greatest(s.end - F.greatest(s.start, a.end), F.lit(0))).alias("n"), F.greatest(s.end, a.end).alias("end")),
    ).n
    none = F.array().cast("array<string>")
    judged = spans.join(_items_of(spans, "phrases", index, "items"), ["doc", "key"], "left")
    columns = ["doc_id", "doc", "key", "n_words", "hits", covered.alias("n_hit"), F.coalesce("items", none).alias("items")]
    if slack is not None:
        judged = judged.join(_items_of(spans, "near_phrases", index, "near_items"), ["doc", "key"], "left")
        columns.append(F.coalesce("near_items", none).alias("near_items"))
    return judged.select(*columns)


def proximity_matches(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, slack: int = SLACK, index: PhraseIndex | None = None) -> DataFrame:
    """(doc_id, item_id) where all different terms of a phrase stand, in any order, within its length plus ``slack`` words.

    The two rarest terms' postings meet first; the words around them decide. Nulls, repeated rows and empty tables as for
    ``contamination``.
    """
    found = contamination(documents, benchmark, window, index, slack)
    return found.select("doc_id", F.explode("near_items").alias("item_id")).distinct()


def item_digest(items: Column) -> Column:
    return F.sha2(F.array_join(items, ","), 256)


def without_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents, with all their columns, that hold no phrase of an item."""
    dirty = stored(_judged(documents, build_index(documents, benchmark, window)).where("n_hit > 0").select("doc", "key"), "dirty")
    rows, doc, key = marked(documents)
    dirty = dirty.withColumnsRenamed({"doc": doc, "key": key})
    return rows.join(dirty, [doc, key], "left_anti").select(*map(column, documents.columns))
