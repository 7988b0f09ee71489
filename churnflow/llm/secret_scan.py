"""Secrets in texts, with weak candidates reported only beside their complementary parts.

Base findings stand by themselves. Weak parts (a user or client id, a mixed-case random key, an endpoint) mean little
alone; they are found too, and an interval join within a scope, SCOPE code points around a part, decides which of them
are reported. The join runs on buckets as wide as the scope, and a bucket holds no more parts than fit into its
text, however many parts a document has. Everything is DataFrame operations.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from churnflow.llm.common import INSTEAD, MARK, column, helper, keyed, marked, stored

SCOPE = 200


def any_case(words: str) -> str:
    """A pattern for the words in either ASCII case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


# The patterns of base findings, in the order of their kinds.
BASE = {
    "assign": "(" + any_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    "access": r"AKIA[A-Z0-9]{16,}",
    "hex": r"[0-9a-f]{24,}",
}
#: An assigned value is a finding from this length on.
ASSIGNED = 6
WEAK = {
    "id": "(" + any_case("user|login|username|user_?id|client_?id|account_?id|access_?key_?id") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""",
    "key": r"[A-Za-z0-9+/_-]{20,}={0,2}",
    "endpoint": r"(https?://[A-Za-z0-9._~:/?#@-]{4,}|[a-z0-9-]+(\.[a-z0-9-]+)+:[0-9]{2,5})",
}
KINDS = (*BASE, *WEAK)
#: What a kind is part of, and what makes a weak kind complete.
ROLE = {"assign": "secret", "hex": "secret", "key": "secret", "access": "name", "id": "name", "endpoint": "place"}
COMPLEMENT = {"id": ("secret",), "key": ("name", "place"), "endpoint": ("secret",)}


def _kept(kind: str, hit: Column) -> Column:
    """Whether a match of the kind's pattern counts."""
    if kind == "assign":
        # The value is what follows the sign; it holds no quote, colon or space.
        value = F.regexp_extract(hit, r"""[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)$""", 1)
        return F.length(value) >= ASSIGNED
    if kind == "key":
        return hit.rlike("[A-Z]") & hit.rlike("[a-z]") & hit.rlike("[0-9]")
    return F.lit(True)


def _pieces(text: Column, pattern: str) -> Column:
    """The text cut into what is between matches and, at odd places, the matches."""
    return F.split(F.regexp_replace(text, f"({pattern})", f"{MARK}$1{MARK}"), MARK)


def _matches(documents: DataFrame, kinds: dict[str, str]) -> DataFrame:
    """(doc, key, kind, start, end, hit), in code points, of all matches, document by document."""
    text = F.translate(F.col("text"), MARK, INSTEAD)
    cut = F.explode(F.array(*(
        F.struct(F.lit(kind).alias("kind"), F.when(F.col("text").rlike(p), _pieces(text, p)).alias("pieces")) for kind, p in kinds.items())))
    place = Window.partitionBy("doc", "key", "kind").orderBy("i")
    return (
        documents.select("doc", "key", cut.alias("c")).where("c.pieces IS NOT NULL")
        .select("doc", "key", F.col("c.kind").alias("kind"), F.posexplode("c.pieces").alias("i", "piece"))
        # Rows that repeat a document count once.
        .groupBy("doc", "key", "kind", "i")
        .agg(F.max(F.length("piece")).alias("size"), F.max(F.when(F.col("i") % 2 == 1, F.col("piece"))).alias("hit"))
        .withColumn("end", F.sum("size").over(place))
        .where("hit IS NOT NULL")
        .select("doc", "key", "kind", (F.col("end") - F.col("size")).alias("start"), "end", "hit")
        .where(reduce(lambda a, k: F.when(F.col("kind") == k, _kept(k, F.col("hit"))).otherwise(a), kinds, F.lit(True)))
    )


def parts_of(documents: DataFrame) -> DataFrame:
    """(doc, key, kind, start, end) of base findings and of all weak parts."""
    return _matches(keyed(documents).where("text IS NOT NULL"), BASE | WEAK).drop("hit")


def linked(parts: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Base findings, and the weak parts that have a complementary part within ``scope`` code points.

    What counts is the gap, from the end of one to the start of the other, however long either is. A weak part that
    overlaps a base finding is left to the base.
    """
    role = F.create_map(*(F.lit(x) for pair in ROLE.items() for x in pair))
    base = F.col("kind").isin(*BASE)
    # A part is in every bucket that it touches, and meets what is there or in the next bucket to either side.
    first, last = F.floor(F.col("start") / scope), F.floor(F.col("end") / scope)
    near = parts.select(
        "doc", "key", F.col("start").alias("at"), F.col("end").alias("until"), role[F.col("kind")].alias("role"), base.alias("base"),
        F.explode(F.sequence(first - 1, last + 1)).alias("bucket"),
    )
    wanted = reduce(lambda a, k: a.when(F.col("kind") == k, F.array(*map(F.lit, COMPLEMENT[k]))), COMPLEMENT, F)
    weak = parts.where(~base).withColumns({"bucket": F.explode(F.sequence(first, last)), "wanted": wanted})
    apart = F.greatest(F.col("start") - F.col("until"), F.col("at") - F.col("end")) <= scope
    met = weak.join(near, ["doc", "key", "bucket"]).where(apart)
    judged = met.groupBy(*parts.columns).agg(
        F.max(F.array_contains("wanted", F.col("role"))).alias("complete"),
        F.max(F.col("base") & (F.col("at") < F.col("end")) & (F.col("until") > F.col("start"))).alias("known"),
    )
    return parts.where(base).unionByName(judged.where("complete AND NOT known").drop("complete", "known"))


def secrets(documents: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per document: ``doc_id`` and ``spans``, an array of (start, order, kind, end) sorted by start, then by kind.

    Places count code points. Null and empty texts have no spans. Rows that repeat both ``doc_id`` and text get equal
    spans each; a null ``doc_id`` is kept.
    """
    none = F.array().cast("array<struct<start: bigint, order: int, kind: string, end: bigint>>")
    found = _spans(parts_of(documents), scope)
    return keyed(documents).drop("text").join(found, ["doc", "key"], "left").select("doc_id", F.coalesce("spans", none).alias("spans"))


def _spans(parts: DataFrame, scope: int) -> DataFrame:
    order = F.create_map(*(F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)))
    return linked(stored(parts, "secret-parts"), scope).groupBy("doc", "key").agg(
        F.sort_array(F.collect_set(F.struct("start", order[F.col("kind")].alias("order"), "kind", "end"))).alias("spans"))


def written(spans: Column) -> Column:
    """The spans as kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")


def _runs(found: DataFrame) -> DataFrame:
    """(doc, key, runs): overlapping and touching findings as one, in order, as (start, end)."""
    place = Window.partitionBy("doc", "key").orderBy("start", "end")
    reached = F.max("end").over(place.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("start") < reached, 0).otherwise(1)
    return (
        found.select("doc", "key", "start", "end").withColumn("new", new)
        .withColumn("run", F.sum("new").over(place)).groupBy("doc", "key", "run")
        .agg(F.min("start").alias("start"), F.max("end").alias("end"))
        .groupBy("doc", "key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))
    )


#: Code points that a text is cut into before stretches are taken out of it: a stretch is found by its number, not by
#: reading the text from its start.
_PIECE = 1000


def _stretch(since: Column, until: Column) -> Column:
    """The code points of the text in ``pieces`` from one place to another; null is the end."""
    first, last = F.floor(since / _PIECE).cast("int"), F.floor(until / _PIECE).cast("int")
    behind = (since % _PIECE + 1).cast("int")
    piece = lambda i: F.coalesce(F.get("pieces", i), F.lit(""))
    inner = F.when(last - first > 1, F.array_join(F.slice("pieces", first + 2, last - first - 1), "")).otherwise("")
    return F.when(first == last, F.substring(piece(first), behind, (until - since).cast("int"))).otherwise(
        F.concat(F.substring(piece(first), behind, F.lit(_PIECE)), inner, F.substring(piece(last), F.lit(1), (until % _PIECE).cast("int"))))


def without_secrets(documents: DataFrame, scope: int = SCOPE, instead: str = "[SECRET]") -> DataFrame:
    """The documents, with all their columns, where every run of found secrets is replaced; ``n_chars`` follows the text.

    A document without findings is unchanged. The work on one text grows with its length and its findings, not with
    their product.
    """
    runs = stored(_runs(linked(stored(parts_of(documents), "secret-parts"), scope)), "secret-runs")
    texts = keyed(documents).join(runs, ["doc", "key"]).select(
        "doc", "key", "runs", F.length("text").cast("long").alias("size"), F.regexp_extract_all("text", F.lit("(?s).{1,%d}" % _PIECE), F.lit(0)).alias("pieces"))
    # What stands before each run, and behind the last.
    gaps = F.transform(F.sequence(F.lit(0), F.size("runs")), lambda i: _stretch(
        F.coalesce(F.get("runs", i - 1).end, F.lit(0)), F.coalesce(F.get("runs", i).start, F.col("size"))))
    replaced = texts.select("doc", "key", F.array_join(gaps, instead).alias("replaced")).groupBy("doc", "key").agg(F.max("replaced").alias("replaced"))
    rows, doc, key = marked(documents)
    new = helper(rows, "replaced")
    cleaned = rows.join(stored(replaced, "replaced").withColumnsRenamed({"doc": doc, "key": key, "replaced": new}), [doc, key], "left")
    changed = {"text": F.coalesce(F.col(new), F.col("text").cast("string"))}
    if "n_chars" in documents.columns:
        changed["n_chars"] = F.when(F.col(new).isNull(), F.col("n_chars")).otherwise(F.length(new)).cast(documents.schema["n_chars"].dataType)
    return cleaned.withColumns(changed).select(*map(column, documents.columns))
