import hashlib
import random
import re

import pytest

from churnflow.llm import decontamination as d

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, items, window=10):
    phrases = {}
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        n = min(window, len(w))
        for i in range(len(w) - n + 1):
            phrases.setdefault(tuple(w[i : i + n]), set()).add(str(item))
    out = set()
    for doc_id, text in set(rows):
        w, hit, ids = words(text), set(), set()
        for n in {len(p) for p in phrases}:
            for i in range(len(w) - n + 1):
                if found := phrases.get(tuple(w[i : i + n])):
                    hit.update(range(i, i + n))
                    ids |= found
        out.add((doc_id, len(w), len(hit), tuple(sorted(ids))))
    return out


def got(df):
    return {(r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in df.collect()}


@pytest.fixture(scope="module")
def case(messy):
    rng = random.Random(3)
    vocabulary = [f"v{i}" for i in range(12)] + ["Rare", "É"]
    text = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", " -"]) for _ in range(n))
    items = [(i, text(rng.randint(1, 40))) for i in range(25)] + [(90, None), (91, ""), (92, "..."), (None, "v1 v2"), (93, "one"), (94, messy[5][1]), (94, "v3 v3 v3")]
    rows = [(100 + i, text(rng.randint(0, 60)) + " " + (items[i % 25][1] if i % 3 == 0 else "") + " " + text(5)) for i in range(60)]
    return messy + rows, items


@pytest.mark.parametrize("broadcast", [True, False])
def test_equals_brute_force(spark, docs_of, case, monkeypatch, broadcast):
    rows, items = case
    if not broadcast:
        monkeypatch.setattr(d, "small", lambda df: df)
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, key string")
    assert got(d.contamination(docs_of(rows), benchmark)) == brute(rows, items)
    both = d.contamination(docs_of(rows), benchmark, slack=5)
    assert got(both) == brute(rows, items)
    assert {(r.doc_id, r.n_words, tuple(r.near_items)) for r in both.collect()} == near(rows, items, 5)


def near(rows, items, slack, window=10):
    phrases = {}
    for item, text in items:
        w = words(text)
        n = min(window, len(w))
        for i in range(len(w) - n + 1) if item is not None and w else ():
            phrases.setdefault((frozenset(w[i : i + n]), n + slack), set()).add(str(item))
    out = set()
    for doc_id, text in set(rows):
        w = words(text)
        places = {t: [i for i, x in enumerate(w) if x == t] for t in set(w)}
        ids = set()
        for (terms, span), of in phrases.items():
            if terms <= places.keys():
                rarest = min(terms, key=lambda t: len(places[t]))
                # Any window with all terms holds the rarest one.
                if any(terms <= set(w[s : s + span]) for at in places[rarest] for s in range(max(0, at - span + 1), at + 1)):
                    ids |= of
        out.add((doc_id, len(w), tuple(sorted(ids))))
    return out


def test_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert got(d.contamination(docs_of([(1, "a b c")]), none)) == {(1, 3, 0, ())}
    assert d.contamination(docs_of([]), one).count() == 0
    assert d.without_contaminated(docs_of([]), one).count() == 0
    assert d.proximity_matches(docs_of([]), one).count() == 0


def test_clean_documents_stay_with_their_columns(spark, docs_of, case):
    rows, items = case
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    frame = docs_of(rows)
    kept = d.without_contaminated(frame, benchmark)
    assert kept.columns == frame.columns
    dirty = {(r[0], t) for r in brute(rows, items) if r[2] for i, t in rows if i == r[0] and brute([(i, t)], items) & {r}}
    assert sorted(map(repr, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(repr, (r for r in rows if r not in dirty)))


def test_words_in_any_order_within_reach(spark, docs_of):
    item = spark.createDataFrame([(1, "alpha beta gamma delta")], "item_id long, text string")
    rows = [(1, "delta x gamma beta y alpha"), (2, "alpha beta gamma " + "x " * 20 + "delta"), (3, "alpha beta gamma"), (4, "x alpha beta gamma delta"), (5, None)]
    assert {r.doc_id for r in d.proximity_matches(docs_of(rows), item, slack=3).collect()} == {1, 4}


def test_digest(spark):
    from pyspark.sql import functions as F

    row = spark.range(1).select(d.item_digest(F.array(F.lit("10"), F.lit("9"))).alias("h")).first()
    assert row.h == hashlib.sha256(b"10,9").hexdigest()


def test_dirty_documents_are_not_broadcast_by_hint(docs_of, spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        items = spark.createDataFrame([("i", "some words of an item")], "item_id string, text string")
        clean = d.without_contaminated(docs_of([(1, "here are some words of an item"), (2, "clean")]), items)
        plan = clean._jdf.queryExecution().executedPlan().toString()
        assert [r.doc_id for r in clean.collect()] == [2]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "Join" in plan and "Broadcast" not in plan
