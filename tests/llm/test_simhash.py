import random
from itertools import combinations

import pytest
import xxhash

from churnflow.llm import simhash as s
from churnflow.llm.graph import components


def fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(x, 42) for x in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(nodes, links):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows, radius=2):
    prints = [(i, fingerprint(t)) for i, t in rows]
    different = sorted({f for _, f in prints})
    root = roots(different, [(a, b) for a, b in combinations(different, 2) if (a ^ b).bit_count() <= radius])
    least = {}
    for i, f in prints:
        if i is not None:
            least[root[f]] = min(least.get(root[f], i), i)
    return sorted(map(repr, ((i, f"{f:016x}", least.get(root[f])) for i, f in prints)))


def got(df):
    return sorted(repr((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id)) for r in df.collect())


def near(rng):
    base = [rng.choice("abcdefghij") + str(rng.randint(0, 40)) for _ in range(150)]
    rows = []
    for i in range(25):
        w = list(base)
        for _ in range(i % 4):
            w[rng.randrange(len(w))] = "new"
        rows.append((500 - i, " ".join(w)))
    return rows


def test_equals_brute_force(docs_of, messy):
    rng = random.Random(4)
    rows = messy + near(rng) + near(rng)
    assert got(s.near_duplicates(docs_of(rows))) == brute(rows)


def test_hashes_in_pieces(monkeypatch, messy):
    monkeypatch.setattr(s, "_AT_ONCE", 7)
    for _, text in messy:
        assert s.fingerprint(text) == fingerprint(text)


@pytest.mark.parametrize("radius", [1, 2, 3])
def test_all_pairs_within_the_radius_are_connected(spark, radius):
    rng = random.Random(radius)
    values = {0, (1 << 63)}
    for _ in range(6):
        v = rng.getrandbits(64)
        for _ in range(12):
            values.add(v)
            for b in rng.sample(range(64), rng.randint(1, radius + 1)):
                v ^= 1 << b
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    frame = spark.createDataFrame([(v,) for v in signed], "fp long")
    links = [(r.a, r.b) for r in s.linked(frame, radius).collect()]
    close = [(a, b) for a, b in combinations(sorted(signed), 2) if ((a ^ b) & (1 << 64) - 1).bit_count() <= radius]
    assert set(links) <= set(close)
    assert roots(signed, links) == roots(signed, close)


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(1)
    links = {
        "path": [(i, i + 1) for i in range(60)], "star": [(i, 99) for i in range(50)],
        "random": [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(3, 3)], "none": [],
    }[shape]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = roots({n for link in links for n in link}, links)
    assert {n: got.get(n, n) for n in want} == want


def test_one_of_each(docs_of, messy):
    rows = messy + near(random.Random(2))
    frame = docs_of(rows)
    kept = s.one_of_each(frame)
    assert kept.columns == frame.columns
    found = {(r[0], r[2]) for r in (eval(x) for x in brute(rows))}
    want = sorted([i for i, c in found if i is not None and i == c] + [-99 for i, _ in rows if i is None])
    assert sorted(r.doc_id if r.doc_id is not None else -99 for r in kept.collect()) == want


def test_texts_that_share_an_id(docs_of):
    a, b = (" ".join(f"{c}{i}" for i in range(60)) for c in "ab")
    kept = s.one_of_each(docs_of([(5, a), (5, b), (9, b), (9, b), (5, a)])).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(5, a), (5, b)]


def test_columns_of_any_name_stay(spark):
    names = ["doc", "key", "fp", "_nth", "_kept", "n", "first", "root", "a.b"]
    rows = [(1, "some text here", *"abcdefghi"), (2, "some text here", *"abcdefghi"), (None, None, *"abcdefghi")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    kept = s.one_of_each(frame)
    assert kept.columns == frame.columns and sorted(map(repr, map(tuple, kept.collect()))) == sorted(map(repr, [rows[0], rows[2]]))


def test_empty_table(docs_of):
    assert s.near_duplicates(docs_of([])).count() == 0
    assert s.one_of_each(docs_of([])).count() == 0
