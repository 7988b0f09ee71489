import random

import pytest

from churnflow.llm import suffixes as s
from churnflow.llm.common import keyed


def brute(rows, length):
    raws = sorted({(i, s.bytes_of(t)) for i, t in rows if i is not None})
    seen, hits = set(), {}
    for i, raw in raws:
        covered = bytearray(len(raw))
        for k in range(len(raw) - length + 1):
            gram = raw[k : k + length]
            if gram in seen:
                covered[k : k + length] = b"\1" * length
            seen.add(gram)
        hits[i] = covered
    out = []
    for i, t in rows:
        raw = s.bytes_of(t)
        covered = hits.get(i, bytes(len(raw)))
        spans = sum(1 for k in range(len(raw)) if covered[k] and (k == 0 or not covered[k - 1]))
        out.append((i, len(raw), sum(covered), spans, bytes(b for b, c in zip(raw, covered) if not c)))
    return sorted(map(repr, out))


def got(df):
    return sorted(repr((r.doc_id, r.n_bytes, sum(x.end - x.start for x in r.removed), len(r.removed), bytes(r.kept))) for r in df.collect())


@pytest.mark.parametrize("length, gram, dense, seed", [(100, 32, 500, 1), (100, 32, 1, 2), (20, 6, 3, 3), (20, 8, 500, 4), (9, 2, 2, 5), (255, 32, 4, 6)])
def test_equals_brute_force(docs_of, messy, length, gram, dense, seed):
    rng = random.Random(seed)
    parts = ["".join(rng.choice("abé ") for _ in range(rng.randint(1, 150))) for _ in range(10)]
    rows = messy + [(300 + i, "".join(rng.choice(parts) + rng.choice("xyz") * rng.randint(0, 2) for _ in range(rng.randint(0, 6)))) for i in range(50)]
    assert got(s.without_repeated_strings(docs_of(rows), length, gram, dense)) == brute(rows, length)


def test_texts_that_share_an_id(docs_of, messy):
    """Each text is a document of its own; none loses what occurs once."""
    rng = random.Random(8)
    x, y, z = ("".join(rng.choice("abcdefgh ") for _ in range(240)) for _ in range(3))
    rows = [(1, x), (2, x), (2, y), (3, z + y), (3, z), (3, z), (None, x), (-4, y[:150])]
    docs = docs_of(rows)
    order = {(r.doc_id, r.text): (r.doc_id, r.key) for r in keyed(docs.where("doc_id IS NOT NULL")).collect()}
    numbers = {place: i for i, place in enumerate(sorted(set(order.values())))}
    want = brute([(numbers[order[r]] if r in order else None, r[1]) for r in rows], 100)
    back = {n: i for (i, _), n in numbers.items()} | {None: None}
    want = sorted(repr((back[r[0]], *r[1:])) for r in map(eval, want))
    assert got(s.without_repeated_strings(docs)) == want
    removed = sorted((r.doc_id, sum(e.end - e.start for e in r.removed)) for r in s.without_repeated_strings(docs_of([(1, x), (2, x), (2, y)])).collect())
    assert removed == [(1, 0), (2, 0), (2, 240)]


def test_small_tasks_settle_alike(docs_of, messy, monkeypatch):
    monkeypatch.setattr(s, "CHUNK", 3)
    assert got(s.without_repeated_strings(docs_of(messy))) == brute(messy, 100)


def test_empty_table(docs_of):
    assert s.without_repeated_strings(docs_of([])).count() == 0


def test_intervals():
    # a, ab, abc, abd, b: "ab" is shared by three, "a" by four.
    assert list(s.intervals([1, 2, 2, 0])) == [(2, 1, 4), (1, 0, 4)]
    assert list(s.intervals([])) == []
    assert list(s.intervals([3, 1, 3])) == [(3, 0, 2), (3, 2, 4), (1, 0, 4)]


def test_maximal_repeats_hold_all_occurrences():
    text = {1: b"xxABCDEFyy", 2: b"zxABCDEFyw", 3: b"qqABCDEFqq"}
    contexts = [((d, 2), t[:2][::-1], t[2:]) for d, t in text.items()]
    found = {(left, right): sorted(p) for left, right, p in s.maximal_repeats(contexts, 6)}
    assert found == {(0, 6): [(1, 2), (2, 2), (3, 2)], (1, 7): [(1, 2), (2, 2)]}


def test_anchors_depend_on_the_string_alone():
    rng = random.Random(1)
    string = bytes(rng.randrange(97, 100) for _ in range(100))
    places = set()
    for before in (b"", b"abc", b"x" * 77):
        raw = before + string
        at, _ = s.anchors(raw, 100, 32, s._rolling(raw))
        alone, _ = s.anchors(string, 100, 32, s._rolling(string))
        assert alone[0] + len(before) in at
        places.add(int(alone[0]))
    assert len(places) == 1
