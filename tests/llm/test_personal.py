import datetime
import hashlib
import re

import pytest

from churnflow.llm import personal as p

SECRET = "test key"


def keyed(purpose, turn, value):
    return int(hashlib.sha256(f"{SECRET}|{purpose}|{turn}|{value}".encode()).hexdigest()[:13], 16)


def feistel(purpose, high, low, highs, lows):
    for turn in range(p.ROUNDS):
        if turn % 2 == 0:
            high = (high + keyed(purpose, turn, low)) % highs
        else:
            low = (low + keyed(purpose, turn, high)) % lows
    return high, low


def digits(purpose, s):
    n, half = len(s), len(s) // 2
    high, low = feistel(f"{purpose}{n}", int(s[:half]), int(s[half:]), 10**half, 10 ** (n - half))
    return f"{high:0{half}d}{low:0{n - half}d}"


def luhn(s):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(s))) % 10 == 0


def iban_ok(s):
    s = s.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


CARDS = ["4111111111111111", "5500 0000 0000 0004", "3782-822463-10005", "4929348385146306"]
VALUES = {
    "card": [c for c in CARDS if luhn(re.sub("[^0-9]", "", c))], "phone": ["+1 (017) 555-7713", "(212) 555-0199", "212-555-0199", "+44 212 555 0199"],
    "ip": ["97.51.17.173", "0.0.0.0", "255.255.255.255"], "ssn": ["123-45-6789", "665-01-0001", "667-99-9999", "899-99-9999"], "date": ["2024-02-29", "1800-01-01", "31.12.2199", "12/25/2020"],
    "iban": ["DE89 3704 0044 0532 0130 00", "GB29NWBK60161331926819"], "email": ["john.DOE+x1@mail7.example.org", "a@b.cc"],
}
INVALID = ["4111111111111112", "1234567890123", "000-12-3456", "666-11-1111", "123-00-1234", "256.1.1.1", "2023-02-29", "2024-13-01", "1799-12-31", "DE88 3704 0044 0532 0130 00", "x4111111111111111"]


@pytest.fixture(scope="module")
def found(docs_of):
    rows = [(i, f"<{v}> and {v}, end", k) for i, (k, v) in enumerate((k, v) for k, vs in VALUES.items() for v in vs)]
    done = {r.doc_id: r for r in p.pseudonymized(docs_of(rows), SECRET).collect()}
    return [(k, v, done[i]) for i, (k, v) in enumerate((k, v) for k, vs in VALUES.items() for v in vs)]


def replaced(v, row):
    new = re.fullmatch(r"<(.*)> and (.*), end", row.text)
    assert new and new[1] == new[2]
    return new[1]


def test_format_is_kept_and_values_are_linked(found):
    for kind, v, row in found:
        assert [(x.kind, x.value) for x in row.found] == [(kind, v)] * 2
        new = replaced(v, row)
        shape = lambda s: re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", s)))
        if kind != "ip":
            assert shape(new) == shape(v)
        assert new != v


def test_results_are_valid_again(found):
    for kind, v, row in found:
        new = replaced(v, row)
        if kind == "card":
            assert luhn(re.sub("[^0-9]", "", new))
        elif kind == "iban":
            assert iban_ok(new) and new[:2] == v[:2]
        elif kind == "ip":
            assert all(0 <= int(o) <= 255 for o in new.split("."))
        elif kind == "ssn":
            assert not re.match("000|666|9", new) and "-00-" not in new and not new.endswith("0000")


def test_numbers_follow_the_network(found):
    for kind, v, row in found:
        new, plain = replaced(v, row), re.sub("[^0-9]", "", v)
        if kind == "card":
            assert re.sub("[^0-9]", "", new)[:-1] == digits("card", plain[:-1])
        elif kind == "phone":
            assert re.sub("[^0-9]", "", new)[-10:] == digits("phone", plain[-10:])
        elif kind == "ip":
            o = [int(x) for x in v.split(".")]
            high, low = feistel("ip", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
            assert new == f"{high >> 8}.{high & 255}.{low >> 8}.{low & 255}"
        elif kind == "date" and "-" in v:
            n = (datetime.date.fromisoformat(v) - datetime.date(1800, 1, 1)).days
            high, low = feistel("date", n // 773, n % 773, 189, 773)
            assert new == (datetime.date(1800, 1, 1) + datetime.timedelta(high * 773 + low)).isoformat()


def test_equal_dates_in_other_formats_stay_linked(docs_of):
    rows = [(1, "2024-03-05"), (2, "05.03.2024"), (3, "05/03/2024")]
    a, b, c = (r.text for r in p.pseudonymized(docs_of(rows), SECRET).orderBy("doc_id").collect())
    assert b == ".".join(reversed(a.split("-"))) and c == b.replace(".", "/")


def test_different_values_differ(docs_of, spark):
    rows = [(i, f"{i % 256}.{i // 256}.7.{i % 7} and u{i}@x.yz on {datetime.date(2000, 1, 1) + datetime.timedelta(i)}") for i in range(600)]
    out = [re.fullmatch("(.*) and (.*) on (.*)", r.text).groups() for r in p.pseudonymized(docs_of(rows), SECRET).collect()]
    assert all(len(set(column)) == 600 for column in zip(*out))


def test_invalid_and_odd_rows_stay(docs_of, messy):
    rows = messy + [(800 + i, f"see {v} here") for i, v in enumerate(INVALID)]
    got = p.pseudonymized(docs_of(rows), SECRET).collect()
    assert all(r.found == [] for r in got)
    assert sorted(repr((r.doc_id, r.text)) for r in got) == sorted(map(repr, rows))
    assert p.pseudonymized(docs_of([]), SECRET).count() == 0


def test_valid_values_are_found_beside_and_inside_look_alikes(docs_of):
    card = "4111 1111 1111 1111"
    ibans = ["NO9386011117947", "BE68539007547034", "BE68 5390 0754 7034", "AT611904300234573201", "GB29NWBK60161331926819", "ES9121000418450200051332", "ES91 2100 0418 4502 0005 1332"]
    texts = [(f"{iban} {word}", ("iban", iban)) for iban in ibans for word in ("BIC", "EUR", "AND", "BANK", "A", "BIC CODE")]
    texts += [("ref AB12 " + card, ("card", card)), ("1234 " + card + " end", ("card", card)), ("DE88 3704 0044 " + card, ("card", card))]
    got = {r.doc_id: r for r in p.pseudonymized(docs_of([(i, f"👍 {t}, end") for i, (t, _) in enumerate(texts)]), SECRET).collect()}
    for i, (text, (kind, value)) in enumerate(texts):
        assert [(x.kind, x.value) for x in got[i].found] == [(kind, value)], text
        before, behind = f"👍 {text}, end".split(value)
        new = got[i].text[len(before):len(got[i].text) - len(behind)]
        assert got[i].text == before + new + behind and new != value and len(new) == len(value)
        assert iban_ok(new) if kind == "iban" else luhn(new.replace(" ", ""))


def test_key_matters(docs_of):
    one, other = (p.pseudonymized(docs_of([(1, "4111111111111111")]), k).first().text for k in ("a", "b"))
    assert one != other
