"""Personal numbers, dates and addresses replaced by format-preserving pseudonyms.

A value is validated first (check digits, ranges, calendar). Its digits, letters or day number are then permuted by a
Feistel network keyed with a secret: half of the value is shifted by a keyed hash of the other half, in turns. The
result has the same format and is valid again, equal values get equal pseudonyms in all documents, and different
values different ones. Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnflow.llm.common import INSTEAD, MARK, documents_of

ROUNDS = 8
_L, _R = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"
#: Candidates by kind; the first pattern that matches at a place wins, and if that isn't valid the next place is tried.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+" + _R,
    "date": _L + r"(?:[12][0-9]{3}-[0-9]{2}-[0-9]{2}|[0-9]{2}[./][0-9]{2}[./][12][0-9]{3})" + _R,
    "iban": _L + r"[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?" + _R,
    "ip": r"(?<![A-Za-z0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![A-Za-z0-9]|\.[0-9])",
    "phone": r"(?<![A-Za-z0-9+])(?:\+[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}" + _R,
    "ssn": _L + r"[0-9]{3}-[0-9]{2}-[0-9]{4}" + _R,
    "card": _L + r"(?:[0-9]{13,19}|(?:[0-9]{4}[\x20-]){3}[0-9]{4}|[0-9]{4}[\x20-][0-9]{6}[\x20-][0-9]{5})" + _R,
}
# How many characters the IBANs of a country have.
IBAN_LENGTHS = {
    country: n for n, countries in {
        15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
        22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
        26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
        30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
    }.items() for country in countries.split()
}
#: 400 years from this day on are 146,097 days, and 146,097 = 189 * 773.
FIRST_DAY, DAYS_HIGH, DAYS_LOW = "1800-01-01", 189, 773


def let(value: Column, body) -> Column:
    """``body`` of the value, which is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _hash(secret: str, purpose: Column | str, turn: Column, value: Column) -> Column:
    """A keyed hash as a number below 16**13."""
    text = F.concat_ws("|", F.lit(secret), F.lit(purpose) if isinstance(purpose, str) else purpose, turn.cast("string"), value.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long")


def feistel(secret: str, purpose: Column | str, high: Column, low: Column, highs: Column, lows: Column) -> Column:
    """Permutes the pairs (high, low) with high < highs and low < lows; a struct of both."""

    def turn(pair: Column, i: Column) -> Column:
        moved_high = F.struct(((pair.high + _hash(secret, purpose, i, pair.low)) % highs).alias("high"), pair.low.alias("low"))
        moved_low = F.struct(pair.high.alias("high"), ((pair.low + _hash(secret, purpose, i, pair.high)) % lows).alias("low"))
        return F.when(i % 2 == 0, moved_high).otherwise(moved_low)

    start = F.struct(high.try_cast("long").alias("high"), low.try_cast("long").alias("low"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


def permuted_digits(secret: str, purpose: str, digits: Column) -> Column:
    """Permutes the strings of 2 to 19 digits of each length."""
    ten = lambda k: F.pow(F.lit(10), k).cast("long")

    def permuted(s: Column) -> Column:
        n = F.length(s)
        half = F.floor(n / 2).cast("int")
        high, low = F.substring(s, F.lit(1), half), F.substring(s, half + 1, n)
        pair = feistel(secret, F.concat(F.lit(purpose), n.cast("string")), high, low, ten(half), ten(n - half))
        padded = lambda x, size: F.lpad(x.cast("string"), size, F.lit("0"))
        return let(pair, lambda p: F.concat(padded(p.high, half), padded(p.low, n - half)))

    return let(digits, permuted)


def permuted_name(secret: str, purpose: str, name: Column) -> Column:
    """Permutes strings so that letters of either case, digits and other characters stay such, place by place.

    Each half's letters and digits are shifted by a stream of keyed hashes of the other half.
    """
    codes = lambda s: F.transform(F.filter(F.split(s, ""), lambda c: c != ""), F.ascii)

    def shifted(part: Column, other: Column, i: Column) -> Column:
        # Sixty-four hash bytes, used again from the start beyond that.
        keyed = F.sha2(F.concat_ws("|", F.lit(secret), F.lit(purpose), i.cast("string"), F.array_join(F.transform(other, lambda c: c.cast("string")), ",")), 512)

        def shifted_by(stream: Column) -> Column:
            def shift(c: Column, at: Column) -> Column:
                by = F.conv(F.substring(stream, 2 * (at % 64) + 1, F.lit(2)), 16, 10).cast("int")
                within = lambda first, size: (c - first + by) % size + first
                return (F.when(c.between(48, 57), within(48, 10)).when(c.between(65, 90), within(65, 26))
                        .when(c.between(97, 122), within(97, 26)).otherwise(c)).cast("int")

            return F.transform(part, shift)

        return let(keyed, shifted_by)

    def halves(s: Column) -> Column:
        half = F.floor(F.length(s) / 2).cast("int")
        return F.struct(codes(F.substring(s, F.lit(1), half)).alias("a"), codes(F.substring(s, half + 1, F.length(s))).alias("b"))

    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)), let(name, halves),
        lambda p, i: F.when(i % 2 == 0, F.struct(shifted(p.a, p.b, i).alias("a"), p.b.alias("b"))).otherwise(
            F.struct(p.a.alias("a"), shifted(p.b, p.a, i).alias("b"))),
        lambda p: F.array_join(F.transform(F.concat(p.a, p.b), lambda c: F.char(c)), ""),
    )


def refilled(shape: Column, characters: Column) -> Column:
    """The shape with its letters and digits replaced, one by one, by given characters; what else it has stays."""
    return let(characters, lambda new: F.aggregate(
        F.filter(F.split(shape, ""), lambda c: c != ""), F.struct(F.lit("").alias("out"), F.lit(0).alias("i")),
        lambda a, c: F.when(
            c.rlike("[A-Za-z0-9]"),
            F.struct(F.concat(a.out, F.substring(new, a.i + 1, F.lit(1))).alias("out"), (a.i + 1).alias("i")),
        ).otherwise(F.struct(F.concat(a.out, c).alias("out"), a.i.alias("i"))),
        lambda a: a.out,
    ))


def luhn_sum(digits: Column) -> Column:
    """The sum of digits in which every second from the right is doubled; valid numbers' sums end with 0."""

    def add(total: Column, d: Column, i: Column) -> Column:
        return total + F.when(i % 2 == 0, d).otherwise(2 * d - F.when(d > 4, 9).otherwise(0))

    numbers = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""), lambda c, i: F.struct(c.try_cast("int").alias("d"), i.alias("i")))
    return F.aggregate(numbers, F.lit(0), lambda total, x: add(total, x.d, x.i))


def iban_rest(compact: Column) -> Column:
    """The remainder by 97 of the number that an IBAN stands for; 1 if it is valid."""
    moved = F.concat(F.substring(compact, F.lit(5), F.lit(64)), F.substring(compact, 1, 4))
    return F.aggregate(
        F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0),
        lambda r, c: (F.when(c.rlike("[0-9]"), r * 10 + F.ascii(c) - 48).otherwise(r * 100 + F.ascii(c) - 55) % 97).cast("int"))


def _compact(hit: Column) -> Column:
    return F.regexp_replace(hit, "[^A-Za-z0-9]", "")


def _day(hit: Column) -> Column:
    """The date a match means, or null: year first, or day first, or else month first."""
    day = lambda text: F.try_to_timestamp(text, F.lit("yyyy-MM-dd")).cast("date")
    parts = F.split(F.translate(hit, "/", "."), r"\.")
    made = lambda y, m, d: day(F.concat_ws("-", *(F.get(parts, F.lit(i)) for i in (y, m, d))))
    return F.when(hit.contains("-"), day(hit)).otherwise(F.coalesce(made(2, 1, 0), F.when(hit.contains("/"), made(2, 0, 1))))


def valid(kind: str, hit: Column) -> Column:
    """Whether a match of the kind's pattern is a value of that kind."""
    compact = _compact(hit)
    if kind == "card":
        return luhn_sum(compact) % 10 == 0
    if kind == "iban":
        return iban_rest(compact) == 1
    if kind == "ip":
        return ~F.exists(F.split(hit, r"\."), lambda o: o.try_cast("int") > 255)
    if kind == "ssn":
        return ~(hit.rlike("^(000|666|9)") | hit.rlike("-00-") | hit.rlike("-0000$"))
    if kind == "date":
        return F.coalesce(_day(hit).between(F.lit(FIRST_DAY).cast("date"), F.date_add(F.lit(FIRST_DAY).cast("date"), DAYS_HIGH * DAYS_LOW - 1)), F.lit(False))
    return F.lit(True)


def pseudonym(kind: str, hit: Column, secret: str) -> Column:
    """A valid value of the same kind and format."""
    compact = _compact(hit)
    if kind == "card":
        body = let(compact, lambda s: permuted_digits(secret, kind, F.substring(s, F.lit(1), F.length(s) - 1)))
        check = lambda b: (10 - luhn_sum(F.concat(b, F.lit("0"))) % 10) % 10
        return refilled(hit, let(body, lambda b: F.concat(b, check(b).cast("string"))))
    if kind == "iban":
        country, body = F.substring(compact, 1, 2), permuted_name(secret, kind, F.substring(compact, F.lit(5), F.length(compact)))
        check = lambda b: F.lpad((98 - iban_rest(F.concat(country, F.lit("00"), b))).cast("string"), 2, "0")
        return refilled(hit, let(body, lambda b: F.concat(country, check(b), b)))
    if kind == "ip":
        octets = F.transform(F.split(hit, r"\."), lambda x: x.try_cast("long"))
        o = [F.get(octets, F.lit(i)) for i in range(4)]
        pair = feistel(secret, kind, o[0] * 256 + o[1], o[2] * 256 + o[3], F.lit(65536), F.lit(65536))
        return let(pair, lambda p: F.concat_ws(
            ".", *((F.floor(x / 256) if upper else x % 256).cast("string") for x in (p.high, p.low) for upper in (True, False))))
    if kind == "date":
        first = F.lit(FIRST_DAY).cast("date")
        pair = let(F.datediff(_day(hit), first), lambda n: feistel(
            secret, kind, F.floor(n / DAYS_LOW), n % DAYS_LOW, F.lit(DAYS_HIGH), F.lit(DAYS_LOW)))
        moved = let(pair, lambda p: F.date_add(first, (p.high * DAYS_LOW + p.low).cast("int")))
        return let(moved, lambda day: F.when(hit.contains("-"), F.date_format(day, "yyyy-MM-dd"))
                   .when(hit.contains("/"), F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "dd.MM.yyyy")))
    if kind == "phone":
        # The country's number stays; the ten digits behind it move.
        code = F.regexp_extract(hit, r"^\+[0-9]{1,3}(?=[\x20.-]?(\(|[0-9]{3}[\x20.-]))", 0)
        rest = F.substring(hit, F.length(code) + 1, F.length(hit))
        return F.concat(code, refilled(rest, permuted_digits(secret, kind, F.regexp_replace(rest, "[^0-9]", ""))))
    if kind == "ssn":
        # Only numbers that pass the check again are reached: 1 to 665 and 667 to 899, 1 to 99, 1 to 9999.
        area = F.substring(compact, 1, 3).try_cast("long")
        high = F.when(area > 666, area - 2).otherwise(area - 1)
        low = (F.substring(compact, 4, 2).try_cast("long") - 1) * 9999 + F.substring(compact, 6, 4).try_cast("long") - 1
        pair = feistel(secret, kind, high, low, F.lit(898), F.lit(99 * 9999))
        number = lambda x, width: F.lpad(x.cast("string"), width, "0")
        return let(pair, lambda p: F.concat_ws(
            "-", number(p.high + F.when(p.high > 664, 2).otherwise(1), 3), number(F.floor(p.low / 9999) + 1, 2), number(p.low % 9999 + 1, 4)))
    return F.concat(permuted_name(secret, kind, F.substring_index(hit, "@", 1)), F.lit("@"), permuted_name(secret, "domain", F.substring_index(hit, "@", -1)))


def kind_of(hit: Column) -> Column:
    """The first kind whose pattern the whole match has, if it is valid; else null."""
    kind = F
    for k, p in PATTERNS.items():
        kind = kind.when(hit.rlike(f"^(?:{p})$"), F.when(valid(k, hit), F.lit(k)))
    return kind


def readings(hit: Column) -> Column:
    """What a match may mean: itself, and an IBAN also without the words behind it.

    The country's length comes first; without a known country, every shorter cut is tried, the longest first.
    """
    words = F.split(hit, " ")
    cuts = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda i: F.array_join(F.slice(words, 1, i), " "))
    length = F.create_map(*(F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair))[F.substring(hit, 1, 2)]
    known = F.concat(F.filter(cuts, lambda c: F.length(_compact(c)) == length), F.array(hit))
    return F.when(hit.rlike(f"^(?:{PATTERNS['iban']})$"), F.when(length.isNull(), cuts).otherwise(known)).otherwise(F.array(hit))


def meant(hit: Column) -> Column:
    """Kind and value of the first reading that is valid; else null."""
    judged = F.transform(readings(hit), lambda r: F.struct(kind_of(r).alias("kind"), r.alias("value")))
    return F.get(F.filter(judged, lambda r: r.kind.isNotNull()), F.lit(0))


def pseudonymized(documents: DataFrame, secret: str) -> DataFrame:
    """Per row: ``doc_id``, ``found`` (an array of kind and value, in the text's order) and ``text`` with pseudonyms.

    A null text stays null with nothing found; empty texts and texts without valid values stay as they are. Rows
    that repeat are kept, and so is a null ``doc_id``. Invalid look-alikes are left alone, but not the valid values that
    begin inside them.
    """
    any_kind = "|".join(f"(?:{p})" for p in PATTERNS.values())
    text = F.translate(F.col("text"), MARK, INSTEAD)
    # Every kind has a digit or an at sign; most texts have neither.
    likely = F.when(F.col("text").rlike("[@0-9]"), F.col("text").rlike(any_kind))
    # A candidate may begin inside another: the text is cut before each, and their values are listed beside.
    pieces = F.when(likely, F.split(F.regexp_replace(text, f"(?={any_kind})", MARK), MARK))
    values = F.when(likely, F.regexp_extract_all(text, F.lit(f"(?=({any_kind}))"), F.lit(1)))

    def replaced(h: Column) -> Column:
        out = F
        for k in PATTERNS:
            out = out.when(h.kind == k, pseudonym(k, h.value, secret))
        return F.concat(out.otherwise(F.lit("")), h.rest)

    def taken(a: Column, x: Column) -> Column:
        # ``reach`` is how far the value taken last reaches behind this place. Whether this one is taken, and how much of
        # the piece is covered, is noted in a string: an array would be copied cell by cell with every candidate.
        takes = (a.reach == 0) & x.width.isNotNull()
        covered = F.when(takes, x.width).otherwise(a.reach)
        note = F.concat(a.notes, F.when(takes, F.lit("+")).otherwise(F.lit("-")), covered.cast("string"), F.lit(","))
        return F.struct(note.alias("notes"), F.greatest(covered - x.gap, F.lit(0)).alias("reach"))

    def hit(x: Column, note: Column) -> Column:
        value = F.when(note.startswith("+"), x.meant)
        rest = F.substring(x.piece, F.substring(note, F.lit(2), F.length(note)).cast("int") + 1, F.length(x.piece))
        return F.struct(value.kind.alias("kind"), value.value.alias("value"), rest.alias("rest"))

    behind = F.slice("pieces", F.lit(2), F.size("pieces"))
    candidates = F.zip_with(behind, F.transform("values", meant), lambda p, m: F.struct(
        p.alias("piece"), F.length(p).alias("gap"), m.alias("meant"), F.length(m.value).alias("width")))
    notes = F.aggregate("candidates", F.struct(F.lit("").alias("notes"), F.lit(0).alias("reach")), taken, lambda a: F.split(F.rtrim(a.notes, F.lit(",")), ","))
    marked = (
        documents_of(documents).select("doc_id", "text", pieces.alias("pieces"), values.alias("values"))
        .withColumn("candidates", candidates).withColumn("notes", notes).withColumn("hits", F.zip_with("candidates", "notes", hit))
    )
    joined = F.concat(F.get("pieces", F.lit(0)), F.array_join(F.transform("hits", replaced), ""))
    found = F.transform(F.filter("hits", lambda h: h.kind.isNotNull()), lambda h: F.struct(h.kind.alias("kind"), h.value.alias("value")))
    return marked.select(
        "doc_id", F.coalesce(found, F.array().cast("array<struct<kind: string, value: string>>")).alias("found"),
        F.when(F.exists("hits", lambda h: h.kind.isNotNull()), joined).otherwise(F.col("text")).alias("text"),
    )
