import pytest

#: Columns beside the ones that count, named like the ones that operators use inside.
CLASHING = "key string, doc string, at string, found string, pieces string, kind string, fp string, x string, h string, text_ string"
FILL = (None, "doc", "1", "", "p", "assign", "0", "x", "h", "t")


@pytest.fixture(scope="session")
def docs_of(spark):
    """A documents table from (doc_id, text) or (doc_id, text, lang) rows, in several partitions."""

    def make(rows, partitions=3):
        full = [(r[0], r[1], r[2] if len(r) > 2 else None, *FILL) for r in rows]
        frame = spark.createDataFrame(full, f"doc_id long, text string, lang string, {CLASHING}")
        return frame.repartition(partitions) if rows else frame

    return make


@pytest.fixture(scope="session")
def messy():
    """Rows with every kind of odd cell: nulls, empty and long texts, repeated rows, ids far apart."""
    long = " ".join(f"w{i % 977} the-{i % 13}" for i in range(12_000))
    passage = " ".join(f"shared{i}" for i in range(70))
    return [
        (1, None), (2, ""), (3, " \t\n "), (4, "Word"), (5, f"Alpha beta. {passage} tail five"), (6, f"{passage}"),
        (7, f"head {passage} x\n{passage} end"), (7, f"head {passage} x\n{passage} end"), (None, f"no id {passage}"), (None, None),
        (8, long), (9, "é É ß ΑΣ 漢字 👍🏽 á"), (10, "!!! ??? ..."), (11, "\x00\x01 ctrl\x7f\x1f \x0b\x0c"), (1 << 53, "huge id"),
        ((1 << 53) + 1, f"huge id too {passage}"), (-5, "negative id"), (12, "aaaa " * 300), (13, "a" * 3000), (14, "a" * 2999 + "b"),
    ]
