import pytest

from churnflow.operators import quality
from churnflow.sources.tables import read_csv, write_csv
from tests.rows import FIRST, SECOND, SPEC, changed, frame


def test_valid_rows_pass(spark):
    assert quality.validate(frame(spark), SPEC) is True


def test_empty_frame(spark):
    with pytest.raises(ValueError, match="Dataset is empty"):
        quality.validate(frame(spark).limit(0), SPEC)
    with pytest.raises(ValueError, match="Dataset is empty"):
        quality.validate(frame(spark).select(), SPEC)


def test_missing_columns_in_required_order(spark):
    with pytest.raises(ValueError, match=r"Missing required columns: \['gender', 'Churn'\]"):
        quality.validate(frame(spark).drop("Churn", "gender"), SPEC)


def test_unexpected_column_comes_before_duplicate_id(spark):
    df = frame(spark, FIRST, FIRST).selectExpr("*", "1 AS extra")
    with pytest.raises(ValueError, match=r"Unexpected columns found: \['extra'\]"):
        quality.validate(df, SPEC)


def test_duplicate_id(spark):
    with pytest.raises(ValueError, match="Found 1 duplicate customer IDs"):
        quality.validate(frame(spark, FIRST, SECOND | {"customerID": "c-07"}), SPEC)


def test_null_ids_are_equal(spark):
    df = frame(spark, FIRST | {"customerID": None}, SECOND | {"customerID": None})
    assert quality.duplicate_ids(df, "customerID").first()["duplicates"] == 1


@pytest.mark.parametrize(
    "column, value, kind, text",
    [
        ("Partner", None, None, r"Missing values found: \{'Partner': 1\}"),
        ("MonthlyCharges", float("nan"), None, r"Missing values found: \{'MonthlyCharges': 1\}"),
        ("Contract", " \t\n", None, r"Unexpected blank values found: \['Contract'\]"),
        ("gender", "Unknown", None, r"Unexpected categories in 'gender': \{'Unknown'\}"),
        ("gender", "male", None, r"Unexpected categories in 'gender': \{'male'\}"),
        ("Churn", "Maybe", None, r"Unexpected categories in 'Churn': \{'Maybe'\}"),
        ("TotalCharges", "abc", None, "Column 'TotalCharges' contains invalid numerical values."),
        ("TotalCharges", "nan", None, "Column 'TotalCharges' contains invalid numerical values."),
        ("TotalCharges", "1d", None, "Column 'TotalCharges' contains invalid numerical values."),
        ("TotalCharges", "0x1p3", None, "Column 'TotalCharges' contains invalid numerical values."),
        ("tenure", "x", "string", "Column 'tenure' contains non-numerical values."),
        ("SeniorCitizen", 2, None, r"Invalid SeniorCitizen values: \{2.0\}"),
        ("SeniorCitizen", "nan", "string", r"Invalid SeniorCitizen values: \{nan\}"),
        ("tenure", -1, None, "Negative tenure values found."),
        ("MonthlyCharges", -0.5, None, "Negative MonthlyCharges values found."),
        ("TotalCharges", "-5", None, "Negative TotalCharges values found."),
    ],
)
def test_each_check_names_its_fault(spark, column, value, kind, text):
    rows = FIRST | {column: value}, SECOND
    if kind == "string":
        rows = tuple(r | {column: str(r[column])} for r in rows)
    df = frame(spark, *rows, **({column: kind} if kind else {}))
    with pytest.raises(ValueError, match=text):
        quality.validate(df, SPEC)


@pytest.mark.parametrize(
    "column, value",
    [
        ("gender", " Male\t"), ("gender", " Male "), ("TotalCharges", " "), ("TotalCharges", "\t\x1f"),
        ("TotalCharges", "1e3"), ("TotalCharges", ".5"), ("TotalCharges", "inf"), ("Churn", " Yes"),
    ],
)
def test_legal_oddities(spark, column, value):
    assert quality.validate(changed(spark, column, value), SPEC)


def test_two_faults_report_the_first(spark):
    df = frame(spark, FIRST | {"gender": "x", "Partner": None}, SECOND | {"tenure": -1})
    with pytest.raises(ValueError, match="Missing values found"):
        quality.validate(df, SPEC)


def test_report_lists_schema_faults_and_allowed_blanks(spark):
    df = changed(spark, "TotalCharges", " ").drop("gender").selectExpr("*", "1 AS extra")
    rows = {(r["check"], r["column"]): (r["violations"], r["status"]) for r in quality.validation_report(df, SPEC).collect()}
    assert rows["V2", "gender"] == (1, "failed")
    assert rows["V3", "extra"] == (1, "failed")
    assert rows["V13", "TotalCharges"] == (1, "allowed")
    assert rows["V1", ""] == (0, "passed")
    assert ("V7", "gender") not in rows
    positions = sorted(r["position"] for r in quality.validation_report(df, SPEC).collect())
    assert positions == list(range(1, len(rows) + 1))


def test_long_lists_of_values_are_shortened_in_the_text_only(spark):
    rows = [FIRST | {"customerID": str(i), "gender": f"g{i:03}"} for i in range(50)]
    df = frame(spark, *rows)
    with pytest.raises(ValueError, match=r"'g019', \.\.\. and 30 more\}"):
        quality.validate(df, SPEC)
    assert quality.unexpected_categories(df, SPEC.categories).count() == 50


def test_csv_cells(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = FIRST | {"TotalCharges": " ", "gender": "NA", "Contract": '"quoted", text'}, SECOND | {"TotalCharges": ""}
    write_csv(frame(spark, *rows), folder)
    found = {r["customerID"]: r for r in read_csv(spark, folder).collect()}
    assert found["c-07"]["TotalCharges"] == " "  # an allowed blank
    assert found["c-07"]["gender"] is None  # a missing value
    assert found["c-07"]["Contract"] == '"quoted", text'
    assert found["c-31"]["TotalCharges"] is None
    with pytest.raises(FileNotFoundError, match="New data not found"):
        read_csv(spark, str(tmp_path / "nowhere.csv"), "New data")


def test_csv_rows_of_other_lengths(spark, tmp_path):
    def lines(name, *text):
        (tmp_path / name).write_text("\n".join(text) + "\n")
        return str(tmp_path / name)

    short = read_csv(spark, lines("short.csv", "a,b", "1,2", "3"))
    assert [tuple(r) for r in short.collect()] == [("1", "2"), ("3", None)]
    df = read_csv(spark, lines("long.csv", "a,b", "1,2", "3,4,5"))
    for selected in (df, df.select("a"), df.select("b")):
        with pytest.raises(Exception, match="more cells than its header"):
            selected.collect()
    assert read_csv(spark, lines("comma.csv", "a,b", "1,2,")).collect()[0]["b"] == "2"


def test_csv_line_breaks(spark, tmp_path):
    (tmp_path / "t.csv").write_text('a,b\n1,"x\ny"\n2,"say ""hi"""\n')
    with pytest.raises(ValueError, match="multiline=True"):
        read_csv(spark, str(tmp_path / "t.csv"))
    whole = read_csv(spark, str(tmp_path / "t.csv"), multiline=True)
    # Rows are a table's: they come in no order.
    assert sorted(tuple(r) for r in whole.collect()) == [("1", "x\ny"), ("2", 'say "hi"')]
