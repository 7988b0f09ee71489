import pytest
from pyspark.sql import functions as F

from churnflow.operators import scoring
from churnflow.operators.features import fit_state
from churnflow.sources.tables import write_table
from churnflow.streaming.scoring import score_stream
from tests.rows import FIRST, SECOND, SPEC, changed, frame


class HalfTenure:
    """A stand-in for a fitted model: the probability depends on one prepared column."""

    def transform(self, df):
        from pyspark.ml.functions import array_to_vector

        p = F.when(F.col("numerical__tenure") > 0, 0.87654).otherwise(0.5)
        return df.withColumn("probability", array_to_vector(F.array(1 - p, p)))


def errors(df):
    return [tuple(e) for e in scoring.with_request_errors(df, SPEC).orderBy("tenure").first()["errors"]]


@pytest.mark.parametrize(
    "column, value, kind, rule",
    [
        ("gender", None, None, "missing"),
        ("gender", " Male", None, "value"),
        ("Contract", "one year", None, "value"),
        ("SeniorCitizen", 2, None, "value"),
        ("SeniorCitizen", None, None, "missing"),
        ("tenure", -1, None, "minimum"),
        ("tenure", 0.5, "double", "type"),
        ("MonthlyCharges", -0.01, None, "minimum"),
        ("MonthlyCharges", float("nan"), None, "minimum"),
        ("TotalCharges", " ", None, "type"),
        ("TotalCharges", "abc", None, "type"),
        ("TotalCharges", "nan", None, "minimum"),
        ("TotalCharges", "-1", None, "minimum"),
        ("customerID", None, None, "missing"),
    ],
)
def test_broken_rules(spark, column, value, kind, rule):
    rows = FIRST | {column: value}, SECOND
    if kind == "double":
        rows = tuple(r | {column: float(r[column])} for r in rows)
    df = frame(spark, *rows, **({column: kind} if kind else {}))
    assert errors(df) == [(column, rule)]


def test_valid_requests(spark):
    assert errors(frame(spark)) == []
    assert errors(changed(spark, "TotalCharges", None)) == []
    assert errors(frame(spark).drop("TotalCharges", "Churn")) == []
    assert errors(frame(spark).drop("gender")) == [("gender", "missing")]


def test_quarantine_keeps_every_row_once(spark):
    valid, refused = scoring.quarantine(changed(spark, "gender", "x"), SPEC)
    assert [r["customerID"] for r in valid.collect()] == ["c-31"]
    assert [r["customerID"] for r in refused.collect()] == ["c-07"]
    assert refused.first()["errors"][0]["field"] == "gender"


def test_status_and_response(spark):
    state = fit_state(frame(spark), SPEC)
    rows = (
        FIRST, SECOND,
        FIRST | {"customerID": "c-52", "gender": "x"},
        FIRST | {"customerID": "c-64", "TotalCharges": "inf"},
        FIRST | {"customerID": "c-88", "TotalCharges": None},
    )
    scored = scoring.score_requests(frame(spark, *rows), state, SPEC, HalfTenure())
    found = {r["customerID"]: (r["status"], r["probability"]) for r in scored.collect()}
    assert found == {
        "c-07": (200, 0.5), "c-31": (200, 0.87654), "c-52": (422, None), "c-64": (500, None), "c-88": (200, 0.5),
    }
    answers = {r["customerID"]: tuple(r)[1:] for r in scoring.responses(scored, SPEC).collect()}
    assert answers == {"c-07": (0, "No", 0.5), "c-31": (1, "Yes", 0.8765), "c-88": (0, "No", 0.5)}
    log = scoring.prediction_log(scored, SPEC, F.col("customerID"), F.current_timestamp(), F.lit(0.25))
    assert {r["request_id"]: (r["latency_seconds"], r["label"], r["probability"]) for r in log.collect()} == {
        "c-07": (0.25, "No", 0.5), "c-31": (0.25, "Yes", 0.87654), "c-52": (None, None, None),
        "c-64": (0.25, None, None), "c-88": (0.25, "No", 0.5),
    }


def test_requests_without_optional_column(spark):
    state = fit_state(frame(spark), SPEC)
    scored = scoring.score_requests(frame(spark).drop("TotalCharges", "Churn"), state, SPEC, HalfTenure())
    assert [r["status"] for r in scored.collect()] == [200, 200]
    assert "TotalCharges" not in scored.columns


def test_stream_gives_the_same_rows_as_a_batch(spark, tmp_path):
    state = fit_state(frame(spark), SPEC)
    rows = frame(spark, FIRST, SECOND, FIRST | {"customerID": "c-52", "gender": "x"})
    source = write_table(rows.repartition(3, "customerID"), str(tmp_path / "requests"))
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    out = str(tmp_path / "out")
    start = lambda progress: score_stream(stream, state, SPEC, HalfTenure(), out, str(tmp_path / progress), F.expr("uuid()"))
    start("progress").awaitTermination()
    batch = scoring.score_requests(rows, state, SPEC, HalfTenure())
    expected = {tuple(r) for r in scoring.responses(batch, SPEC).collect()}
    got = spark.read.parquet(f"{out}/responses").drop("batch_id", "run_id")
    assert {tuple(r) for r in got.collect()} == expected and got.count() == 2
    assert [r["customerID"] for r in spark.read.parquet(f"{out}/rejected").collect()] == ["c-52"]
    log = spark.read.parquet(f"{out}/log")
    assert {r["customerID"]: r["status"] for r in log.collect()} == {"c-07": 200, "c-31": 200, "c-52": 422}
    assert log.where("latency_seconds is null").count() == 1
    # With its checkpoint the query goes on where it stopped; with a new one it scores all again, beside the old rows.
    start("progress").awaitTermination()
    assert spark.read.parquet(f"{out}/log").count() == 3
    start("other").awaitTermination()
    again = spark.read.parquet(f"{out}/log")
    assert again.count() == 6 and again.select("request_id").distinct().count() == 6
