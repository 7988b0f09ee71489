from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from churnflow.operators import monitoring
from churnflow.sources.tables import append_table
from churnflow.sources.views import view
from churnflow.streaming.monitoring import run_to_table, start_to_table, stream_dashboard

START = datetime(2024, 1, 1)
SCHEMA = "request_id bigint, ts timestamp, status int, latency_seconds double, probability double"


def log(spark, *rows):
    """Rows as (seconds after the start, status, latency, probability)."""
    return spark.createDataFrame(
        [(i, START + timedelta(seconds=r[0]), *r[1:]) for i, r in enumerate(rows)], SCHEMA
    )


def quantile(spark, values, bounds, q=0.95):
    counts = [sum(v <= b for v in values) for b in bounds]
    column = monitoring.histogram_quantile(q, bounds, [F.lit(c) for c in counts], F.lit(len(values)))
    return spark.range(1).select(column.alias("q")).first()["q"]


def test_quantile_edges(spark):
    bounds = (0.0, 0.5, 1.0)
    assert quantile(spark, [], bounds) is None
    assert quantile(spark, [5.0, 6.0], bounds) == 1.0
    assert quantile(spark, [0.0, 0.0], bounds) == 0.0
    assert quantile(spark, [0.2, 0.3], bounds) == pytest.approx(0.475)
    assert quantile(spark, [0.002], (0.005, 0.01)) == pytest.approx(0.00475)


def test_histogram_is_cumulative(spark):
    df = log(spark, (0, 200, 0.005, 0.0), (1, 200, 0.02, 1.0), (2, 500, 99.0, None), (3, 422, None, None))
    found = {r["le"]: r["cumulative"] for r in monitoring.histogram(df, "latency_seconds", monitoring.LATENCY_BOUNDS).collect()}
    assert found["0.005"] == 1 and found["0.025"] == 2 and found["10.0"] == 2 and found["+Inf"] == 3
    values = [found[str(b)] for b in monitoring.LATENCY_BOUNDS]
    assert values == sorted(values)
    merged = monitoring.merge_histograms(
        monitoring.histogram(df, "latency_seconds", monitoring.LATENCY_BOUNDS, "status")
    )
    assert {r["le"]: r["cumulative"] for r in merged.collect()} == found


def test_counters(spark):
    df = log(spark, (0, 200, 0.1, 0.6), (1, 200, 0.1, 0.5), (2, 500, 0.1, None), (3, 422, None, None), (4, 404, None, None))
    assert tuple(monitoring.log_totals(df).first()) == (5, 2, 2, 1, 1, 2)
    assert {r["churn"]: r["predictions"] for r in monitoring.results_by_label(df).collect()} == {
        "Yes": 1, "No": 1, "total": 2,
    }


def test_windows_and_idle_grid(spark):
    df = log(spark, (0, 200, 0.1, 0.6), (61, 500, 0.3, None), (1200, 422, None, None))
    rows = {
        int((r["window_start"] - START).total_seconds()) // 60: r
        for r in monitoring.dashboard(df).collect()
    }
    assert sorted(rows) == list(range(-4, 21))
    assert rows[-4]["request_rate"] == pytest.approx(1 / 300)
    assert rows[-3]["request_rate"] == pytest.approx(2 / 300)
    assert rows[-3]["error_rate"] == pytest.approx(50.0, abs=1e-4)
    assert rows[-3]["avg_latency"] == pytest.approx(0.2, abs=1e-6)
    assert rows[1]["request_rate"] == pytest.approx(1 / 300)
    idle = rows[5]
    assert (idle["request_rate"], idle["error_rate"], idle["avg_latency"], idle["p95_latency"]) == (0, 0, 0, None)
    assert rows[20]["p95_latency"] is None and rows[20]["error_rate"] > 99
    assert monitoring.dashboard(df, grid=False).count() == 11
    with pytest.raises(ValueError, match="multiple of the slide"):
        monitoring.dashboard(df, 300, 70)


def test_empty_log_has_no_windows(spark):
    assert monitoring.dashboard(spark.createDataFrame([], SCHEMA)).count() == 0


def test_last_values_skip_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, 5.0, 7.0), (3, None, None)], "t int, a double, b double")
    assert {r["series"]: r["value"] for r in monitoring.last_values(df, "t", ["a", "b"]).collect()} == {"a": 5.0, "b": 7.0}


def test_stream_equals_batch_on_closed_windows(spark, sf_dir, tmp_path):
    whole = view(spark, sf_dir, "prediction_log").withColumn("ts", F.col("ts").cast("timestamp")).where("ts < '2024-01-03'")
    source = str(tmp_path / "log")
    for day in (1, 2):
        append_table(whole.where(F.dayofmonth("ts") == day).coalesce(1), source)
    stream = spark.readStream.schema(whole.schema).option("maxFilesPerTrigger", 1).parquet(source)
    path = run_to_table(stream_dashboard(stream), str(tmp_path / "out"), str(tmp_path / "progress"))
    closed = F.col("window_end") <= F.lit("2024-01-02 23:00:00").cast("timestamp")
    got = spark.read.parquet(path).where(closed)
    expected = monitoring.dashboard(whole, grid=False).where(closed)
    digits = [F.round(c, 9).alias(c) if c not in ("window_start", "window_end") else F.col(c) for c in got.columns]
    got, expected = got.select(digits), expected.select(digits)
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected).isEmpty() and expected.exceptAll(got).isEmpty()


def test_stream_drops_repeats_and_late_rows(spark, tmp_path):
    def rows(*entries):
        return spark.createDataFrame(
            [(i, START + timedelta(minutes=m), 200, 0.1, 0.5) for i, m in entries], SCHEMA
        ).coalesce(1)

    source = str(tmp_path / "log")
    # Chained aggregations judge lateness by the watermark of the batch before the last.
    batches = [rows((1, 0), (1, 0), (2, 1), (3, 60)), rows((5, 61)), rows((4, 0)), rows((6, 300))]
    for batch in batches:
        append_table(batch, source)
    stream = spark.readStream.schema(batches[0].schema).option("maxFilesPerTrigger", 1).parquet(source)
    path = run_to_table(stream_dashboard(stream, distinct=True), str(tmp_path / "out"), str(tmp_path / "progress"))
    rates = {r["window_start"]: r["request_rate"] * 300 for r in spark.read.parquet(path).collect()}
    # The repeated first request counts once, and request 4 arrives an hour late.
    assert rates[START] == pytest.approx(2.0)
    assert rates[START + timedelta(minutes=60)] == pytest.approx(2.0)
    # Unless asked, nothing is taken for a repeat.
    path = run_to_table(stream_dashboard(stream), str(tmp_path / "all"), str(tmp_path / "progress_all"))
    rates = {r["window_start"]: r["request_rate"] * 300 for r in spark.read.parquet(path).collect()}
    assert rates[START] == pytest.approx(3.0)


def test_a_stream_can_keep_running(spark, tmp_path):
    source = str(tmp_path / "log")
    append_table(log(spark, (0, 200, 0.1, 0.6)), source)
    stream = spark.readStream.schema(SCHEMA).parquet(source)
    query = start_to_table(stream_dashboard(stream), str(tmp_path / "out"), str(tmp_path / "p"), {"processingTime": "1 second"})
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()


def test_the_log_is_read_once(spark, tmp_path):
    append_table(log(spark, (0, 200, 0.1, 0.6), (4000, 200, 0.1, 0.6)), str(tmp_path / "log"))
    windows = monitoring.window_measures(spark.read.parquet(str(tmp_path / "log")))
    plan = windows._jdf.queryExecution().optimizedPlan().toString()
    assert f"{tmp_path}" not in plan and "Range (" in plan and windows.count() == 71
