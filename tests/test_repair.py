"""Streams whose rows come late or again, and running counters."""

import random

import pytest
from pyspark.sql import functions as F

from churnflow.operators import monitoring
from churnflow.sources.tables import append_table
from churnflow.streaming import repair

SCHEMA = "request_id bigint, ts timestamp, customerID string, status int, latency_seconds double, probability double"


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    out = []
    for i in range(900):
        at = rng.choice([rng.randint(0, 3 * 86400), rng.randint(86_000, 87_000)])
        status = rng.choice([200, 200, 200, 422, 500])
        out.append((i, at, str(i % 50), status, None if status == 422 else rng.random() * 3, rng.random() if status == 200 else None))
    frame = spark.createDataFrame(out, SCHEMA.replace("ts timestamp", "at bigint"))
    return frame.withColumn("ts", F.timestamp_seconds(F.col("at") + 1_700_000_000)).select(*[c.split()[0] for c in SCHEMA.split(", ")]).cache()


def stream(spark, source):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)


def values(df):
    return sorted((r.window_start, *(round(v, 9) if v is not None else None for v in r[2:])) for r in df.collect())


@pytest.mark.parametrize("seconds, slide", [(300, 60), (3600, 3600), (7200, 1800)])
def test_rows_in_any_order_end_in_the_batch_dashboard(spark, tmp_path, rows, seconds, slide):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(3):
        append_table(rows.where(F.pmod(F.hash("request_id"), F.lit(3)) == part).coalesce(1), source)
    repair.repair_to_table(stream(spark, source), out, str(tmp_path / "cp"), seconds, slide).awaitTermination()
    want = monitoring.dashboard(rows, seconds, slide, grid=False)
    assert values(repair.repaired_windows(spark, out)) == values(want)
    marks = repair.late_rows(spark, out).collect()
    assert sum(r["rows"] for r in marks) == 900 and len(marks) == 3
    assert spark.read.parquet(f"{out}/late").count() == sum(r["late"] for r in marks) > 300


def test_restart_and_repeated_batches(spark, tmp_path, rows):
    """A stream that stops, goes on with its checkpoint, and one that starts with a new one over other rows."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(2):
        append_table(rows.where(F.col("request_id") % 3 == part).coalesce(1), source)
        repair.repair_to_table(stream(spark, source), out, str(tmp_path / "cp")).awaitTermination()
    other = str(tmp_path / "other")
    append_table(rows.where("request_id % 3 = 2").coalesce(1), other)
    repair.repair_to_table(stream(spark, other), out, str(tmp_path / "cp2")).awaitTermination()
    assert values(repair.repaired_windows(spark, out)) == values(monitoring.dashboard(rows, grid=False))
    # A batch that was written but not committed is done again.
    (newest,) = [p for p in (tmp_path / "cp" / "commits").iterdir() if p.name == "1"]
    newest.unlink()
    crc = tmp_path / "cp" / "commits" / ".1.crc"
    if crc.exists():
        crc.unlink()
    repair.repair_to_table(stream(spark, source), out, str(tmp_path / "cp")).awaitTermination()
    assert values(repair.repaired_windows(spark, out)) == values(monitoring.dashboard(rows, grid=False))


def test_counters_go_on(spark, tmp_path, rows):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    for part in range(3):
        append_table(rows.where(F.col("request_id") % 3 == part).coalesce(1), source)
        repair.count_to_table(stream(spark, source), out, str(tmp_path / "cp")).awaitTermination()
        so_far = rows.where(F.col("request_id") % 3 <= part)
        assert repair.counted_totals(spark, out).first() == monitoring.log_totals(so_far).first()
    (tmp_path / "cp" / "commits" / "2").unlink()
    (tmp_path / "cp" / "commits" / ".2.crc").unlink(missing_ok=True)
    repair.count_to_table(stream(spark, source), out, str(tmp_path / "cp")).awaitTermination()
    assert repair.counted_totals(spark, out).first() == monitoring.log_totals(rows).first()
    by_label = {r["churn"]: r["predictions"] for r in monitoring.results_by_label(rows).collect()}
    found = repair.counters(spark, out).where("churn IS NOT NULL").groupBy("churn").agg(F.sum("requests").alias("n")).collect()
    assert {r["churn"]: r["n"] for r in found} == {k: v for k, v in by_label.items() if k != "total"}


def test_windows_are_multiples_of_slides(spark, tmp_path):
    with pytest.raises(ValueError, match="multiple"):
        repair.repair_to_table(None, str(tmp_path), str(tmp_path), 100, 60)
