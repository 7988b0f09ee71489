"""A dashboard over a stream whose rows may come at any time, and running counters.

Rows are counted per slide and micro-batch, in folders that a repeated batch overwrites; counts add up in any order. The windows that
a batch touches, however old, are computed again from the slides, a day of windows at a time, and replace what was there. Rows behind
the watermark are also kept aside, so that one can see what came late. Nothing is held in memory between batches, and
nothing is dropped.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from churnflow.operators.monitoring import MEASURES, per_slide, results_label, sliding, with_dashboard
from churnflow.operators.scoring import FAILED, INVALID, OK
from churnflow.streaming.monitoring import ALL_THERE_IS

_MEASURE_TYPES = ", ".join(f"{name} {'double' if name == 'latency_sum' else 'bigint'}" for name in MEASURES)
_SLIDES = f"slide_start timestamp, {_MEASURE_TYPES}, run_id string, batch_id bigint, day date"
_MARKS = "newest timestamp, rows bigint, late bigint, run_id string, batch_id bigint"


def run_of(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint gives to a streaming query: it stays when the query is started again."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def _overwrite(df: DataFrame, path: str, *by: str) -> None:
    """Replaces the partitions that the rows belong to, and no others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def repair_to_table(
    log: DataFrame, folder: str, checkpoint: str, seconds: int = 300, slide: int = 60, watermark: int = 600,
    trigger: Mapping | None = None,
) -> StreamingQuery:
    """Keeps the dashboard of all rows so far in ``windows`` below the folder, a partition per day.

    Beside it: ``slides`` (counts per slide and batch), ``marks`` (newest time, rows and late rows of each batch) and ``late`` (the rows
    that were more than ``watermark`` seconds behind the newest row of earlier batches). Windows without rows are not in it.
    """
    if seconds % slide:
        raise ValueError("the window length has to be a multiple of the slide")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        run = run_of(spark, checkpoint)
        mine = {"run_id": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint")}
        rows = batch.withColumn("ts", F.col("ts").cast("timestamp")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            newest = None
            if batch_id:
                earlier = _read(spark, f"{folder}/marks", _MARKS).where((F.col("run_id") == run) & (F.col("batch_id") < batch_id))
                newest = earlier.agg(F.max("newest")).first()[0]
            behind = F.lit(False) if newest is None else F.col("ts") < F.lit(newest) - F.make_dt_interval(secs=F.lit(watermark))
            rows.where(behind).withColumns(mine).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                "run_id", "batch_id").parquet(f"{folder}/late")
            slides = per_slide(rows, slide).withColumn("day", F.to_date("slide_start")).withColumns(mine)
            _overwrite(slides, f"{folder}/slides", "run_id", "batch_id", "day")
            _repair(spark, folder, run, batch_id, seconds, slide)
            marks = rows.agg(F.max("ts").alias("newest"), F.count(F.lit(1)).alias("rows"), F.count_if(behind).alias("late"))
            _overwrite(marks.withColumns(mine).coalesce(1), f"{folder}/marks", "run_id", "batch_id")
        finally:
            rows.unpersist()

    return (
        log.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**(trigger or ALL_THERE_IS)).start()
    )


def _repair(spark: SparkSession, folder: str, run: str, batch_id: int, seconds: int, slide: int) -> None:
    """Computes all windows of the days anew in which the batch changed any."""
    slides = _read(spark, f"{folder}/slides", _SLIDES)
    reach = F.make_dt_interval(secs=F.lit(seconds - slide))
    changed = slides.where((F.col("run_id") == run) & (F.col("batch_id") == batch_id)).select(
        F.explode(F.array(F.to_date(F.col("slide_start") - reach), F.to_date("slide_start"))).alias("day")).distinct()
    days = changed.persist()
    try:
        # Windows that begin late in a day reach into the next ones.
        needed = days.select(F.explode(F.sequence("day", F.date_add("day", -(-(seconds - slide) // 86400)))).alias("day")).distinct()
        windows = sliding(slides.join(needed, "day", "left_semi"), seconds, slide).withColumn("day", F.to_date("window_start"))
        found = windows.join(days, "day", "left_semi")
        _overwrite(with_dashboard(found, seconds).withColumn("day", F.to_date("window_start")), f"{folder}/windows", "day")
    finally:
        days.unpersist()


def repaired_windows(spark: SparkSession, folder: str) -> DataFrame:
    """The dashboard's windows as they stand."""
    return spark.read.parquet(f"{folder}/windows").drop("day")


def late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """(run_id, batch_id, newest, rows, late): what each batch brought, and how much of it came late."""
    return _read(spark, f"{folder}/marks", _MARKS)


# Running counters

_COUNTERS = "status int, churn string, requests bigint, run_id string, batch_id bigint"


def count_to_table(log: DataFrame, folder: str, checkpoint: str, trigger: Mapping | None = None) -> StreamingQuery:
    """Keeps running counts by status and predicted label, the keyed state of the query, in a table.

    A batch writes the counters it changed, in a folder of its own that it overwrites if it is repeated. A query that is
    started again with its checkpoint counts on.
    """
    totals = log.groupBy(F.col("status").cast("int").alias("status"), results_label().alias("churn")).agg(F.count(F.lit(1)).alias("requests"))

    def write(batch: DataFrame, batch_id: int) -> None:
        run = run_of(batch.sparkSession, checkpoint)
        _overwrite(batch.withColumns({"run_id": F.lit(run), "batch_id": F.lit(batch_id).cast("bigint")}).coalesce(1), folder, "run_id", "batch_id")

    return (
        totals.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ALL_THERE_IS)).start()
    )


def counters(spark: SparkSession, folder: str) -> DataFrame:
    """(status, churn, requests): each counter as its newest batch left it; those of several queries add up."""
    newest = _read(spark, folder, _COUNTERS).groupBy("run_id", "status", "churn").agg(F.max_by("requests", "batch_id").alias("requests"))
    return newest.groupBy("status", "churn").agg(F.sum("requests").alias("requests"))


def counted_totals(spark: SparkSession, folder: str) -> DataFrame:
    """The counters as the totals that ``log_totals`` computes from the whole log."""
    n, status, churn = F.col("requests"), F.col("status"), F.col("churn")
    of = {
        "requests": F.lit(True), "successful": status == OK, "failed": status.isin(INVALID, FAILED), "churn": churn == "Yes",
        "non_churn": churn == "No", "results": churn.isNotNull(),
    }
    return counters(spark, folder).agg(*[F.coalesce(F.sum(F.when(c, n)), F.lit(0)).alias(name) for name, c in of.items()])
