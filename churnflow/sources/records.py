"""One-row records (metrics, decisions, best parameters) and the append-only run ledger."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from churnflow.sources.tables import read_table

LEDGER_SCHEMA = "run_name string, run_type string, kind string, key string, value string"


def write_record(df: DataFrame, path: str) -> str:
    """Writes a one-row frame as a JSON record, replacing the earlier one."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return path


def read_record(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def entry_rows(
    run_name: str,
    run_type: str,
    params: Mapping[str, object] | None = None,
    metrics: Mapping[str, float] | None = None,
    tags: Mapping[str, object] | None = None,
) -> list[tuple]:
    """The ledger rows of one run: one row per parameter, metric and tag."""
    kinds = {"param": params or {}, "metric": metrics or {}, "tag": tags or {}}
    return [
        (run_name, run_type, kind, key, None if value is None else str(value))
        for kind, values in kinds.items()
        for key, value in values.items()
    ]


def run_entries(spark: SparkSession, run_name: str, run_type: str, **values: Mapping[str, object] | None) -> DataFrame:
    """The same as a frame."""
    return spark.createDataFrame(entry_rows(run_name, run_type, **values), LEDGER_SCHEMA)


def append_run(entries: DataFrame, path: str) -> str:
    entries.coalesce(1).write.mode("append").parquet(path)
    return path


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, "Run ledger")
