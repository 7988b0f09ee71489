"""The recurring run: new rows in, a promoted or rejected candidate out."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from churnflow.operators.assembly import combine, row_accounting
from churnflow.operators.features import require_prepared, transform
from churnflow.operators.promotion import Registry, compare_and_promote
from churnflow.operators.quality import validate
from churnflow.operators.training import RETRAIN_SPACE, SearchProfile
from churnflow.plans.candidate import build_candidate, evaluate_candidate
from churnflow.plans.layout import Layout
from churnflow.sources.models import load_state
from churnflow.sources.tables import read_csv, read_processed, read_table, require_path, require_rows, write_table
from churnflow.spec import DatasetSpec


def ingest(spark: SparkSession, path: str, fmt: str | None = None) -> DataFrame:
    """The new rows, from a Parquet table or delimited text files: ``fmt`` is parquet, csv, or, by the name's ending, None."""
    kind = fmt or ("csv" if path.lower().endswith((".csv", ".csv.gz")) else "parquet")
    if kind not in _READERS:
        raise ValueError(f"unknown format: {kind}")
    return require_rows(_READERS[kind](spark, path, "New data"), "New data")


_READERS = {"csv": read_csv, "parquet": read_table}


def transform_new(spark: SparkSession, layout: Layout, rows: DataFrame, spec: DatasetSpec, search: str | None = None) -> str:
    """Prepares validated rows with the saved state, in a folder of this run, and checks what came out."""
    state = load_state(spark, layout.state, spec)
    path = write_table(transform(rows, state, spec), layout.processed(f"new-{search or uuid.uuid4().hex[:12]}"))
    require_prepared(read_table(spark, path), state, spec)
    return path


def retrain(
    spark: SparkSession, layout: Layout, new_path: str, spec: DatasetSpec, profile: SearchProfile, search: str | None = None
) -> str:
    """Trains a candidate on initial and new prepared rows; production is not touched."""
    state = load_state(spark, layout.state, spec)
    combined = combine({
        "initial": read_processed(spark, layout.processed("initial"), spec.target, "Initial processed data"),
        "new": read_processed(spark, new_path, spec.target, "New processed data"),
    })
    counts = {f"{r['source']}_rows": r["rows"] for r in row_accounting(combined).collect()}
    path, _ = build_candidate(
        spark, layout, combined.drop("source"), state.feature_names, spec, RETRAIN_SPACE, profile,
        "retraining", counts, search,
    )
    return require_path(spark, path, "Candidate model")


def run_retraining(
    spark: SparkSession, new_data: str, root: str, spec: DatasetSpec, profile: SearchProfile | None = None,
    fmt: str | None = None, search: str | None = None,
) -> str:
    """Ingest, validate, transform, retrain, evaluate, decide; each step gates the next.

    A run that was lost is started again with the same ``search``: trials that it finished are not fitted again.
    """
    layout = Layout(root)
    rows = ingest(spark, new_data, fmt)
    validate(rows, spec)
    new_path = transform_new(spark, layout, rows, spec, search)
    candidate_path = retrain(spark, layout, new_path, spec, profile or SearchProfile.full(), search)
    evaluation = evaluate_candidate(spark, layout, spec, candidate_path)
    return compare_and_promote(
        evaluation, candidate_path, Registry(spark, layout.registry), layout.record("promotion"), layout.ledger
    )
