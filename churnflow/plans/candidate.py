"""Training a candidate and recording how it was found; shared by both flows."""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from churnflow.functions.cells import cell
from churnflow.operators import metrics as metric_ops
from churnflow.operators.promotion import EVALUATION_SCHEMA, Registry, evaluation_entries
from churnflow.operators.training import NOT_APPLIED, Candidate, Range, SearchProfile, TrialStore, scored, train_candidate
from churnflow.plans.layout import Layout
from churnflow.sources import records
from churnflow.sources.models import load_model, save_model
from churnflow.sources.tables import read_processed, read_table, write_table
from churnflow.spec import DatasetSpec


def build_candidate(
    spark: SparkSession,
    layout: Layout,
    prepared: DataFrame,
    feature_names: list[str],
    spec: DatasetSpec,
    space: Mapping[str, Range],
    profile: SearchProfile,
    run: str,
    row_counts: Mapping[str, int] | None = None,
    search: str | None = None,
) -> tuple[str, Candidate]:
    """Searches, saves the final model under a name of its own, and writes records and ledger.

    ``search`` names the search in the table of trials. A flow that is started again under the same name goes on after the
    trials that are finished; without a name, every call is a search of its own.
    """
    store = TrialStore(spark, layout.record("trials"), search or f"{run}-{uuid.uuid4().hex[:12]}")
    candidate = train_candidate(prepared, feature_names, spec, space, profile, store)
    path = save_model(candidate.model, layout.model(f"candidate-{uuid.uuid4().hex[:12]}"))
    best = spark.createDataFrame([{k: float(v) for k, v in candidate.best.params.items()}])
    records.write_record(best, layout.record("best_params"))
    counts = dict(row_counts or {})
    summary = spark.createDataFrame(
        [(candidate.best.number, json.dumps(candidate.best.params), dict(candidate.metrics), counts)],
        "best_trial int, best_params string, metrics map<string, double>, row_counts map<string, bigint>",
    )
    records.write_record(summary, layout.record(f"{run}_summary"))
    _record_runs(spark, layout, candidate, run, profile, counts, path)
    return path, candidate


def _record_runs(spark, layout, candidate, run, profile, counts, path) -> None:
    entries = records.entry_rows(
        f"{run}_candidate_model",
        f"{run}_candidate",
        params={
            "n_trials": profile.trials, "optimization_metric": "f1_score", "random_state": profile.seed,
            "best_trial": candidate.best.number, "model_path": path,
            "training_rows": candidate.train_rows, "validation_rows": candidate.valid_rows,
            **counts, **{f"best_{k}": v for k, v in candidate.best.params.items()},
        },
        metrics={f"candidate_{k}": v for k, v in candidate.metrics.items()}
        | {"best_f1_score": candidate.best.objective},
        tags={"model_type": "GBTClassifier", "model_status": "candidate",
              "class_imbalance_handling": "scale_pos_weight"},
    )
    entries += records.entry_rows(
        f"{run}_search", f"{run}_search",
        params={
            "n_trials": profile.trials, "optimization_metric": "f1_score", "random_state": profile.seed,
            "best_trial": candidate.best.number, **{f"best_{k}": v for k, v in candidate.best.params.items()},
        },
        metrics={"best_f1_score": candidate.best.objective},
        tags={"sampler": "random", "not_applied": ",".join(NOT_APPLIED)},
    )
    for trial in candidate.trials:
        entries += records.entry_rows(
            f"{run}_trial_{trial.number:02d}", f"{run}_trial",
            params=trial.params, metrics=trial.metrics,
            tags={"trial_number": trial.number, "optimization_metric": "f1_score",
                  "not_applied": ",".join(NOT_APPLIED)},
        )
    # All rows of a run in one write.
    records.append_run(spark.createDataFrame(entries, records.LEDGER_SCHEMA), layout.ledger)


def evaluate_candidate(spark: SparkSession, layout: Layout, spec: DatasetSpec, candidate_path: str) -> DataFrame:
    """Scores the held-out part with the candidate and production, compares, and records it.

    Both scores of a row are written to a table first, so the metrics read three columns instead
    of running two models again.
    """
    held_out = read_processed(spark, layout.processed("held_out"), spec.target, "Held-out data")
    candidate = load_model(spark, candidate_path, "Candidate model")
    production_path = Registry(spark, layout.registry).production_path()
    production = load_model(spark, production_path, "Production model")
    both = scored(production, scored(candidate, held_out, "candidate_score"), "production_score")
    scores_path = write_table(
        both.select(cell(spec.target).alias("label"), "candidate_score", "production_score"),
        layout.processed(f"held_out_scores-{uuid.uuid4().hex[:12]}"),
    )
    result = metric_ops.evaluation_record(
        metric_ops.classification_metrics(
            read_table(spark, scores_path), "label",
            {"candidate": "candidate_score", "production": "production_score"},
        )
    )
    path = records.write_record(result, layout.record("candidate_evaluation"))
    saved = records.read_record(spark, path, EVALUATION_SCHEMA)
    records.append_run(evaluation_entries(saved), layout.ledger)
    return saved
