"""Promotion: the decision, the append-only model registry, and the records of both."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnflow.functions.cells import literal, stacked
from churnflow.operators.metrics import METRICS
from churnflow.sources import records
from churnflow.sources.commits import CommitLog
from churnflow.sources.tables import require_path

REGISTRY_SCHEMA = "version bigint, model_path string, status string, decided_at timestamp"
METRIC_STRUCT = "struct<" + ", ".join(f"{m}: double" for m in METRICS) + ">"
EVALUATION_SCHEMA = (
    f"candidate_metrics {METRIC_STRUCT}, production_metrics {METRIC_STRUCT}, "
    "f1_improvement double, candidate_better boolean"
)


def with_decision(evaluation: DataFrame) -> DataFrame:
    """Adds ``decision``: PROMOTE only if the candidate's F1 is strictly higher, else REJECT."""
    better = F.col("candidate_metrics.f1_score") > F.col("production_metrics.f1_score")
    return evaluation.withColumn("decision", F.when(better, "PROMOTE").otherwise("REJECT"))


def promotion_record(decided: DataFrame) -> DataFrame:
    """Decision, both metric sets, and the difference in F1 (null without production metrics)."""
    return decided.select(
        "decision",
        "candidate_metrics",
        "production_metrics",
        (F.col("candidate_metrics.f1_score") - F.col("production_metrics.f1_score")).alias("f1_improvement"),
    )


def evaluation_frame(
    spark: SparkSession, candidate: Mapping[str, float], production: Mapping[str, float] | None
) -> DataFrame:
    """An evaluation of known metric values as the one-row frame the operators work on."""

    def values(metrics):
        return None if metrics is None else tuple(metrics[m] for m in METRICS)

    schema = f"candidate_metrics {METRIC_STRUCT}, production_metrics {METRIC_STRUCT}"
    return spark.createDataFrame([(values(candidate), values(production))], schema)


@dataclass(frozen=True)
class Registry:
    """Model versions in a log where each number is claimed once; production is the latest promoted version."""

    spark: SparkSession
    path: str

    def entries(self) -> DataFrame:
        try:
            require_path(self.spark, self.path, "Model registry")
        except FileNotFoundError:
            return self.spark.createDataFrame([], REGISTRY_SCHEMA)
        return self.spark.read.schema(REGISTRY_SCHEMA).json(self.path)

    def production_path(self) -> str:
        newest = (
            self.entries()
            .where(F.col("status") == "promoted")
            .agg(F.max(F.struct("version", "model_path")).alias("newest"))
            .first()["newest"]
        )
        if newest is None:
            raise FileNotFoundError(f"Production model not found: {self.path}")
        return newest["model_path"]

    def record(self, model_path: str, status: str) -> int:
        """Appends the next version. Of writers that want the same one, one gets it and the others the next ones."""
        decided_at = datetime.now(timezone.utc).isoformat()
        return CommitLog(self.spark, self.path).append(
            lambda version: {"version": version, "model_path": model_path, "status": status, "decided_at": decided_at})

    def promote(self, model_path: str) -> int:
        return self.record(require_path(self.spark, model_path, "Candidate model"), "promoted")

    def reject(self, model_path: str) -> int:
        return self.record(model_path, "rejected")


def compare_and_promote(
    evaluation: DataFrame, candidate_path: str, registry: Registry, folder: str, ledger: str | None = None
) -> str:
    """Decides, updates the registry and writes the records; production changes only on PROMOTE.

    Below ``folder``: ``promotion_record`` always, ``production_metrics`` only on PROMOTE.
    """
    record = promotion_record(with_decision(evaluation))
    row = record.first()
    if row["candidate_metrics"] is None or row["production_metrics"] is None:
        raise ValueError("the decision needs the metrics of both the candidate and production")
    spark = registry.spark
    candidate, production = row["candidate_metrics"].asDict(), row["production_metrics"].asDict()
    if row["decision"] == "PROMOTE":
        registry.promote(candidate_path)
        production_record = evaluation_frame(spark, candidate, None).select(
            F.lit("production_model").alias("model_name"), F.col("candidate_metrics").alias("metrics")
        )
        records.write_record(production_record, f"{folder}/production_metrics")
    else:
        registry.reject(candidate_path)
    save_promotion_record(spark, candidate, production, row["decision"], f"{folder}/promotion_record")
    if ledger:
        entries = records.run_entries(
            spark,
            "model_promotion_decision",
            "model_promotion",
            params={"promotion_decision": row["decision"]},
            metrics=side_by_side(candidate, production) | {"f1_improvement": row["f1_improvement"]},
            tags={"decision": row["decision"], "comparison_metric": "f1_score"},
        )
        records.append_run(entries, ledger)
    return row["decision"]


def save_promotion_record(
    spark: SparkSession, candidate: Mapping, production: Mapping | None, decision: str, path: str
) -> str:
    """Writes the record of a decision; without production metrics the improvement is null."""
    frame = evaluation_frame(spark, candidate, production).withColumn("decision", F.lit(decision))
    return records.write_record(promotion_record(frame), path)


def side_by_side(candidate: Mapping[str, float], production: Mapping[str, float]) -> dict[str, float]:
    """Metric names of both models, told apart by a prefix."""
    return {f"candidate_{k}": v for k, v in candidate.items()} | {
        f"production_{k}": v for k, v in production.items()
    }


def evaluation_entries(evaluation: DataFrame) -> DataFrame:
    """The run-ledger rows of an evaluation, made on Spark from its one-row frame."""
    values = [
        ("metric", f"{side}_{m}", f"{side}_metrics.{m}") for side in ("candidate", "production") for m in METRICS
    ]
    values += [
        ("metric", "f1_improvement", "f1_improvement"),
        ("param", "candidate_better", "candidate_better"),
        ("tag", "comparison_metric", "'f1_score'"),
    ]
    lines = [
        ("'candidate_held_out_evaluation'", "'held_out_evaluation'", literal(kind), literal(key), f"string({value})")
        for kind, key, value in values
    ]
    return evaluation.select(stacked(("run_name", "run_type", "kind", "key", "value"), lines))
