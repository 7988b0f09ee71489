"""Models and fitted preparation state at rest."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from churnflow.operators.features import PrepState
from churnflow.operators.forest import save_nodes
from churnflow.sources.tables import read_table, require_path, write_table
from churnflow.spec import DatasetSpec


def save_model(model: PipelineModel, path: str) -> str:
    """Saves the model and, beside it, its nodes as a table."""
    model.write().overwrite().save(path)
    save_nodes(SparkSession.active(), path)
    return path


def load_model(spark: SparkSession, path: str, what: str = "Model") -> PipelineModel:
    return PipelineModel.load(require_path(spark, path, what))


def save_state(spark: SparkSession, state: PrepState, path: str) -> str:
    return write_table(state.to_table(spark).coalesce(1), path)


def load_state(spark: SparkSession, path: str, spec: DatasetSpec) -> PrepState:
    return PrepState.from_table(read_table(spark, path, "Preparation state"), spec)
