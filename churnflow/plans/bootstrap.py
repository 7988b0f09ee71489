"""The first run: split the raw table, prepare all parts, tune, and install a first model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnflow.operators.features import fit_state, require_prepared, transform
from churnflow.operators.promotion import Registry
from churnflow.operators.quality import validate
from churnflow.operators.split import three_way_split
from churnflow.operators.training import TUNE_SPACE, SearchProfile
from churnflow.plans.candidate import build_candidate
from churnflow.plans.layout import Layout
from churnflow.sources.models import save_state
from churnflow.sources.tables import read_processed, read_table, require_rows, stored, write_table
from churnflow.spec import DatasetSpec

PARTS = ("initial", "new", "held_out")


def run_bootstrap(
    spark: SparkSession, raw: DataFrame, root: str, spec: DatasetSpec,
    profile: SearchProfile | None = None, install: bool = True, search: str | None = None,
) -> str:
    """Split, validate, fit on the initial part, prepare all parts, tune; returns the model path.

    A run that was lost is started again with the same ``search``: trials that it finished are not fitted again. With ``install`` the first candidate becomes production, which nothing else would do.
    """
    layout = Layout(root)
    # The split reads its input several times; the raw rows are parsed once, and not to see whether there are any either.
    rows = require_rows(stored(raw, "raw"), "Raw data")
    write_table(three_way_split(rows, spec.target, spec.id_column),
                layout.splits, ["split"])
    initial = read_table(spark, layout.data("initial"), "Initial data")
    validate(initial, spec)
    state = fit_state(initial, spec)
    save_state(spark, state, layout.state)
    for part in PARTS:
        rows = transform(read_table(spark, layout.data(part), f"{part} data"), state, spec)
        write_table(rows, layout.processed(part))
    prepared = read_processed(spark, layout.processed("initial"), spec.target)
    require_prepared(prepared, state, spec, len(state.feature_names))
    path, _ = build_candidate(
        spark, layout, prepared, state.feature_names, spec, TUNE_SPACE, profile or SearchProfile.full(),
        "tuning", {"initial_rows": prepared.count()}, search,
    )
    if install:
        Registry(spark, layout.registry).promote(path)
    return path


def trials_of(spark: SparkSession, root: str, run: str) -> DataFrame:
    """The trials of all searches of a kind, tuning or retraining, or of one search."""
    trials = read_table(spark, Layout(root).record("trials"))
    return trials.where((F.col("run") == run) | F.col("run").startswith(f"{run}-"))
