import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from churnflow.operators import assembly, training
from churnflow.operators.promotion import Registry
from churnflow.plans.bootstrap import run_bootstrap, trials_of
from churnflow.plans.layout import Layout
from churnflow.plans.retraining import ingest, run_retraining
from churnflow.sources.records import read_runs
from churnflow.sources.tables import read_processed, read_table, require_path, write_csv, write_table
from churnflow.sources.views import view
from tests.rows import FIRST, SPEC, frame

SMOKE = training.SearchProfile.smoke()


@pytest.fixture(scope="module")
def project(spark, sf_dir, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("project"))
    path = run_bootstrap(spark, view(spark, sf_dir, "subscribers"), root, SPEC, SMOKE)
    return Layout(root), path


def test_bootstrap_installs_the_first_model(spark, project):
    layout, path = project
    assert Registry(spark, layout.registry).production_path() == path
    sizes = [read_table(spark, layout.processed(p)).count() for p in ("initial", "new", "held_out")]
    assert sizes == [900, 300, 300]
    trials = trials_of(spark, layout.root, "tuning")
    assert trials.count() == SMOKE.trials
    best = training.best_trial(trials).first()
    (summary,) = [
        json.loads(f.read_text()) for f in Path(layout.record("tuning_summary")).glob("part-*")
    ]
    assert summary["best_trial"] == best["trial"]
    assert spark.read.json(layout.record("best_params")).first().asDict() == pytest.approx(best["params"])
    # The final fit repeats the best trial on the same rows.
    assert summary["metrics"]["f1_score"] == pytest.approx(best["objective"])


def test_retraining_decides_and_records(spark, project):
    layout, first = project
    source = layout.data("new")
    decision = run_retraining(spark, source, layout.root, SPEC, SMOKE)
    (record,) = [
        json.loads(f.read_text()) for f in Path(layout.record("promotion/promotion_record")).glob("part-*")
    ]
    assert record["decision"] == decision
    better = record["candidate_metrics"]["f1_score"] > record["production_metrics"]["f1_score"]
    assert decision == ("PROMOTE" if better else "REJECT")
    assert (Registry(spark, layout.registry).production_path() != first) == better
    kinds = {r["run_type"] for r in read_runs(spark, layout.ledger).select("run_type").distinct().collect()}
    assert kinds == {"tuning_trial", "tuning_candidate", "tuning_search", "retraining_search", "retraining_trial", "retraining_candidate",
                     "held_out_evaluation", "model_promotion"}
    summary = spark.read.json(layout.record("retraining_summary")).first()["row_counts"]
    assert (summary["initial_rows"], summary["new_rows"], summary["combined_rows"]) == (900, 300, 1200)


def test_training_takes_repeated_ids(spark):
    rows = [(f"c{i % 60}", i % 2, float(i % 7), float(i)) for i in range(240)]
    df = spark.createDataFrame([r[:3] + (0.0,) for r in rows] + rows, "customerID string, Churn int, x double, y double")
    candidate = training.train_candidate(df, ["x", "y"], SPEC, training.RETRAIN_SPACE, SMOKE)
    assert (candidate.train_rows, candidate.valid_rows) == (384, 96)


def test_formats_by_name_or_argument(spark, tmp_path):
    path = write_csv(frame(spark), str(tmp_path / "folder"))
    assert ingest(spark, path, "csv").count() == 2
    assert ingest(spark, write_csv(frame(spark), str(tmp_path / "T.CSV"))).count() == 2
    with pytest.raises(ValueError, match="unknown format"):
        ingest(spark, path, "xml")


def test_bad_new_data_stops_the_flow(spark, project, tmp_path):
    layout, _ = project
    with pytest.raises(FileNotFoundError, match="New data not found"):
        run_retraining(spark, str(tmp_path / "none"), layout.root, SPEC, SMOKE)
    empty = write_table(frame(spark).limit(0), str(tmp_path / "empty"))
    with pytest.raises(ValueError, match="New data is empty"):
        run_retraining(spark, empty, layout.root, SPEC, SMOKE)
    twice = write_csv(frame(spark, FIRST, FIRST), str(tmp_path / "twice.csv"))
    with pytest.raises(ValueError, match="Found 1 duplicate customer IDs"):
        run_retraining(spark, twice, layout.root, SPEC, SMOKE)


def test_processed_table_needs_its_target(spark, tmp_path):
    path = write_table(frame(spark).drop("Churn"), str(tmp_path / "t"))
    with pytest.raises(ValueError, match="Churn target not found in held-out data"):
        read_processed(spark, path, "Churn", "Held-out data")
    with pytest.raises(FileNotFoundError, match="Held-out data not found"):
        read_processed(spark, str(tmp_path / "u"), "Churn", "Held-out data")
    with pytest.raises(ValueError, match="Churn column not found"):
        assembly.features_and_label(frame(spark).drop("Churn"), ["tenure"], "Churn")
    assert require_path(spark, path, "Table") == path


def test_search_draws_are_repeatable_and_in_range():
    profile = training.SearchProfile.full()
    for space in (training.TUNE_SPACE, training.RETRAIN_SPACE):
        draws = profile.draws(space)
        assert draws == profile.draws(space) and len(draws) == 20
        for drawn in draws:
            for name, value in drawn.items():
                assert space[name].low <= value <= space[name].high
                assert not space[name].integer or value == int(value)
    assert all(d["n_estimators"] % 50 == 0 for d in profile.draws(training.TUNE_SPACE))
    assert profile.draws(training.TUNE_SPACE) != training.SearchProfile(seed=7).draws(training.TUNE_SPACE)


def test_best_trial_tie_takes_the_first(spark):
    trials = spark.createDataFrame([(3, 0.5), (1, 0.9), (0, 0.9)], "trial int, objective double")
    assert training.best_trial(trials).first()["trial"] == 0


def test_union_by_name_fills_absent_columns(spark):
    a = spark.createDataFrame([(1, "x")], "id int, c string")
    b = spark.createDataFrame([("y", 2), ("y", 2)], "c string, id int")
    combined = assembly.combine({"initial": a, "new": b, "more": a.drop("c")})
    assert combined.count() == 4 and combined.where("c is null").count() == 1
    assert {r["source"]: r["rows"] for r in assembly.row_accounting(combined).collect()} == {
        "initial": 1, "new": 2, "more": 1, "combined": 4,
    }
    weights = combined.select(assembly.class_weight(F.col("id"), 3.0).alias("w")).orderBy("w").collect()
    assert [r["w"] for r in weights] == [1.0, 1.0, 3.0, 3.0]
