import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from churnflow.functions.ordered import exact_medians
from churnflow.functions.running import running_totals
from churnflow.operators import features, sparse
from churnflow.sources.models import load_state, save_state
from churnflow.sources.views import view
from tests.rows import FIRST, SECOND, SPEC, changed, frame


def median_of(df, accuracy=10_000):
    return exact_medians(df, ["x"], accuracy=accuracy)[0]["x"]


@pytest.mark.parametrize("accuracy", [10, 100, 10_000])
def test_median_matches_brute_force(spark, accuracy):
    generator = np.random.default_rng(5)
    samples = {
        "normal": generator.normal(size=20_001),
        "ties": generator.integers(0, 4, size=10_000).astype(float),
        "one hot value": np.where(generator.random(9_999) < 0.4, 7.5, generator.normal(7.5, 1, 9_999)),
        "two halves": np.r_[np.zeros(500), np.ones(500)],
        "single": np.array([3.0]),
        "wide": np.exp(generator.normal(0, 30, size=5_000)),
        "negative": -generator.random(777),
    }
    for name, values in samples.items():
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,)] * 50, "x double").repartition(8)
        assert median_of(df, accuracy) == np.median(values), name


def test_median_of_no_values(spark):
    assert median_of(spark.createDataFrame([(None,)], "x double")) is None


def test_golden_statistics(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (9.0,)], "x double")
    stats = features.numeric_stats(df, ["x"])["x"]
    assert (stats.median, stats.mean) == (3.0, 4.0)
    assert stats.std == pytest.approx(3.082207001484488, abs=1e-12)


def test_statistics_are_of_the_filled_column(spark):
    values = [1.0, 2.0, 4.0, 9.0, None, None, None]
    stats = features.numeric_stats(spark.createDataFrame([(v,) for v in values], "x double"), ["x"])["x"]
    filled = np.array([3.0 if v is None else v for v in values])
    assert stats.mean == pytest.approx(filled.mean(), abs=1e-12)
    assert stats.std == pytest.approx(filled.std(), abs=1e-12)


@pytest.mark.parametrize("value", [0.1, 70.35, -1e9, 1e-300, 0.0])
def test_constant_columns_with_gaps_scale_to_zero(spark, value):
    df = spark.range(3000).select(F.when(F.col("id") % 7 != 0, F.lit(value)).alias("x"), F.lit(value).alias("y")).repartition(8)
    stats = features.numeric_stats(df, ["x", "y"])
    assert all((s.median, s.mean, s.std) == (value, value, 0.0) for s in stats.values())


def test_small_spreads_are_no_noise(spark):
    df = spark.range(1000).select((1.0 + (F.col("id") % 2) * 1e-9).alias("x"))
    assert features.numeric_stats(df, ["x"])["x"].std == pytest.approx(5e-10, rel=1e-3)


def test_sparse_form_has_no_limit(spark):
    df = spark.range(30_000).select("id", F.concat(F.lit("k"), "id").alias("a"), F.when(F.col("id") % 3 > 0, "x").alias("b"))
    state = sparse.fit_sparse(df.where("id < 25000"), ("a", "b"))
    assert state.width == 25_001
    cells = sparse.sparse_cells(df, state, "id")
    assert cells.where("column = 'a'").count() == 25_000 and cells.where("column = 'b'").count() == 30_000
    order = {w: i for i, w in enumerate(sorted(f"k{i}" for i in range(25_000)))}
    assert all(order[f"k{r['id']}"] == r["position"] for r in cells.where("column = 'a' AND id % 1000 = 7").collect())
    vectors = {r["id"]: r["features"] for r in sparse.sparse_features(df, state, "id").where("id % 5000 = 0").collect()}
    assert all(v.size == 25_001 and v.numNonzeros() == (2 if i < 25_000 else 1) for i, v in vectors.items())
    with pytest.raises(ValueError, match="without values"):
        sparse.fit_sparse(df.select("id", F.lit(None).cast("string").alias("a")), ("a",))


def test_running_totals(spark):
    df = spark.range(500).selectExpr("if(id % 3 = 0, 'a', 'b') AS g", "id * 7 % 500 AS k", "id AS v")
    rows = running_totals(df, "g", "k", ["v"]).collect()
    for r in rows[::17]:
        assert r["before_v"] == sum(x["v"] for x in rows if x["g"] == r["g"] and x["k"] < r["k"])


def test_equal_values_scale_to_zero(spark):
    df = frame(spark, FIRST, SECOND | {"tenure": FIRST["tenure"]})
    prepared, _ = features.fit_and_transform(df, SPEC)
    assert [r[0] for r in prepared.select("numerical__tenure").collect()] == [0.0, 0.0]


def test_columns_without_values_cannot_be_fitted(spark):
    empty = frame(spark, FIRST | {"TotalCharges": " "}, SECOND | {"TotalCharges": "abc"})
    with pytest.raises(ValueError, match="'TotalCharges' has no values"):
        features.fit_state(empty, SPEC)
    with pytest.raises(ValueError, match="'gender' has no values"):
        features.fit_state(frame(spark, FIRST | {"gender": None}, SECOND | {"gender": None}), SPEC)
    with pytest.raises(ValueError, match="contains infinity"):
        features.fit_state(changed(spark, "TotalCharges", "inf"), SPEC)


def test_mode_tie_takes_the_smallest(spark):
    assert features.fit_state(frame(spark), SPEC).modes["gender"] == "Female"


def test_target_is_kept_and_encoded(spark):
    prepared, state = features.fit_and_transform(frame(spark), SPEC)
    assert [r["Churn"] for r in prepared.orderBy("customerID").collect()] == [0, 1]
    assert prepared.columns == ["customerID", *state.feature_names, "Churn"]


def test_unknown_target_fails(spark):
    df = changed(spark, "Churn", " Yes")
    state = features.fit_state(df, SPEC)
    with pytest.raises(Exception, match="Churn value is neither No nor Yes:  Yes"):
        features.transform(df, state, SPEC).collect()


def test_unseen_and_missing_categories(spark):
    state = features.fit_state(frame(spark), SPEC)
    rows = FIRST | {"gender": "Other"}, SECOND | {"gender": None}, SECOND | {"gender": " Male"}
    prepared = features.transform(frame(spark, *rows), state, SPEC)
    block = prepared.select("categorical__gender_Female", "categorical__gender_Male").collect()
    assert [tuple(r) for r in block] == [(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]


def test_trimming_is_opt_in(spark):
    from churnflow import telecom_spec

    spec = telecom_spec(trim_categories=True)
    state = features.fit_state(frame(spark), spec)
    prepared = features.transform(changed(spark, "gender", " Male"), state, spec)
    assert prepared.first()["categorical__gender_Male"] == 1.0


def test_matrix_invariants(spark, sf_dir):
    df = view(spark, sf_dir, "subscribers")
    prepared, state = features.fit_and_transform(df, SPEC)
    assert len(state.feature_names) == SPEC.feature_width == 45
    assert prepared.count() == df.count()
    for c in SPEC.categoricals:
        block = [F.col(f"`{n}`") for n in state.feature_names if n.startswith(f"categorical__{c}_")]
        assert prepared.where(sum(block) != 1).isEmpty()
    for c in SPEC.numericals:
        row = prepared.agg(F.avg(f"numerical__{c}"), F.stddev_pop(f"numerical__{c}")).first()
        assert math.isclose(row[0], 0, abs_tol=1e-9) and math.isclose(row[1], 1, abs_tol=1e-9)


def test_state_survives_saving(spark, tmp_path):
    state = features.fit_state(frame(spark), SPEC)
    path = save_state(spark, state, str(tmp_path / "state"))
    assert load_state(spark, path, SPEC) == state
    with pytest.raises(FileNotFoundError, match="Preparation state not found"):
        load_state(spark, str(tmp_path / "none"), SPEC)


def test_output_contract(spark):
    prepared, state = features.fit_and_transform(frame(spark), SPEC)
    with pytest.raises(ValueError, match="Expected 45 features but found 34"):
        features.require_prepared(prepared, state, SPEC)
    assert features.require_prepared(prepared, state, SPEC, 34) is prepared
    with pytest.raises(ValueError, match="Churn target missing"):
        features.require_prepared(prepared.drop("Churn"), state, SPEC)


def test_transform_is_one_projection(spark, sf_dir):
    from churnflow.sources.tables import write_table
    from churnflow.session import work_folder

    path = write_table(view(spark, sf_dir, "subscribers"), work_folder(spark, "plan"))
    df = spark.read.parquet(path)
    state = features.fit_state(df, SPEC)
    plan = features.transform(df, state, SPEC)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
