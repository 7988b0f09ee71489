"""What is read several times is made once."""

import dataclasses

import pytest
from pyspark.sql import functions as F

from churnflow.operators import training
from churnflow.operators.split import fit_split
from churnflow.plans import bootstrap, catalog
from tests.rows import SPEC


def counted(spark, df, column):
    """``df``, and a counter of how often a row's cell is made."""
    times = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def look(value):
        times.add(1)
        return value

    return df.withColumn(column, look.asNondeterministic()(column)), times


def test_prepared_rows_do_not_join_again(spark, sf_dir):
    prepared, _ = catalog._prepared(spark, sf_dir)
    assert prepared.count() == catalog._subscribers(spark, sf_dir).count()
    assert not [f for f in prepared.inputFiles() if sf_dir in f]


def test_model_saved_prepares_once(spark, sf_dir, monkeypatch):
    made = []
    whole = catalog._subscribers
    monkeypatch.setattr(catalog, "_subscribers", lambda *a: made.append(1) or whole(*a))
    catalog.model_saved(spark, sf_dir)
    assert made == [1]


def test_raw_rows_are_parsed_once(spark, tmp_path, monkeypatch):
    class Enough(Exception):
        pass

    def stop(rows, *_):
        assert rows.count() == 50
        raise Enough

    raw, times = counted(spark, spark.range(50).select(F.col("id").cast("string").alias(SPEC.id_column)), SPEC.id_column)
    monkeypatch.setattr(bootstrap, "three_way_split", stop)
    with pytest.raises(Enough):
        bootstrap.run_bootstrap(spark, raw, str(tmp_path), SPEC)
    assert times.value == 50
    with pytest.raises(ValueError, match="Raw data is empty"):
        bootstrap.run_bootstrap(spark, raw.limit(0), str(tmp_path), SPEC)


def test_rows_are_dealt_to_parts_once(spark):
    rows = [(str(i), i % 7 / 7, i % 2) for i in range(200)]
    df = spark.createDataFrame(rows, f"`{SPEC.id_column}` string, x double, `{SPEC.target}` int")
    prepared, times = counted(spark, df, SPEC.id_column)
    fit_split(prepared, SPEC.target, SPEC.id_column, 0.20, "42:v:")
    fitted = times.value
    found = training.train_candidate(prepared, ["x"], SPEC, training.RETRAIN_SPACE, dataclasses.replace(training.SearchProfile.smoke(), trials=1))
    assert (found.train_rows, found.valid_rows) == (160, 40)
    assert times.value - 2 * fitted == 200


def test_copies_of_rows_bound_the_fits_at_a_time():
    assert [training._at_a_time(8, rows) for rows in (0, 720_000, 4_320_000, 100_000_000)] == [8, 8, 2, 1]
