"""Feature preparation: a fitted state that is a small table, and one projection that applies it."""

from __future__ import annotations

import math
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from churnflow.functions.cells import cell, number, stripped
from churnflow.functions.ordered import exact_medians
from churnflow.functions.running import running_totals
from churnflow.spec import DatasetSpec

STATE_SCHEMA = (
    "kind string, column string, category string, ordinal int, value_double double, value_string string"
)
# This form of the state travels to the driver and becomes one column per category, so it has to stay small.
# Columns with more categories take the sparse form in ``sparse``, which has no limit.
MAX_CATEGORIES = 20_000


def coerced(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Numerical columns as doubles; blank, unparsable and missing cells as null."""
    return df.withColumns({c: number(df, c) for c in spec.numericals})


def encoded_target(spec: DatasetSpec) -> Column:
    """0 for the negative label, 1 for the positive; any other value fails the job."""
    value = cell(spec.target)
    return (
        F.when(value == spec.negative, F.lit(0))
        .when(value == spec.positive, F.lit(1))
        .otherwise(
            F.raise_error(
                F.concat(F.lit(f"{spec.target} value is neither {spec.negative} nor {spec.positive}: "),
                         F.coalesce(value.cast("string"), F.lit("null")))
            ).cast("int")
        )
        .cast("int")
    )


def _category(spec: DatasetSpec, column: str) -> Column:
    return stripped(cell(column)) if spec.trim_categories else cell(column).cast("string")


@dataclass(frozen=True)
class NumericStats:
    median: float
    mean: float
    std: float


@dataclass(frozen=True)
class PrepState:
    """Fitted medians, means and deviations, most frequent values and vocabularies."""

    numericals: dict[str, NumericStats]
    modes: dict[str, str]
    vocabulary: dict[str, tuple[str, ...]]

    def rows(self) -> list[tuple]:
        rows = []
        for c, s in self.numericals.items():
            rows += [(kind, c, None, None, getattr(s, kind), None) for kind in ("median", "mean", "std")]
        rows += [("mode", c, None, None, None, value) for c, value in self.modes.items()]
        rows += [
            ("category", c, value, i, None, None)
            for c, values in self.vocabulary.items()
            for i, value in enumerate(values, start=1)
        ]
        return rows

    def to_table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(self.rows(), STATE_SCHEMA)

    @classmethod
    def from_table(cls, table: DataFrame, spec: DatasetSpec) -> PrepState:
        """Reads a saved state; column order comes from the spec, not from the stored rows."""
        rows = _bounded(table)
        number_of = {(r["kind"], r["column"]): r["value_double"] for r in rows if r["value_double"] is not None}
        try:
            numericals = {
                c: NumericStats(*[number_of[kind, c] for kind in ("median", "mean", "std")])
                for c in spec.numericals
            }
            modes = {r["column"]: r["value_string"] for r in rows if r["kind"] == "mode"}
            modes = {c: modes[c] for c in spec.categoricals}
        except KeyError as error:
            raise ValueError(f"the preparation state does not fit the dataset spec: {error}") from error
        words = sorted(
            (r["column"], r["ordinal"], r["category"]) for r in rows if r["kind"] == "category"
        )
        vocabulary = {c: tuple(w for col, _, w in words if col == c) for c in spec.categoricals}
        return cls(numericals, modes, vocabulary)

    @property
    def feature_names(self) -> list[str]:
        """Prepared columns in order: numericals, then one per column and category."""
        names = [f"numerical__{c}" for c in self.numericals]
        return names + [f"categorical__{c}_{v}" for c, words in self.vocabulary.items() for v in words]

    def features(self, df: DataFrame, spec: DatasetSpec) -> list[Column]:
        """The prepared columns as expressions over a raw table or stream."""
        scaled = [
            ((F.coalesce(number(df, c), F.lit(s.median)) - s.mean) / (s.std or 1.0)).alias(f"numerical__{c}")
            for c, s in self.numericals.items()
        ]
        hot = [
            (F.coalesce(_category(spec, c), F.lit(self.modes[c])) == v)
            .cast("double")
            .alias(f"categorical__{c}_{v}")
            for c, words in self.vocabulary.items()
            for v in words
        ]
        return scaled + hot


def _bounded(table: DataFrame) -> list:
    rows = table.limit(MAX_CATEGORIES + 1).collect()
    if len(rows) > MAX_CATEGORIES:
        raise ValueError(
            f"more than {MAX_CATEGORIES} categories; prepare such columns with churnflow.operators.sparse"
        )
    return rows


def numeric_stats(df: DataFrame, columns: Sequence[str]) -> dict[str, NumericStats]:
    """Median, and mean and population deviation of the column with its gaps set to the median.

    The moments of the filled column follow from those of the values and the number of gaps, so
    filling needs no pass of its own.
    """
    names = [f"c{i}" for i in range(len(columns))]
    values = df.select(*[number(df, c).alias(n) for n, c in zip(names, columns)])
    also = [F.count(F.lit(1)).alias("rows")]
    for i, n in enumerate(names):
        also += [
            F.count(n).alias(f"n{i}"),
            F.avg(n).alias(f"mean{i}"),
            F.var_pop(n).alias(f"var{i}"),
            F.count_if(F.abs(n) == math.inf).alias(f"inf{i}"),
        ]
    medians, moments = exact_medians(values, names, also)
    stats = {}
    for i, (c, median) in enumerate(zip(columns, medians.values())):
        if median is None:
            raise ValueError(f"Numerical column '{c}' has no values to fit on.")
        if moments[f"inf{i}"]:
            raise ValueError(f"Numerical column '{c}' contains infinity.")
        stats[c] = filled_stats(median, moments["rows"], moments[f"n{i}"], moments[f"mean{i}"], moments[f"var{i}"])
    return stats


def filled_stats(median: float, rows: int, values: int, mean: float, variance: float) -> NumericStats:
    """Mean and deviation of a column of so many rows whose gaps are set to the median, from those of its values."""
    filled = values / rows
    gaps = 1.0 - filled
    whole = filled * mean + gaps * median
    spread = filled * (variance + (mean - whole) ** 2) + gaps * (median - whole) ** 2
    if _constant(spread, whole, rows):
        whole, spread = median, 0.0
    return NumericStats(median, whole, math.sqrt(spread))


def _constant(variance: float, mean: float, rows: int) -> bool:
    """Whether a variance is no more than what rounding leaves of a column with one value."""
    noise = rows * sys.float_info.epsilon
    return variance <= noise * variance + (noise * mean) ** 2


def counted_categories(df: DataFrame, categories: Mapping[str, Column]) -> DataFrame:
    """(column, category, rows) for every non-null value of the given category expressions."""
    cells = [F.struct(F.lit(c).alias("column"), value.alias("category")) for c, value in categories.items()]
    return (
        df.select(F.inline(F.array(*cells)))
        .where("category is not null")
        .groupBy("column", "category")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def category_counts(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """(column, category, rows) for every non-null category of every categorical column."""
    return counted_categories(df, {c: _category(spec, c) for c in spec.categoricals})


def modes_of(counts: DataFrame) -> DataFrame:
    """(column, category): the most frequent category of each column; of equals, the smallest."""
    first = F.min(F.struct((-F.col("rows")).alias("n"), "category"))
    return counts.groupBy("column").agg(first.alias("m")).select("column", F.col("m.category").alias("category"))


def vocabulary_of(counts: DataFrame) -> DataFrame:
    """(column, category, ordinal): the sorted categories of each column, numbered from 1."""
    numbered = running_totals(counts.select("column", "category", F.lit(1).alias("one")), "column", "category", ["one"])
    return numbered.select("column", "category", (F.col("before_one") + 1).alias("ordinal"))


def fit_state(df: DataFrame, spec: DatasetSpec) -> PrepState:
    """Fits medians, scaling, most frequent categories (ties: the smallest) and vocabularies."""
    return state_of(numeric_stats(df, spec.numericals), category_counts(df, spec), spec)


def state_of(numericals: Mapping[str, NumericStats], counts: DataFrame, spec: DatasetSpec) -> PrepState:
    """The state of fitted numericals and counted categories (column, category, rows)."""
    mine = Window.partitionBy("column")
    # Few rows, as checked: one per category of the wide form.
    ranked = counts.select(
        "column", "category",
        F.row_number().over(mine.orderBy("category")).alias("ordinal"),
        (F.row_number().over(mine.orderBy(F.desc("rows"), "category")) == 1).alias("is_mode"),
    )
    found = sorted(_bounded(ranked), key=lambda r: (r["column"], r["ordinal"]))
    vocabulary: dict[str, list[str]] = {c: [] for c in spec.categoricals}
    for r in found:
        vocabulary[r["column"]].append(r["category"])
    modes = {r["column"]: r["category"] for r in found if r["is_mode"]}
    for c in spec.categoricals:
        if c not in modes:
            raise ValueError(f"Categorical column '{c}' has no values to fit on.")
    return PrepState(dict(numericals), {c: modes[c] for c in spec.categoricals}, {c: tuple(v) for c, v in vocabulary.items()})


def transform(df: DataFrame, state: PrepState, spec: DatasetSpec) -> DataFrame:
    """Id, prepared features and, if the table has one, the encoded target.

    A single projection without a shuffle; works on batches and streams alike.
    """
    columns = [cell(spec.id_column), *state.features(df, spec)]
    if spec.target in df.columns:
        columns.append(encoded_target(spec).alias(spec.target))
    return df.select(*columns)


def fit_and_transform(df: DataFrame, spec: DatasetSpec) -> tuple[DataFrame, PrepState]:
    state = fit_state(df, spec)
    return transform(df, state, spec), state


def require_prepared(df: DataFrame, state: PrepState, spec: DatasetSpec, width: int | None = None) -> DataFrame:
    """The frame itself if it holds the target and exactly the expected features."""
    if spec.target not in df.columns:
        raise ValueError(f"{spec.target} target missing after transformation.")
    expected = spec.feature_width if width is None else width
    found = [c for c in df.columns if c not in (spec.id_column, spec.target)]
    if len(found) != expected:
        raise ValueError(f"Expected {expected} features but found {len(found)}.")
    if found != state.feature_names:
        raise ValueError("the prepared columns are not those of the fitted state, in its order")
    return df


def filled_categories(df: DataFrame, state: PrepState, spec: DatasetSpec) -> DataFrame:
    """Long form of the categorical block: (id, column, category), only known categories.

    The rows that are 1 in the one-hot block; useful where the wide form has too many columns.
    """
    known = df.sparkSession.createDataFrame(
        [(c, word) for c, words in state.vocabulary.items() for word in words], "column string, category string"
    )
    cells = [
        F.struct(
            F.lit(c).alias("column"),
            F.coalesce(_category(spec, c), F.lit(state.modes[c])).alias("category"),
        )
        for c in state.vocabulary
    ]
    # At most MAX_CATEGORIES rows.
    return df.select(cell(spec.id_column), F.inline(F.array(*cells))).join(
        F.broadcast(known), ["column", "category"], "left_semi"
    )
