"""Preparation of categorical columns with any number of categories.

The vocabulary is a table, never a list on the driver, and applying it is a join. The prepared block is a sparse
matrix in long form, one row per cell that is 1, or one sparse vector per row. A model over such columns is a table too, with
a weight per category, and is fitted and applied by joins, which keep no state and so take streams like batches; vocabulary
and weights are saved side by side.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnflow.functions.cells import cell
from churnflow.functions.running import running_totals
from churnflow.operators.assembly import class_weight
from churnflow.operators.features import counted_categories, modes_of
from churnflow.session import checkpoint_root
from churnflow.sources.tables import read_table, stored, write_table

#: Categories of a column that are broadcast to its rows; more are joined by shuffling.
BROADCAST = 200_000
_INDEX, _WEIGHT = "__index_", "__weight_"
#: Parts of a step that are tried, and the relative gain of a round below which fitting ends.
_STEPS, _TOLERANCE = (1.0, 0.5, 0.25, 0.125, 0.0625, 0.015625), 1e-9


@dataclass(frozen=True)
class SparseState:
    """``positions`` (column, category, position) and ``modes`` (column, category); ``width`` positions in all."""

    columns: tuple[str, ...]
    positions: DataFrame
    modes: DataFrame
    width: int


def _texts(columns: Sequence[str]):
    return {c: cell(c).cast("string") for c in columns}


def fit_sparse(df: DataFrame, columns: Sequence[str]) -> SparseState:
    """Every category gets a position: columns in the given order, categories sorted, counted from 0."""
    counts = stored(counted_categories(df, _texts(columns)), "categories")
    order = F.lpad(F.array_position(F.array(*map(F.lit, columns)), F.col("column")).cast("string"), 10, "0")
    keyed = counts.select("column", "category", F.lit("all").alias("all"), F.struct(order, "category").alias("at"), F.lit(1).alias("one"))
    positions = stored(
        running_totals(keyed, "all", "at", ["one"]).select("column", "category", F.col("before_one").alias("position")), "positions")
    modes = stored(modes_of(counts), "modes")
    missing = set(columns) - {r["column"] for r in modes.select("column").collect()}
    if missing:
        raise ValueError(f"Categorical columns without values to fit on: {sorted(missing)}")
    return SparseState(tuple(columns), positions, modes, positions.count())


def sparse_cells(df: DataFrame, state: SparseState, *ids: str) -> DataFrame:
    """(ids..., column, position): the cells that are 1. Missing cells count as the column's mode; unseen categories have none."""
    cells = [F.struct(F.lit(c).alias("column"), value.alias("category")) for c, value in _texts(state.columns).items()]
    modes = state.modes.withColumnRenamed("category", "mode")
    long = df.select(*map(cell, ids), F.inline(F.array(*cells))).join(F.broadcast(modes), "column")  # one row per column
    filled = long.withColumn("category", F.coalesce("category", "mode")).drop("mode")
    return filled.join(state.positions, ["column", "category"]).select(*map(cell, ids), "column", "position")


def sparse_features(df: DataFrame, state: SparseState, *ids: str) -> DataFrame:
    """(ids..., features): one sparse vector per id, empty if all categories are unseen. The ids have to name a row."""
    width = state.width

    @F.udf(VectorUDT())
    def vector(positions):
        return Vectors.sparse(width, positions, [1.0] * len(positions))

    found = sparse_cells(df, state, *ids).groupBy(*map(cell, ids)).agg(F.sort_array(F.collect_set("position")).alias("p"))
    positions = F.coalesce("p", F.array().cast("array<bigint>")).cast("array<int>")
    return df.select(*map(cell, ids)).join(found, list(ids), "left").select(*map(cell, ids), vector(positions).alias("features"))


def save_sparse(state: SparseState, folder: str) -> str:
    """Writes the vocabulary and the modes as tables."""
    write_table(state.positions, f"{folder}/positions")
    order = F.array_position(F.array(*map(F.lit, state.columns)), F.col("column")).cast("int")
    write_table(state.modes.withColumn("nth", order).coalesce(1), f"{folder}/modes")
    return folder


def load_sparse(spark: SparkSession, folder: str) -> SparseState:
    positions, modes = (read_table(spark, f"{folder}/{name}", "Vocabulary") for name in ("positions", "modes"))
    columns = tuple(r["column"] for r in modes.orderBy("nth").collect())
    return SparseState(columns, positions, modes.select("column", "category"), positions.count())


def widths(state: SparseState) -> dict[str, tuple[int, int]]:
    """Per column, its first position and its number of categories."""
    found = state.positions.groupBy("column").agg(F.min("position").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    return {r["column"]: (r["first"], r["n"]) for r in found}


def _beside_categories(df: DataFrame, state: SparseState, found: DataFrame, value: str, prefix: str) -> DataFrame:
    """``df``, a batch or a stream, with the value that ``found`` (column, category, value) has for each column's category, null if
    it is unseen. One join a column, none of which keeps state; a missing cell counts as the column's mode."""
    sizes = widths(state)
    modes = {r["column"]: r["category"] for r in state.modes.collect()}
    for c, text in _texts(state.columns).items():
        words = found.where(F.col("column") == c).select(F.col("category").alias("__category"), F.col(value).alias(prefix + c))
        side = F.broadcast(words) if sizes[c][1] <= BROADCAST else words
        df = df.join(side, F.coalesce(text, F.lit(modes[c])) == F.col("__category"), "left").drop("__category")
    return df


def indexed(df: DataFrame, state: SparseState) -> DataFrame:
    """``df``, a batch or a stream, with the place of each column's category in its vocabulary, its size if unseen."""
    wide = _beside_categories(df, state, state.positions, "position", _INDEX)
    places = {_INDEX + c: F.coalesce((cell(_INDEX + c) - first).cast("double"), F.lit(float(size))) for c, (first, size) in widths(state).items()}
    return wide.withColumns(places)


def _present(name: str) -> Column:
    """A number; a missing one fails the job."""
    value = cell(name).cast("double")
    return F.when(value.isNull() | F.isnan(value), F.raise_error(F.lit(f"{name} is missing")).cast("double")).otherwise(value)


@dataclass(frozen=True)
class SparseModel:
    """A logistic model over numbers and columns with any number of categories.

    ``weights`` (column, category, weight) has a row per category, and the driver holds what numbers weigh alone. Trees are
    no choice here: Spark keeps a number for every feature of every training row of theirs, and the categories are the features.
    """

    state: SparseState
    weights: DataFrame
    numbers: Mapping[str, float]
    intercept: float

    def scored(self, rows: DataFrame, score: str = "score") -> DataFrame:
        """``rows``, a batch or a stream, with the probability of the positive class."""
        kept = [cell(c) for c in rows.columns]
        margin = F.lit(self.intercept)
        for name, weight in self.numbers.items():
            margin += _present(name) * weight
        for c in self.state.columns:
            margin += F.coalesce(cell(_WEIGHT + c), F.lit(0.0))
        return _beside_categories(rows, self.state, self.weights, "weight", _WEIGHT).select(*kept, _probability(margin).alias(score))

    def save(self, folder: str) -> str:
        save_sparse(self.state, f"{folder}/vocabulary")
        write_table(self.weights, f"{folder}/weights")
        numbers = [(None, None, self.intercept), *((i, name, weight) for i, (name, weight) in enumerate(self.numbers.items()))]
        write_table(self.weights.sparkSession.createDataFrame(numbers, "nth int, name string, weight double").coalesce(1), f"{folder}/numbers")
        return folder

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> SparseModel:
        weights, numbers = (read_table(spark, f"{folder}/{name}", "Sparse model") for name in ("weights", "numbers"))
        (intercept, *found) = numbers.orderBy(F.asc_nulls_first("nth")).collect()
        return cls(load_sparse(spark, f"{folder}/vocabulary"), weights, {r["name"]: r["weight"] for r in found}, intercept["weight"])


def _probability(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(-margin))


def _loss(margin: Column) -> Column:
    return F.greatest(margin, F.lit(0.0)) + F.log1p(F.exp(-F.abs(margin))) - F.col("y") * margin


def fit_sparse_model(
    df: DataFrame, label: str, columns: Sequence[str], numericals: Sequence[str] = (), positive_weight: float = 1.0,
    iterations: int = 20, penalty: float = 1e-3,
) -> SparseModel:
    """Fits vocabularies and a logistic model on (label, numbers, categories) rows; the label is 0 or 1, numbers must be there.

    Minimizes the mean loss and half the ``penalty`` on squared weights, each times its feature's deviation, in at most so many
    rounds. A round takes a Newton step for every column along with the numbers. A row has one category of a column, so its
    categories meet only through the numbers: sums per category, a row each in a table, tell their steps once a small
    system, all that the driver gets to see, has told those of the numbers. A category steps no further than where its own slope
    would end, and of parts of a step that is taken with the least loss.
    """
    checkpoint_root(df.sparkSession)
    state = fit_sparse(df, columns)
    target = cell(label).cast("double")
    binary = F.when(target.isin(0.0, 1.0), target).otherwise(F.raise_error(F.lit(f"{label} is neither 0 nor 1")).cast("double"))
    places = [cell(_INDEX + c).cast("bigint").alias(f"i{n}") for n, c in enumerate(columns)]
    rows = stored(indexed(df, state).select(
        binary.alias("y"), class_weight(target, positive_weight).alias("w"), *[_present(c).alias(f"x{k}") for k, c in enumerate(numericals)], *places,
    ), "sparse-rows")
    seen = rows.agg(
        F.sum("w").alias("w"), F.sum(F.col("w") * F.col("w")).alias("ww"), F.sum("y").alias("y"), F.sum(F.col("w") * F.col("y")).alias("wy"),
        F.count(F.lit(1)).alias("n"), *[(F.sum(F.col("w") * F.col(f"x{k}")) / F.sum("w")).alias(f"m{k}") for k in range(len(numericals))]).first()
    if seen["y"] in (0, seen["n"]) or not seen["wy"] > 0:
        sure = math.inf if seen["wy"] > 0 else -math.inf
        weights = state.positions.select("column", "category", F.lit(0.0).alias("weight"))
        return SparseModel(state, weights, dict.fromkeys(numericals, 0.0), sure)
    means, fit = [seen[f"m{k}"] for k in range(len(numericals))], _Fit(seen["w"], seen["w"] - seen["ww"] / seen["w"], penalty, widths(state), columns)
    spreads = _deviations(rows, means, fit.freedom)
    z = [F.lit(0.0) if not s else (F.col(f"x{k}") - m) / s for k, (m, s) in enumerate(zip(means, spreads))]
    base = np.zeros(1 + len(z))
    base[0] = math.log(seen["wy"] / (seen["w"] - seen["wy"]))
    tables: dict[int, DataFrame] = {}
    loss = None
    for _ in range(iterations):
        earlier = loss
        for n in range(len(columns)):
            base, tables[n], loss, gain = fit.step(rows, z, base, tables, n)
            earlier = loss + gain if earlier is None else earlier
        if earlier - loss <= _TOLERANCE * abs(earlier):
            break
    slopes = [g / s if s else 0.0 for g, s in zip(base[1:].tolist(), spreads)]
    intercept = float(base[0]) - sum(g * m for g, m in zip(slopes, means))
    first = widths(state)
    weights = [
        state.positions.where(F.col("column") == c).withColumn("i", F.col("position") - first[c][0])
        .join(tables[n], "i", "left").select("column", "category", F.coalesce("b", F.lit(0.0)).alias("weight"))
        for n, c in enumerate(columns) if n in tables
    ] or [state.positions.select("column", "category", F.lit(0.0).alias("weight"))]
    return SparseModel(state, stored(reduce(DataFrame.unionByName, weights), "sparse-weights"), dict(zip(numericals, slopes)), intercept)


def _deviations(rows: DataFrame, means: Sequence[float], freedom: float) -> list[float]:
    """The deviation of each number, 0 for one with a single value."""
    if not means:
        return []
    squares = [F.sum(F.col("w") * (F.col(f"x{k}") - m) ** 2).alias(f"s{k}") for k, m in enumerate(means)]
    found = rows.agg(*squares, *[(F.min(f"x{k}") < F.max(f"x{k}")).alias(f"d{k}") for k in range(len(means))]).first()
    return [math.sqrt(found[f"s{k}"] / freedom) if found[f"d{k}"] and freedom > 0 else 0.0 for k in range(len(means))]


@dataclass(frozen=True)
class _Fit:
    """What all steps of a fit share: the sum of weights, the denominator of variances, and the columns with their sizes."""

    total: float
    freedom: float
    penalty: float
    sizes: Mapping[str, tuple[int, int]]
    columns: Sequence[str]

    def _with_tables(self, rows: DataFrame, tables: Mapping[int, DataFrame]) -> DataFrame:
        for n, table in tables.items():
            named = table.select(F.col("i").alias(f"i{n}"), *[F.col(c).alias(f"{c}{n}") for c in table.columns if c != "i"])
            side = F.broadcast(named) if self.sizes[self.columns[n]][1] <= BROADCAST else named
            rows = rows.join(side, f"i{n}")  # every category of the rows has a row
        return rows

    def step(self, rows: DataFrame, z: Sequence[Column], base: np.ndarray, tables: Mapping[int, DataFrame], n: int):
        """A step of the numbers and the categories of column ``n``: the numbers' weights, the table (i, b) of the column,
        the loss, and how much less it is."""
        one = [F.lit(1.0), *z]
        fixed = reduce(lambda a, b: a + b, [x * float(g) for x, g in zip(one, base)] + [F.col(f"b{m}") for m in tables])
        pairs = [(k, l) for k in range(len(one)) for l in range(k, len(one))]  # noqa: E741
        judged = self._with_tables(rows, tables).withColumn("p", _probability(fixed))
        slope, bend = F.col("w") * (F.col("p") - F.col("y")), F.col("w") * F.col("p") * (1 - F.col("p"))
        sums = judged.groupBy(F.col(f"i{n}").alias("i")).agg(
            F.sum("w").alias("w"), *[F.sum(slope * x).alias(f"g{k}") for k, x in enumerate(one)],
            *[F.sum(bend * one[k] * one[l]).alias(f"h{k}_{l}") for k, l in pairs], F.max(f"b{n}" if n in tables else F.lit(0.0)).alias("b"))
        share = F.greatest(F.col("w") * (1 - F.col("w") / self.total) / (self.freedom or 1.0), F.lit(0.0))
        ridge = (share * (self.penalty * self.total)).alias("ridge")
        # A category that all rows have says nothing beside the intercept.
        sums = stored(sums.select("*", ridge, share.alias("share")).withColumn("free", (F.col("share") > 0) & (F.col("h0_0") + F.col("ridge") > 0)), "sparse-sums")
        own, stiff = F.col("g0") + F.col("ridge") * F.col("b"), F.col("h0_0") + F.col("ridge")
        through = [F.col(f"h0_{k}") for k in range(len(one))]
        told = sums.agg(
            *[F.sum(f"g{k}").alias(f"g{k}") for k in range(len(one))], *[F.sum(f"h{k}_{l}").alias(f"h{k}_{l}") for k, l in pairs],
            *[F.sum(F.when(F.col("free"), through[k] * own / stiff)).alias(f"r{k}") for k in range(len(one))],
            *[F.sum(F.when(F.col("free"), through[k] * through[l] / stiff)).alias(f"s{k}_{l}") for k, l in pairs]).first()
        ridges = np.array([0.0] + [self.penalty * self.total] * len(z))
        system, wanted = np.diag(ridges), -ridges * base
        for k in range(len(one)):
            wanted[k] += (told[f"r{k}"] or 0.0) - told[f"g{k}"]
        for k, l in pairs:  # noqa: E741
            value = told[f"h{k}_{l}"] - (told[f"s{k}_{l}"] or 0.0)
            system[k, l] += value
            if k != l:
                system[l, k] += value
        move = np.linalg.lstsq(system, wanted, rcond=1e-12)[0]
        moved = reduce(lambda a, b: a + b, [own, *[h * float(d) for h, d in zip(through, move)]])
        walked = sums.select("i", "b", "ridge", F.when(F.col("free"), -F.signum(moved) * F.log1p(F.abs(moved) / stiff)).otherwise(0.0).alias("d"))
        walked = stored(walked, "sparse-steps")
        t = self._length(rows, one, base, move, {**tables, n: walked.select("i", "b", "d")}, n, walked, ridges)
        return base + t[0] * move, walked.select("i", (F.col("b") + F.col("d") * t[0]).alias("b")), t[1], t[2]

    def _length(self, rows, one, base, move, tables, n, walked, ridges) -> tuple[float, float, float]:
        """The part of a step with the least loss, that loss, and how much less it is than without the step."""
        still = reduce(lambda a, b: a + b, [x * float(g) for x, g in zip(one, base)] + [F.col(f"b{m}") for m in tables])
        along = reduce(lambda a, b: a + b, [x * float(d) for x, d in zip(one, move)] + [F.col(f"d{n}")])
        parts = (0.0, *_STEPS)
        margins = self._with_tables(rows, tables).select("y", "w", still.alias("m"), along.alias("v"))
        found = margins.agg(*[F.sum(F.col("w") * _loss(F.col("m") + F.col("v") * t)).alias(f"t{i}") for i, t in enumerate(parts)]).first()
        held = walked.agg(*[F.sum(F.col("ridge") * (F.col("b") + F.col("d") * t) ** 2).alias(f"t{i}") for i, t in enumerate(parts)]).first()
        losses = [(found[i] + (held[i] + float(np.sum(ridges * (base + t * move) ** 2))) / 2) / self.total for i, t in enumerate(parts)]
        best = min(range(len(parts)), key=lambda i: losses[i])
        return parts[best], losses[best], losses[0] - losses[best]
