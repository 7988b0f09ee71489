"""Order statistics that never put a whole column into one task."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F


#: Slices of an interval around the middle of a column, and distinct values up to which it is sorted as it is.
_SLICES, ONE_SORT = 256, 200_000


def exact_medians(
    df: DataFrame, columns: Sequence[str], also: Sequence[Column] = (), accuracy: int = 10_000
) -> tuple[dict[str, float | None], Row]:
    """Exact median of the non-null values of double columns (mean of the middle two if even).

    One pass sketches an interval around the middle of each column; a second pass counts the
    values below it and the distinct values inside it, so only a sliver of the data is shuffled.
    An interval of many values is cut into slices that hold about as many of them, and only slices that hold a middle
    value are sorted. The ranks found are checked against the counts; an interval that missed is widened, in the
    end to the whole column. A column without values yields None. The aggregates in ``also`` are
    computed in the first pass and returned as a row.
    """
    keys = [f"c{i}" for i in range(len(columns))]
    numbers = df.withColumnsRenamed(dict(zip(columns, keys)))
    todo, extra = set(keys), None
    medians: dict[str, float | None] = {}
    margin = 2.0 / accuracy
    while todo:
        sizes, limits, row = _middle_intervals(numbers, sorted(todo), margin, accuracy, also if extra is None else ())
        extra = row if extra is None else extra
        medians |= {c: None for c in todo if not sizes[c]}
        if limits:
            medians |= _medians_inside(numbers, sizes, limits)
        todo -= medians.keys()
        margin *= 16
    return {name: medians[k] for k, name in zip(keys, columns)}, extra


def _middle_intervals(numbers: DataFrame, keys: Sequence[str], margin: float, accuracy: int, also):
    def interval(c):
        if margin >= 0.5:
            return F.array(F.min(c), F.max(c))
        return F.percentile_approx(c, [0.5 - margin, 0.5 + margin], accuracy)

    row = numbers.agg(
        *[F.count(c).alias(f"n_{c}") for c in keys], *[interval(c).alias(f"i_{c}") for c in keys], *also
    ).first()
    sizes = {c: row[f"n_{c}"] for c in keys}
    return sizes, {c: tuple(row[f"i_{c}"]) for c in keys if sizes[c]}, row


def place_among(value: Column, edges: Sequence[float]) -> Column:
    """How many different edges are below a value; looks at about twice the root of their number."""
    ascending = sorted(set(edges))
    if not ascending:
        return F.lit(0)
    step = math.isqrt(len(ascending) - 1) + 1
    coarse = ascending[step - 1 :: step]
    group = F.size(F.filter(F.lit(coarse), lambda e: e < value)) if coarse else F.lit(0)
    within = F.filter(F.slice(F.lit(ascending), group * step + 1, F.lit(step)), lambda e: e < value)
    return group * step + F.size(within)


def _slices(counted: DataFrame, names: Sequence[str]) -> Column:
    """The slice of its column's interval that a value lies in, in ascending order; -1 below the interval. The
    edges are sketched quantiles of the distinct values, so slices hold about as many, however these are spread."""
    shares = [i / _SLICES for i in range(1, _SLICES)]
    edges = {r["name"]: r["edges"] for r in counted.groupBy("name").agg(F.percentile_approx("value", shares, 10_000).alias("edges")).collect()}
    place = F.lit(0)
    for c in names:
        if edges.get(c):
            place = F.when(F.col("name") == c, place_among(F.col("value"), edges[c])).otherwise(place)
    return F.when(F.col("value").isNull(), -1).otherwise(place)


def _medians_inside(numbers: DataFrame, sizes: Mapping[str, int], limits: Mapping[str, tuple]) -> dict:
    # Values below the interval become one row per column, with a null in place of the value.
    cells = F.array(*[
        F.struct(
            F.lit(c).alias("name"), F.when(F.col(c) >= low, F.col(c)).alias("value"), (F.col(c) <= high).alias("counts")
        )
        for c, (low, high) in limits.items()
    ])
    counted = numbers.select(F.inline(cells)).where("counts").groupBy("name", "value").agg(F.count(F.lit(1)).alias("n")).persist()
    # The ranks, counted from 0, of the two middle values.
    ranks = {c: ((sizes[c] - 1) // 2, sizes[c] // 2) for c in limits}
    lower, upper = (F.element_at(_literal_map({c: r[i] for c, r in ranks.items()}), F.col("name")) for i in (0, 1))
    try:
        if counted.count() <= ONE_SORT:
            based = counted.withColumns({"slice": F.lit(0), "base": F.lit(0)})
        else:
            sliced = counted.withColumn("slice", _slices(counted, list(limits)))
            earlier = Window.partitionBy("name").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
            wanted = (
                sliced.groupBy("name", "slice").agg(F.sum("n").alias("held"))
                .withColumn("base", F.coalesce(F.sum("held").over(earlier), F.lit(0)))
                .where((F.col("base") + F.col("held") > lower) & (F.col("base") <= upper))
                .select("name", "slice", "base")
            )
            # Two rows a column at most.
            based = sliced.join(F.broadcast(wanted), ["name", "slice"])
        ascending = Window.partitionBy("name", "slice").orderBy(F.asc_nulls_first("value")).rowsBetween(
            Window.unboundedPreceding, Window.currentRow
        )
        middle = (
            based.withColumn("running", F.col("base") + F.sum("n").over(ascending))
            .where((F.col("running") > lower) & (F.col("running") - F.col("n") <= upper))
            .select("name", "value", "n", "running")
            .collect()
        )
    finally:
        counted.unpersist()
    result = {}
    for c, pair in ranks.items():
        rows = [r for r in middle if r["name"] == c and r["value"] is not None]
        values = [
            r["value"] for rank in pair for r in rows if r["running"] - r["n"] <= rank < r["running"]
        ]
        if len(values) == 2:
            result[c] = (values[0] + values[1]) / 2.0
    return result


def _literal_map(values: Mapping[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for item in values.items() for x in item])
