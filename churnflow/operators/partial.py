"""Fitted preparation state in parts, one for each delivery, that merge to the state of all rows.

Adding a delivery reads its rows only; merging reads the parts, never a row again. A part has, of every numerical column, the
moments and how often each value occurs, the values dealt to slices of the number line that the first delivery fixes; of
every categorical column, the categories with their counts. Medians of all rows are exact: counts per slice, added up
over the parts, tell the slice that the middle lies in, and only that slice's values are read.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnflow.functions.cells import number
from churnflow.functions.running import running_totals
from churnflow.operators.features import NumericStats, PrepState, category_counts, filled_stats, state_of
from churnflow.sources.tables import read_table, require_path, stored, write_table
from churnflow.spec import DatasetSpec

SLICES = 64
_SCHEMAS = {
    "moments": "column string, rows bigint, n bigint, mean double, variance double, infinite bigint, delivery string",
    "slices": "column string, slice int, n bigint, delivery string",
    "values": "column string, value double, n bigint, slice int, delivery string",
    "categories": "column string, category string, rows bigint, delivery string",
}


@dataclass(frozen=True)
class StateParts:
    """The parts below a folder. Adding a delivery again replaces its part."""

    spark: SparkSession
    folder: str
    spec: DatasetSpec

    def add(self, df: DataFrame, delivery: str) -> None:
        """Writes the part of one delivery, from one look at its numbers and one at its categories."""
        names = list(self.spec.numericals)
        # Adding 0.0 makes -0.0 and 0.0 the same value.
        values = df.select(*[(number(df, c) + F.lit(0.0)).alias(f"c{i}") for i, c in enumerate(names)])
        edges = self._edges(values)
        cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"c{i}").alias("value")) for i, c in enumerate(names)])
        long = values.select(F.inline(cells))
        moments = long.groupBy("column").agg(
            F.count(F.lit(1)).alias("rows"), F.count("value").alias("n"), F.avg("value").alias("mean"),
            F.var_pop("value").alias("variance"), F.count_if(F.abs("value") == float("inf")).alias("infinite"))
        self._write(moments.coalesce(1), "moments", delivery)
        # One row per column.
        counted = (
            long.where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")).join(F.broadcast(edges), "column")
            .withColumn("slice", F.size(F.filter("edges", lambda e: e < F.col("value")))).drop("edges")
        )
        # Sorted, so that the statistics of files and row groups tell where a slice is.
        self._write(counted.repartitionByRange("column", "slice", "value").sortWithinPartitions("column", "slice", "value"), "values", delivery)
        held = self._read("values").where(F.col("delivery") == delivery).groupBy("column", "slice").agg(F.sum("n").alias("n"))
        self._write(held.coalesce(1), "slices", delivery)
        self._write(category_counts(df, self.spec), "categories", delivery)

    def _write(self, df: DataFrame, kind: str, delivery: str) -> None:
        rows = df.withColumn("delivery", F.lit(delivery))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("delivery").parquet(f"{self.folder}/{kind}")

    def _read(self, kind: str) -> DataFrame:
        require_path(self.spark, f"{self.folder}/{kind}", "Partial state")
        return self.spark.read.schema(_SCHEMAS[kind]).parquet(f"{self.folder}/{kind}")

    def _edges(self, values: DataFrame) -> DataFrame:
        """(column, edges): what cuts each column's numbers into slices, sketched from the first delivery."""
        path = f"{self.folder}/edges"
        try:
            return read_table(self.spark, path)
        except FileNotFoundError:
            shares = [i / SLICES for i in range(1, SLICES)]
            sketched = values.agg(*[F.percentile_approx(c, shares, 1000).alias(c) for c in values.columns])
            edges = F.array(*[
                F.struct(F.lit(c).alias("column"), F.array_distinct(F.coalesce(F.col(f"c{i}"), F.array().cast("array<double>"))).alias("edges"))
                for i, c in enumerate(self.spec.numericals)])
            write_table(sketched.select(F.inline(edges)).coalesce(1), path)
            return read_table(self.spark, path)

    def numericals(self) -> dict[str, NumericStats]:
        """Medians, means and deviations over all deliveries."""
        parts = self._read("moments").where("n > 0")
        whole = parts.groupBy("column").agg(F.sum("n").alias("all"), (F.sum(F.col("n") * F.col("mean")) / F.sum("n")).alias("middle"), F.sum("infinite").alias("infinite"))
        # Squares around the common mean lose no digits to each other. One row per column.
        spread = parts.join(F.broadcast(whole.drop("infinite")), "column").groupBy("column").agg(
            (F.sum(F.col("n") * (F.col("variance") + (F.col("mean") - F.col("middle")) ** 2)) / F.max("all")).alias("variance"))
        rows = {r["column"]: r["rows"] for r in self._read("moments").groupBy("column").agg(F.sum("rows").alias("rows")).collect()}
        found = {r["column"]: r for r in whole.join(spread, "column").collect()}
        for c in self.spec.numericals:
            if c not in found:
                raise ValueError(f"Numerical column '{c}' has no values to fit on.")
            if found[c]["infinite"]:
                raise ValueError(f"Numerical column '{c}' contains infinity.")
        medians = self._medians({c: found[c]["all"] for c in self.spec.numericals})
        return {c: filled_stats(medians[c], rows[c], found[c]["all"], found[c]["middle"], found[c]["variance"]) for c in self.spec.numericals}

    def _medians(self, sizes: Mapping[str, int]) -> dict[str, float]:
        held: dict[str, list] = {c: [] for c in sizes}
        # One row per column and slice.
        for r in self._read("slices").groupBy("column", "slice").agg(F.sum("n").alias("n")).orderBy("slice").collect():
            if r["column"] in held:
                held[r["column"]].append((r["slice"], r["n"]))
        ranks = {c: ((n - 1) // 2, n // 2) for c, n in sizes.items()}
        wanted, bases = F.lit(False), {}
        for c, slices in held.items():
            before, chosen = 0, []
            for number_, n in slices:
                if before + n > ranks[c][0] and before <= ranks[c][1]:
                    bases.setdefault(c, before)
                    chosen.append(number_)
                before += n
            wanted = wanted | ((F.col("column") == c) & F.col("slice").isin(*chosen))
        values = self._read("values").where(wanted).groupBy("column", "value").agg(F.sum("n").alias("n"))
        inside = running_totals(stored(values, "middle-values"), "column", "value", ["n"])
        cases = F
        for c, (low, high) in ranks.items():
            first = F.col("before_n") + F.lit(bases[c])
            cases = cases.when(F.col("column") == c, (first <= high) & (first + F.col("n") > low))
        found: dict[str, list] = {c: [] for c in sizes}
        for r in inside.where(cases).collect():
            found[r["column"]].append((r["before_n"] + bases[r["column"]], r["n"], r["value"]))
        return {
            c: sum(value for rank in ranks[c] for first, n, value in rows if first <= rank < first + n) / 2.0
            for c, rows in found.items()
        }

    def merged(self) -> PrepState:
        """The state that fitting on the rows of all deliveries gives."""
        counts = self._read("categories").groupBy("column", "category").agg(F.sum("rows").alias("rows"))
        return state_of(self.numericals(), counts, self.spec)
