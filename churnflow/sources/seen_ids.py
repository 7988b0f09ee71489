"""An index of the ids of earlier deliveries, which a new delivery is checked against without moving the index.

Ids are kept in files dealt to buckets by their hash and sorted, each id once. A new delivery's ids are dealt the same way, so
that every bucket meets its own: the work and the shuffle follow the delivery, not what has been seen before.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnflow.functions.cells import cell

BUCKETS = 64


@dataclass(frozen=True)
class SeenIds:
    """The index below a folder. Its number of buckets is that of its first delivery."""

    spark: SparkSession
    folder: str
    buckets: int = BUCKETS

    @property
    def _name(self) -> str:
        return f"seen_ids_{hashlib.md5(self.folder.encode()).hexdigest()}"

    def _table(self) -> DataFrame:
        """The files as a bucketed table of this session's catalog, which needn't know it yet."""
        if not self.spark.catalog.tableExists(self._name):
            location = self.folder.replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {self._name} (id STRING, delivery STRING) USING parquet "
                f"CLUSTERED BY (id) SORTED BY (id) INTO {self.buckets} BUCKETS LOCATION '{location}'")
        return self.spark.table(self._name)

    def _new(self, df: DataFrame, id_column: str) -> DataFrame:
        """(id, rows) of a delivery, dealt like the index; a missing id is an id of its own."""
        value = cell(id_column).cast("string")
        key = F.when(value.isNull(), "").otherwise(F.concat(F.lit("="), value))
        return df.select(key.alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("rows")).repartition(self.buckets, "id")

    def judged(self, df: DataFrame, id_column: str) -> DataFrame:
        """(id, rows, first): how often a delivery has each id, and the delivery that had it first, null if none did.

        The index is neither shuffled nor broadcast.
        """
        earlier = self._table().withColumnRenamed("delivery", "first")
        found = self._new(df, id_column).hint("merge").join(earlier, "id", "left")
        value = F.when(F.col("id") != "", F.substring("id", 2, 2147483647))
        return found.select(value.alias("id"), "rows", "first")

    def counts(self, df: DataFrame, id_column: str) -> DataFrame:
        """One row: ``rows``, ``duplicates`` (rows beyond the first of their id, in this delivery or before), ``seen_before`` (rows
        whose id an earlier delivery had)."""
        seen = F.col("first").isNotNull()
        return self.judged(df, id_column).agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum(F.when(seen, F.col("rows")).otherwise(F.col("rows") - 1)), F.lit(0)).alias("duplicates"),
            F.coalesce(F.sum(F.when(seen, F.col("rows"))), F.lit(0)).alias("seen_before"))

    def add(self, df: DataFrame, id_column: str, delivery: str) -> None:
        """Adds the ids that no delivery had; adding a delivery again adds nothing."""
        table = self._table()
        fresh = self._new(df, id_column).hint("merge").join(table, "id", "left_anti").select("id", F.lit(delivery).alias("delivery"))
        (
            fresh.write.format("parquet").mode("append").bucketBy(self.buckets, "id").sortBy("id")
            .option("path", self.folder).saveAsTable(self._name)
        )
        self.spark.catalog.refreshTable(self._name)
