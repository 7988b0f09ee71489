"""Running totals over groups of any size, without putting a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from churnflow.functions.cells import cell
from churnflow.sources.tables import stored

_PART = "__part"


def running_totals(df: DataFrame, by: str, order: str, measures: Sequence[str]) -> DataFrame:
    """``df`` with ``before_<measure>``: the sum over rows of the same ``by`` that come earlier in ``order``.

    Rows are dealt to ranges of (by, order), whose number follows the session's shuffle partitions. Totals run inside each
    range, and each range adds what the ranges before it hold, from a table of one row per range.
    Rows equal in both columns have to be one row.
    """
    ranged = df.repartitionByRange(cell(by), cell(order)).withColumn(_PART, F.spark_partition_id())
    dealt = stored(ranged, "ranges")
    earlier = Window.partitionBy(by).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(by, _PART).agg(*[F.sum(m).alias(m) for m in measures])
    bases = sums.select(by, _PART, *[F.coalesce(F.sum(m).over(earlier), F.lit(0)).alias(f"__base_{m}") for m in measures])
    inside = Window.partitionBy(by, _PART).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    within = dealt.withColumns({f"__in_{m}": F.coalesce(F.sum(m).over(inside), F.lit(0)) for m in measures})
    totals = [(F.col(f"__base_{m}") + F.col(f"__in_{m}")).alias(f"before_{m}") for m in measures]
    return within.join(F.broadcast(bases), [by, _PART]).select(*[cell(c) for c in df.columns], *totals)
