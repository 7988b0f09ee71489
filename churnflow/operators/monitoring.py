"""Monitoring queries over the prediction log: totals, rates, histograms and quantiles.

Windowed queries first count per slide (a tumbling window); a sliding window is the sum of the
slides it covers. All measures are additive, histogram buckets included, so the log itself is
never multiplied by the number of overlapping windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnflow.functions.cells import literal, quoted, stacked
from churnflow.operators.scoring import FAILED, INVALID, OK
from churnflow.sources.tables import stored

# Upper bounds of the latency (seconds) and probability buckets.
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
PROBABILITY_BOUNDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
# Keeps the ratio of two rates defined in an idle window; in units per second.
_IDLE = 1e-9


def _is(status: int) -> Column:
    return F.col("status") == status


def results_label() -> Column:
    """Label of a successful prediction, derived from its probability."""
    return F.when(_is(OK) & (F.col("probability") > 0.5), "Yes").when(
        _is(OK) & F.col("probability").isNotNull(), "No"
    )


def log_totals(log: DataFrame) -> DataFrame:
    """One row: requests, successful, failed, predicted churn and non-churn, results in total."""
    return log.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(_is(OK)).alias("successful"),
        F.count_if(_is(INVALID) | _is(FAILED)).alias("failed"),
        F.count_if(results_label() == "Yes").alias("churn"),
        F.count_if(results_label() == "No").alias("non_churn"),
        F.count(results_label()).alias("results"),
    )


def results_by_label(log: DataFrame) -> DataFrame:
    """Predictions per label, and their sum under the name ``total``."""
    return (
        log.select(results_label().alias("churn"))
        .where("churn is not null")
        .rollup("churn")
        .agg(F.count(F.lit(1)).alias("predictions"), F.grouping("churn").alias("whole"))
        .select(F.when(F.col("whole") == 1, "total").otherwise(F.col("churn")).alias("churn"), "predictions")
    )


def bucket_counts(value: str, bounds: Sequence[float], prefix: str) -> dict[str, Column]:
    """Cumulative bucket counters: per upper bound, how many values are not above it."""
    return {f"{prefix}{i}": F.count_if(F.col(value) <= le) for i, le in enumerate(bounds)}


def measures() -> dict[str, Column]:
    """All additive measures of a stretch of the log."""
    totals = (
        F.count(F.lit(1)),
        F.count_if(_is(OK)),
        F.count_if(_is(INVALID) | _is(FAILED)),
        F.coalesce(F.sum("latency_seconds"), F.lit(0.0)),
        F.count("latency_seconds"),
        F.count("probability"),
    )
    return {
        **dict(zip(_TOTALS, totals, strict=True)),
        **bucket_counts("latency_seconds", LATENCY_BOUNDS, "latency_le_"),
        **bucket_counts("probability", PROBABILITY_BOUNDS, "probability_le_"),
    }


_TOTALS = ("requests", "successful", "failed", "latency_sum", "latency_count", "probability_count")
MEASURES = (
    *_TOTALS,
    *[f"latency_le_{i}" for i in range(len(LATENCY_BOUNDS))],
    *[f"probability_le_{i}" for i in range(len(PROBABILITY_BOUNDS))],
)


def summed() -> list[Column]:
    """The measures of several stretches of the log added up."""
    return [F.sum(name).alias(name) for name in MEASURES]


def histogram(log: DataFrame, value: str, bounds: Sequence[float], *by: str) -> DataFrame:
    """(by..., le, cumulative, sum, count): one row per upper bound, and one for ``+Inf``.

    ``sum`` and ``count`` are those of all values and are repeated in every row.
    """
    counted = log.groupBy(*by).agg(
        F.sum(value).alias("sum"),
        F.count(value).alias("count"),
        *[c.alias(n) for n, c in bucket_counts(value, bounds, "b").items()],
    )
    lines = [(literal(str(le)), f"b{i}") for i, le in enumerate(bounds)] + [("'+Inf'", "`count`")]
    return counted.select(*by, stacked(("le", "cumulative"), lines), "sum", "count")


def merge_histograms(histograms: DataFrame) -> DataFrame:
    """Buckets, sums and counts of all series added up, per upper bound."""
    return histograms.groupBy("le").agg(*[F.sum(c).alias(c) for c in ("cumulative", "sum", "count")])


def histogram_quantile(q: float, bounds: Sequence[float], cumulative: Sequence[Column], total: Column) -> Column:
    """The q-quantile of a histogram by linear interpolation inside the bucket it falls into.

    Null without values; the last bound if the quantile lies above all bounds; a first bound of
    zero or below is returned as it is, since that bucket has no lower end.
    """
    rank = F.lit(q) * total.cast("double")
    value = F.when(total == 0, F.lit(None).cast("double"))
    lower, below = 0.0, F.lit(0.0)
    for i, (le, n) in enumerate(zip(bounds, cumulative, strict=True)):
        count = n.cast("double")
        if i == 0 and le <= 0:
            inside = F.lit(le)
        else:
            inside = F.lit(lower) + F.lit(le - lower) * (rank - below) / (count - below)
        value = value.when(count >= rank, inside)
        lower, below = le, count
    return value.otherwise(F.lit(bounds[-1]))


def dashboard_columns(seconds: int) -> dict[str, Column]:
    """The dashboard's values over the measures of one window of ``seconds`` length."""

    def rate(name: str) -> Column:
        return F.col(name).cast("double") / float(seconds)

    def quantile(prefix: str, bounds: Sequence[float]) -> Column:
        buckets = [F.col(f"{prefix}_le_{i}") for i in range(len(bounds))]
        return histogram_quantile(0.95, bounds, buckets, F.col(f"{prefix}_count"))

    return {
        "request_rate": rate("requests"),
        "error_rate": 100.0 * rate("failed") / (rate("requests") + _IDLE),
        "success_rate": 100.0 * rate("successful") / (rate("requests") + _IDLE),
        "avg_latency": rate("latency_sum") / (rate("latency_count") + _IDLE),
        "p95_latency": quantile("latency", LATENCY_BOUNDS),
        "p95_probability": quantile("probability", PROBABILITY_BOUNDS),
    }


def with_dashboard(windows: DataFrame, seconds: int) -> DataFrame:
    """Window bounds and the dashboard's values, over columns window_start and the measures."""
    return windows.select(
        "window_start",
        (F.col("window_start") + F.make_dt_interval(secs=F.lit(seconds))).alias("window_end"),
        *[c.alias(name) for name, c in dashboard_columns(seconds).items()],
    )


def window_measures(log: DataFrame, seconds: int = 300, slide: int = 60, grid: bool = True) -> DataFrame:
    """All measures per window [start, start + seconds), a window every ``slide`` seconds.

    With ``grid``, every window between the first and the last is there, idle ones with zeros; the grid is a
    distributed range that grows with the time covered. The log is read once; the counts per slide are stored.
    """
    if seconds % slide:
        raise ValueError("the window length has to be a multiple of the slide")
    log = log.withColumn("ts", F.col("ts").cast("timestamp"))
    slides = per_slide(log, slide)
    if grid:
        slides = stored(slides, "slides")
        first, last = slides.agg(*[F.unix_seconds(f("slide_start")) for f in (F.min, F.max)]).first()
        if first is not None:
            empty = log.sparkSession.range(first, last + 1, slide).select(
                F.timestamp_seconds("id").alias("slide_start"), *[F.lit(0.0 if n == "latency_sum" else 0).alias(n) for n in MEASURES]
            )
            slides = slides.unionByName(empty)
    return sliding(slides, seconds, slide)


def per_slide(log: DataFrame, slide: int) -> DataFrame:
    """All measures per slide [slide_start, slide_start + slide)."""
    return log.groupBy(F.window("ts", f"{slide} seconds").start.alias("slide_start")).agg(
        *[c.alias(n) for n, c in measures().items()]
    )


def sliding(slides: DataFrame, seconds: int, slide: int) -> DataFrame:
    """All measures per window, added up from rows per slide, of which a slide may have several."""
    covering = F.sequence(
        F.col("slide_start") - F.make_dt_interval(secs=F.lit(seconds - slide)),
        F.col("slide_start"),
        F.make_dt_interval(secs=F.lit(slide)),
    )
    return (
        slides.withColumn("window_start", F.explode(covering))
        .groupBy("window_start")
        .agg(*summed())
    )


def dashboard(log: DataFrame, seconds: int = 300, slide: int = 60, grid: bool = True) -> DataFrame:
    """Request, error and success rate, average and P95 latency, P95 probability per window."""
    return with_dashboard(window_measures(log, seconds, slide, grid), seconds)


def last_values(windows: DataFrame, at: str, series: Sequence[str]) -> DataFrame:
    """(series, value): the latest non-null value of each column."""
    latest = windows.agg(*[
        F.max_by(name, F.when(F.col(name).isNotNull(), F.col(at))).alias(name) for name in series
    ])
    return latest.select(
        stacked(("series", "value"), [(literal(name), f"CAST({quoted(name)} AS DOUBLE)") for name in series])
    )
