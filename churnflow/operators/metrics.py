"""Binary classification metrics as aggregates over (label, score) rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from churnflow.functions.cells import cell, literal, stacked
from churnflow.functions.ordered import place_among

METRICS = ("accuracy", "precision", "recall", "f1_score", "roc_auc")


def predicted_class(score: Column) -> Column:
    """1 if the positive class is more likely than not; exactly 0.5 is class 0."""
    return (score > 0.5).cast("int")


def _known(label: Column, score: Column) -> Column:
    """The score as a double; a missing label or score fails the job, whatever is computed from it."""
    value = score.cast("double")
    missing = label.isNull() | value.isNull() | F.isnan(value)
    # Adding 0.0 makes -0.0 and 0.0 the same score.
    return F.when(missing, F.raise_error(F.lit("label or score is missing")).cast("double")).otherwise(value + F.lit(0.0))


def confusion_counts(df: DataFrame, label: str, score: str, *by: str) -> DataFrame:
    """tp, fp, fn and tn, per group of ``by`` if given. Labels and scores must not be missing."""
    outcome = F.struct(
        (predicted_class(_known(cell(label), cell(score))) == 1).alias("hit"), (cell(label) == 1).alias("positive")
    )
    judged = df.select(*[cell(c) for c in by], outcome.alias("__outcome"))
    hit, positive = F.col("__outcome.hit"), F.col("__outcome.positive")
    return judged.groupBy(*[cell(c) for c in by]).agg(
        F.count_if(hit & positive).alias("tp"),
        F.count_if(hit & ~positive).alias("fp"),
        F.count_if(~hit & positive).alias("fn"),
        F.count_if(~hit & ~positive).alias("tn"),
    )


def _ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as double, and 0 where the denominator is 0."""
    return F.when(bottom == 0, F.lit(0.0)).otherwise(top.cast("double") / bottom.cast("double"))


def threshold_metrics() -> dict[str, Column]:
    """Accuracy, precision, recall and F1 over columns tp, fp, fn and tn."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    return {
        "accuracy": _ratio(tp + tn, tp + fp + fn + tn),
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
        "f1_score": _ratio(2 * tp, 2 * tp + fp + fn),
    }


def _checked(df: DataFrame, label: str, scores: Mapping[str, str]) -> DataFrame:
    """``label`` and a column s0, s1, ... for each score; a missing one fails the job."""
    return df.select(
        cell(label).cast("int").alias("label"), *[_known(cell(label), cell(c)).alias(f"s{i}") for i, c in enumerate(scores.values())]
    )


def _label_counts(rows: DataFrame, *by: str) -> DataFrame:
    return rows.groupBy(*by).agg(F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") != 1).alias("neg"))


def _ranges(df: DataFrame, names: Sequence[str]) -> dict[str, list[float]]:
    """Per score column, what cuts its values into about as many ranges of equal weight as the session has shuffle partitions."""
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / parts for i in range(1, parts)]
    found = df.agg(*[F.percentile_approx(n, shares, 50 * parts).alias(n) for n in names]).first()
    return {n: found[n] or [] for n in names}


def classification_metrics(df: DataFrame, label: str, scores: Mapping[str, str]) -> DataFrame:
    """One row per model: n, tp, fp, fn, tn, accuracy, precision, recall, f1_score, roc_auc.

    ROC AUC is the exact rank statistic (ties count half; null if a class is absent). Labels are counted per distinct
    score, map-side first; ranks are running totals inside ranges of scores, whose edges are sketched, and each range adds
    what the ones before it hold, from one row each. Twice the pairs won is a whole number, so that sums are exact in any order.
    """
    checked = _checked(df, label, scores)
    names = list(scores)
    edges = _ranges(checked, [f"s{i}" for i in range(len(names))])
    lines = [(literal(model), f"s{i}", f"r{i}") for i, model in enumerate(names)]
    ranged = checked.withColumns({f"r{i}": place_among(F.col(f"s{i}"), edges[f"s{i}"]) for i in range(len(names))})
    counted = _label_counts(ranged.select("label", stacked(("model", "score", "range"), lines)), "model", "range", "score")

    def hits(measure: str) -> Column:
        return F.sum(F.when(predicted_class(F.col("score")) == 1, F.col(measure)).otherwise(0))

    def whole(column: Column) -> Column:
        return column.cast("decimal(18,0)")

    inside = Window.partitionBy("model", "range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    won = whole(F.col("pos")) * (2 * F.coalesce(F.sum("neg").over(inside), F.lit(0)) + F.col("neg")).cast("decimal(19,0)")
    per_range = counted.withColumn("won", won).groupBy("model", "range").agg(
        F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("won").alias("won"), hits("pos").alias("tp"), hits("neg").alias("fp"))
    # A row per range.
    earlier = Window.partitionBy("model").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    below = whole(F.col("pos")) * (2 * F.coalesce(F.sum("neg").over(earlier), F.lit(0))).cast("decimal(19,0)")
    pairs = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    counts = per_range.withColumn("won", F.col("won") + below).groupBy("model").agg(
        F.sum("tp").alias("tp"),
        F.sum("fp").alias("fp"),
        (F.sum("pos") - F.sum("tp")).alias("fn"),
        (F.sum("neg") - F.sum("fp")).alias("tn"),
        F.when(pairs > 0, F.sum("won").cast("double") / (2.0 * pairs)).alias("roc_auc"),
    )
    return counts.select(
        "model",
        (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n"),
        "tp", "fp", "fn", "tn",
        *[expression.alias(name) for name, expression in threshold_metrics().items()],
        "roc_auc",
    )


def evaluation_record(metrics: DataFrame, candidate: str = "candidate", production: str = "production") -> DataFrame:
    """One row: both metric sets, the difference in F1, and whether the candidate is better."""

    def of(model: str) -> Column:
        found = F.when(F.col("model") == model, F.struct(*METRICS))
        return F.first(found, ignorenulls=True)

    both = metrics.agg(of(candidate).alias("candidate_metrics"), of(production).alias("production_metrics"))
    return both.withColumns({
        "f1_improvement": F.col("candidate_metrics.f1_score") - F.col("production_metrics.f1_score"),
        "candidate_better": F.col("candidate_metrics.f1_score") > F.col("production_metrics.f1_score"),
    })
