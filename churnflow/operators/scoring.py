"""Scoring requests: row rules, quarantine, probabilities, responses and the prediction log.

All operators are projections and filters, so they take batch and streaming frames alike.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from churnflow.functions.cells import cell, is_text, number, with_parsed
from churnflow.operators.features import PrepState
from churnflow.operators.metrics import predicted_class
from churnflow.operators.training import scored
from churnflow.spec import DatasetSpec

OK, INVALID, FAILED = 200, 422, 500
_ERRORS = "array<struct<field: string, rule: string>>"


def _number_error(spec: DatasetSpec, name: str, value: Column) -> Column:
    """The broken rule of a given, non-null number: type, value or minimum."""
    wrong_type = value.isNull()
    if name in spec.integers:
        wrong_type = wrong_type | F.isnan(value) | (F.abs(value) == math.inf) | (value != F.floor(value))
    rule = F.when(wrong_type, "type")
    if name in spec.domains:
        rule = rule.when(~value.isin(*spec.domains[name]), "value")
    if name in spec.minimums:
        # Spark orders NaN above every number, but it is not at least the minimum.
        rule = rule.when(F.isnan(value) | (value < spec.minimums[name]), "minimum")
    return rule


def _field_error(df: DataFrame, spec: DatasetSpec, name: str, parsed: Mapping[str, Column]) -> Column:
    """The broken rule of one field (missing, type, value or minimum), or null."""
    absent = F.lit(None).cast("string") if name in spec.optional_in_request else F.lit("missing")
    if name not in df.columns:
        return absent
    rule = F.when(cell(name).isNull(), absent)
    if name in parsed:
        return rule.otherwise(_number_error(spec, name, parsed[name]))
    if name in spec.categories:
        return rule.when(~cell(name).cast("string").isin(*spec.categories[name]), "value")
    return rule if is_text(df, name) else rule.otherwise("type")


def with_request_errors(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Adds ``errors``, an array of (field, rule); empty for a valid request.

    Categories must match exactly: requests are not trimmed, unlike in dataset validation.
    """
    wide, parsed = with_parsed(df, [c for c in spec.numericals if c in df.columns])
    names = {c: f"__rule_{c}" for c in spec.columns if c != spec.target}
    judged = wide.withColumns({n: _field_error(df, spec, c, parsed) for c, n in names.items()})
    # Valid requests, usually nearly all of them, never build the list.
    any_broken = F.coalesce(*[cell(n) for n in names.values()]).isNotNull()
    all_fields = F.array(*[F.struct(F.lit(c).alias("field"), cell(n).alias("rule")) for c, n in names.items()])
    broken = F.filter(all_fields, lambda e: e["rule"].isNotNull())
    errors = F.when(any_broken, broken).otherwise(F.array().cast(_ERRORS))
    return judged.withColumn("errors", errors).select(*[cell(c) for c in df.columns], "errors")


def with_part(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """All requests with their errors and ``part``, valid or rejected: one pass serves both parts, as when
    a table is written partitioned by it."""
    part = F.when(F.size("errors") == 0, "valid").otherwise("rejected")
    return with_request_errors(df, spec).withColumn("part", part)


def quarantine(df: DataFrame, spec: DatasetSpec) -> tuple[DataFrame, DataFrame]:
    """(valid requests, refused requests with their errors), each judged when it is read; see ``with_part``."""
    checked = with_part(df, spec)
    return (
        checked.where(F.col("part") == "valid").drop("errors", "part"),
        checked.where(F.col("part") == "rejected").drop("part"),
    )


def error_counts(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Requests per field and broken rule."""
    return (
        with_request_errors(df, spec)
        .select(F.inline("errors"))
        .groupBy("field", "rule")
        .agg(F.count(F.lit(1)).alias("requests"))
    )


def score_requests(df: DataFrame, state: PrepState, spec: DatasetSpec, model) -> DataFrame:
    """All requests with ``status`` and, where the status is 200, ``probability``.

    422: a rule is broken. 500: valid, but a numerical value is infinite, which preparation
    refuses. Every other request is prepared with the saved state and scored.
    """
    checked = with_request_errors(df, spec)
    infinite = F.lit(False)
    for c in spec.numericals:
        if c in df.columns:
            infinite = infinite | F.coalesce(F.abs(number(df, c)) == math.inf, F.lit(False))
    status = F.when(F.size("errors") > 0, INVALID).when(infinite, FAILED).otherwise(OK)
    rows = checked.withColumn("status", status)
    absent = [c for c in spec.optional_in_request if c not in rows.columns]
    filled = rows.withColumns({c: F.lit(None).cast("double") for c in absent})
    features = [
        F.coalesce(F.when(F.col("status") == OK, f), F.lit(0.0)).alias(name)
        for f, name in zip(state.features(filled, spec), state.feature_names, strict=True)
    ]
    wide = filled.select("*", *features)
    result = scored(model, wide, "probability")
    probability = F.when(F.col("status") == OK, F.col("probability"))
    return result.withColumn("probability", probability).select(*rows.columns, "probability")


def label_of(probability: Column, spec: DatasetSpec) -> Column:
    """The label a probability stands for; null stays null."""
    return F.when(predicted_class(probability) == 1, spec.positive).when(
        probability.isNotNull(), spec.negative
    )


def responses(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Id, class, label and probability rounded to 4 digits of every scored request."""
    probability, name = F.col("probability"), spec.target.lower()
    return df.where(probability.isNotNull()).select(
        cell(spec.id_column),
        predicted_class(probability).alias("prediction"),
        label_of(probability, spec).alias(name),
        F.round(probability, 4).alias(f"{name}_probability"),
    )


def prediction_log(df: DataFrame, spec: DatasetSpec, request_id: Column, ts: Column, latency: Column) -> DataFrame:
    """One row per request: the source of all monitoring queries.

    Every request counts, valid or not. Refused requests have no latency; failed ones have a
    latency but no probability; the probability is kept unrounded.
    """
    return df.select(
        request_id.alias("request_id"),
        ts.alias("ts"),
        cell(spec.id_column),
        "status",
        F.when(F.col("status") != INVALID, latency).alias("latency_seconds"),
        label_of(F.col("probability"), spec).alias("label"),
        "probability",
    )
