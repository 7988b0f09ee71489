"""Dataset validation: one report over all checks, and a fail-fast form that raises.

The checks and their order:

V1 rows exist, V2 required columns, V3 no other columns, V4 unique ids, V5 no missing cells,
V6 no blank cells (V13: counted but allowed in some columns), V7 known categories, V8 numbers
parse, V9 domains, V10 and later: minimums, one check per limited column.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from churnflow.functions.cells import (
    cell, is_missing, is_text, literal, number, parsed_number, stacked, stripped, with_parsed,
)
from churnflow.spec import DatasetSpec

# Error texts name at most this many offending values; ``unexpected_categories`` has them all.
_NAMED_VALUES = 20
_REPORT = ("position", "check", "column", "violations", "allowed")


@dataclass(frozen=True)
class _CellCheck:
    code: str
    column: str
    violated: Column
    allowed: bool = False


def duplicate_ids(df: DataFrame, *keys: str) -> DataFrame:
    """One row: rows beyond the first of each key; null keys are equal to each other."""
    return (
        df.groupBy(*[cell(k) for k in keys])
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))
    )


def negative_values(df: DataFrame, *columns: str) -> DataFrame:
    """One row per column: how many values are below zero."""
    counts = df.agg(*[F.count_if(number(df, c) < 0).alias(f"c{i}") for i, c in enumerate(columns)])
    return counts.select(
        stacked(("column", "violations"), [(literal(c), f"c{i}") for i, c in enumerate(columns)])
    )


def unexpected_categories(df: DataFrame, categories) -> DataFrame:
    """(column, value, rows) for every trimmed, non-null value outside its allowed set."""
    # No filter on the whole rows: pushed into a deep view, a disjunction over this many columns
    # would cost the optimizer more than it saves.
    lines = F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.when(_unexpected(c, allowed), stripped(cell(c))).alias("value")
        )
        for c, allowed in categories.items()
    ])
    return (
        df.select(F.inline(lines))
        .where("value is not null")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def missing_columns(df: DataFrame, spec: DatasetSpec) -> list[str]:
    return [c for c in spec.columns if c not in df.columns]


def unexpected_columns(df: DataFrame, spec: DatasetSpec) -> list[str]:
    return [c for c in df.columns if c not in spec.columns]


# Both tests below use CASE, not AND: its branches are only evaluated when reached, so that cells
# that match a category as they are never get trimmed.


def _unexpected(column: str, allowed) -> Column:
    """A non-null cell outside its allowed set, with or without white space around it."""
    value = cell(column).cast("string")
    return F.when(value.isNull() | value.isin(*allowed), False).otherwise(~stripped(value).isin(*allowed))


def _blank(column: str, spec: DatasetSpec) -> Column:
    """A cell of white space only."""
    value = cell(column).cast("string")
    blank = stripped(value) == ""
    allowed = spec.categories.get(column)
    return F.when(value.isin(*allowed), False).otherwise(blank) if allowed else blank


def _cell_checks(df: DataFrame, spec: DatasetSpec) -> tuple[DataFrame, list[_CellCheck]]:
    """The frame to check, and the checks of single cells, in order, for the columns there are."""
    here = set(df.columns)
    wide, parsed = with_parsed(df, [c for c in spec.numericals if c in here])
    checks = [_CellCheck("V5", c, is_missing(df, c)) for c in df.columns]
    checks += [
        _CellCheck("V13" if c in spec.blank_allowed else "V6", c, _blank(c, spec), c in spec.blank_allowed)
        for c in df.columns
        if is_text(df, c)
    ]
    checks += [
        _CellCheck("V7", c, _unexpected(c, allowed)) for c, allowed in spec.categories.items() if c in here
    ]
    for c, value in parsed.items():
        wrong = cell(c).isNotNull() & value.isNull()
        if c in spec.blank_allowed:
            # A column that may be blank is coerced, so there even "nan" is no number; elsewhere
            # a missing-value text is for V5 to find.
            wrong = cell(c).isNotNull() & (value.isNull() | F.isnan(value)) & ~_blank(c, spec)
        checks.append(_CellCheck("V8", c, wrong))
    checks += [
        _CellCheck("V9", c, ~parsed[c].isin(*domain)) for c, domain in spec.domains.items() if c in here
    ]
    checks += [
        _CellCheck(f"V{10 + i}", c, parsed[c] < least)
        for i, (c, least) in enumerate(spec.minimums.items())
        if c in here
    ]
    return wide, checks


def validation_report(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """One row per check and column: position, check, column, violations, status.

    Every check on single cells is part of one aggregation over the table; only the uniqueness
    of ids needs a shuffle. Status is passed, failed, or allowed (blank cells where permitted).
    """
    wide, checks = _cell_checks(df, spec)
    absent, extra = missing_columns(df, spec), unexpected_columns(df, spec)
    lines = [("V1", "", "IF(n = 0, 1L, 0L)", False)]
    lines += [("V2", c, "1L", False) for c in absent] + [("V3", c, "1L", False) for c in extra]
    id_position = len(lines) + 1  # the check of ids comes next, from an aggregation of its own
    lines += [(check.code, check.column, f"k{i}", check.allowed) for i, check in enumerate(checks)]
    report = wide.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if(check.violated).alias(f"k{i}") for i, check in enumerate(checks)],
    ).select(
        stacked(_REPORT, [
            (literal(i if i < id_position else i + 1), literal(code), literal(column), count, literal(allowed))
            for i, (code, column, count, allowed) in enumerate(lines, start=1)
        ])
    )
    if spec.id_column in df.columns:
        line = (literal(id_position), "'V4'", literal(spec.id_column), "duplicates", "false")
        report = report.unionByName(duplicate_ids(df, spec.id_column).select(stacked(_REPORT, [line])))
    status = F.when(F.col("violations") == 0, "passed").when(F.col("allowed"), "allowed").otherwise("failed")
    return report.withColumn("status", status).drop("allowed")


def validate(df: DataFrame, spec: DatasetSpec) -> bool:
    """True if every check holds; ValueError with the first failing check otherwise."""
    if not df.columns or df.isEmpty():
        raise ValueError("Dataset is empty.")
    absent = missing_columns(df, spec)
    if absent:
        raise ValueError(f"Missing required columns: {absent}")
    extra = unexpected_columns(df, spec)
    if extra:
        raise ValueError(f"Unexpected columns found: {extra}")
    failed = sorted(
        validation_report(df, spec).where(F.col("status") == "failed").collect(),
        key=lambda r: r["position"],
    )
    if failed:
        raise ValueError(_failure_text(df, spec, failed))
    return True


def _failure_text(df: DataFrame, spec: DatasetSpec, failed: list[Row]) -> str:
    # The wording of the errors, which callers match on.
    code, column = failed[0]["check"], failed[0]["column"]
    same = {r["column"]: r["violations"] for r in failed if r["check"] == code}
    if code == "V4":
        return f"Found {same[column]} duplicate customer IDs."
    if code == "V5":
        return f"Missing values found: {same}"
    if code == "V6":
        return f"Unexpected blank values found: {sorted(same)}"
    if code == "V7":
        values = _named(unexpected_categories(df, {column: spec.categories[column]}).select("value"))
        return f"Unexpected categories in '{column}': {values}"
    if code == "V8":
        kind = "invalid numerical" if column in spec.blank_allowed else "non-numerical"
        return f"Column '{column}' contains {kind} values."
    if code == "V9":
        value = parsed_number(df, column)
        outside = df.where(~value.isin(*spec.domains[column])).select(value.alias("value")).distinct()
        return f"Invalid {column} values: {_named(outside)}"
    return f"Negative {column} values found."


def _named(values: DataFrame) -> str:
    first = [r[0] for r in values.orderBy("value").limit(_NAMED_VALUES + 1).collect()]
    text = ", ".join(repr(v) for v in first[:_NAMED_VALUES])
    more = values.count() - _NAMED_VALUES if len(first) > _NAMED_VALUES else 0
    return "{" + text + (f", ... and {more} more" if more else "") + "}"
