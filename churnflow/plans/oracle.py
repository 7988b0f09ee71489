"""Reference answers: for each registered query, plain SQL over the same tables.

The SQL states what the answer is, in the most direct way, without the splitting into ranges and
slides that the Spark operators use.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence

from churnflow.sources.views import view_sql
from churnflow.spec import telecom_spec

SPEC = telecom_spec()
# Fixed values, stated here once more so that a wrong constant of the engine shows.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
METRICS = ("accuracy", "precision", "recall", "f1_score", "roc_auc")
LATENCY_BOUNDS = (0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0)
PROBABILITY_BOUNDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
LINEITEM_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
ORACLE: dict[str, str] = {}

_SPACES = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"


def answer(sql: Callable[[], str]) -> Callable[[], str]:
    ORACLE[sql.__name__] = sql().strip()
    return sql


def _with(views: Sequence[str], body: str, **ctes: str) -> str:
    parts = [f"{v} AS ({view_sql(v)})" for v in views] + [f"{name} AS ({sql})" for name, sql in ctes.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


def _subscribers(body: str, **ctes: str) -> str:
    return _with(["subscribers"], body, **ctes)


def _dirty(body: str, **ctes: str) -> str:
    return _with(["subscribers", "subscribers_dirty"], body, **ctes)


def _log(body: str, **ctes: str) -> str:
    return _with(["prediction_log"], body, **ctes)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values: Sequence) -> str:
    return "(" + ", ".join(_text(v) if isinstance(v, str) else repr(v) for v in values) + ")"


def _trim(column: str) -> str:
    return f"trim({column}, {_SPACES})"


def _parsed(column: str) -> str:
    return f"TRY_CAST({_trim(f'CAST({column} AS VARCHAR)')} AS DOUBLE)"


def _number(column: str) -> str:
    return f"nullif({_parsed(column)}, CAST('nan' AS DOUBLE))"


# Sources and profiling


@answer
def csv_scan():
    cells = ", ".join(
        f"CASE WHEN CAST({c} AS VARCHAR) NOT IN {_list(NA_TOKENS)} THEN CAST({c} AS VARCHAR) END AS {c}"
        for c in SPEC.columns
    )
    return _dirty(f"SELECT {cells} FROM subscribers_dirty")


@answer
def csv_columns_by_name():
    return (
        "SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_mktsegment FROM customer")


@answer
def csv_line_breaks():
    return """
    SELECT CAST(c_custkey AS VARCHAR) AS c_custkey,
      c_name || chr(10) || '"quoted", ' || c_mktsegment || CASE WHEN c_custkey % 2 = 0 THEN chr(10) || chr(10) || ',' ELSE '' END AS note,
      CASE WHEN c_custkey % 3 > 0 THEN c_mktsegment END AS segment
    FROM customer"""


@answer
def profile_stored():
    return _dirty(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM subscribers_dirty" for c in SPEC.columns
    ) + " UNION ALL SELECT NULL, count(*) FROM subscribers_dirty")


@answer
def profile_shape():
    return _subscribers(f"SELECT count(*) AS n_rows, CAST({len(SPEC.columns)} AS BIGINT) AS n_columns FROM subscribers")


@answer
def profile_columns():
    # The columns of the line item table and their types.
    columns = (
        ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"), ("l_linenumber", "int"),
        ("l_quantity", "double"), ("l_extendedprice", "double"), ("l_discount", "double"), ("l_tax", "double"),
        ("l_returnflag", "string"), ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz"),
    )
    return " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS \"column\", '{kind}' AS type, "
        f"count(*) - count({c}) AS missing, count({c}) AS filled FROM lineitem"
        for i, (c, kind) in enumerate(columns, start=1)
    )


@answer
def profile_missing():
    return _dirty(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing FROM subscribers_dirty" for c in SPEC.columns
    ))


@answer
def profile_head():
    return _subscribers("SELECT * FROM subscribers ORDER BY customerID LIMIT 5")


@answer
def profile_class_counts():
    return _subscribers("SELECT Churn AS value, count(*) AS count FROM subscribers GROUP BY Churn")


@answer
def profile_class_share():
    return _subscribers(
        "SELECT Churn AS value, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM subscribers), 9) AS percent "
        "FROM subscribers GROUP BY Churn"
    )


@answer
def profile_value_counts():
    return "SELECT l_returnflag AS value, count(*) AS count FROM lineitem GROUP BY l_returnflag"


# Validation


def _report(source: str, texts: set[str]) -> str:
    """The report as one SELECT per line; ``texts`` names the text columns of the source."""

    def where(condition: str) -> str:
        return f"(SELECT count(*) FROM {source} WHERE {condition})"

    lines = [("V1", "", f"(SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM {source})")]
    lines.append(("V4", "customerID", f"(SELECT coalesce(sum(n - 1), 0) FROM "
                                      f"(SELECT count(*) AS n FROM {source} GROUP BY customerID))"))
    lines += [("V5", c, where(f"{c} IS NULL")) for c in SPEC.columns]
    lines += [
        ("V13" if c == "TotalCharges" else "V6", c, where(f"{_trim(c)} = ''")) for c in SPEC.columns if c in texts
    ]
    lines += [("V7", c, where(f"{_trim(c)} NOT IN {_list(words)}")) for c, words in SPEC.categories.items()]
    for c in SPEC.numericals:
        if c == "TotalCharges":
            lines.append(("V8", c, where(f"{_trim(c)} <> '' AND {_number(c)} IS NULL")))
        else:
            lines.append(("V8", c, where(f"{c} IS NOT NULL AND {_parsed(c)} IS NULL")))
    lines.append(("V9", "SeniorCitizen", where(f"{_parsed('SeniorCitizen')} NOT IN (0, 1)")))
    lines += [
        (f"V{10 + i}", c, where(f"{_number(c)} < 0"))
        for i, c in enumerate(("tenure", "MonthlyCharges", "TotalCharges"))
    ]
    selects = " UNION ALL ".join(
        f"SELECT CAST({i} AS BIGINT) AS position, '{code}' AS \"check\", '{c}' AS \"column\", "
        f"CAST({count} AS BIGINT) AS violations"
        for i, (code, c, count) in enumerate(lines, start=1)
    )
    return (
        "SELECT *, CASE WHEN violations = 0 THEN 'passed' WHEN \"check\" = 'V13' THEN 'allowed' "
        f"ELSE 'failed' END AS status FROM ({selects})"
    )


_TEXTS = {"customerID", "TotalCharges", *SPEC.categories}


@answer
def validation_report():
    return _subscribers(_report("subscribers", _TEXTS))


@answer
def validation_report_dirty():
    return _dirty(_report("subscribers_dirty", _TEXTS | {"tenure"}))


@answer
def schema_faults():
    return _subscribers("""
    SELECT CAST(1 AS BIGINT) AS position, 'V1' AS "check", '' AS "column",
      (SELECT CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM subscribers)::BIGINT AS violations, 'passed' AS status
    UNION ALL SELECT 2, 'V2', 'gender', 1, 'failed'
    UNION ALL SELECT 3, 'V3', 'loyalty', 1, 'failed'
    UNION ALL SELECT 4, 'V4', 'customerID', (SELECT count(*) - count(DISTINCT customerID) FROM subscribers), 'passed'""")


@answer
def duplicate_ids():
    return (
        "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicates FROM "
        "(SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)"
    )


@answer
def ids_across_deliveries():
    return """
    WITH l AS (SELECT l_orderkey AS id, l_linenumber % 3 AS d FROM lineitem),
    f AS (SELECT id, min(d) AS first FROM l GROUP BY id),
    p AS (SELECT d, id, count(*) AS n FROM l GROUP BY d, id)
    SELECT CAST(d AS INTEGER) AS delivery, CAST(sum(n) AS BIGINT) AS rows,
      CAST(sum(CASE WHEN first < d THEN n ELSE n - 1 END) AS BIGINT) AS duplicates,
      CAST(sum(CASE WHEN first < d THEN n ELSE 0 END) AS BIGINT) AS seen_before
    FROM p JOIN f USING (id) GROUP BY d"""


@answer
def unexpected_categories():
    return """
    SELECT 'l_returnflag' AS "column", l_returnflag AS value, count(*) AS rows
    FROM lineitem WHERE l_returnflag NOT IN ('A', 'N') GROUP BY l_returnflag
    UNION ALL
    SELECT 'l_linestatus', l_linestatus, count(*)
    FROM lineitem WHERE l_linestatus NOT IN ('O', 'F') GROUP BY l_linestatus"""


@answer
def unexpected_categories_dirty():
    return _dirty(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {_trim(c)} AS value, count(*) AS rows FROM subscribers_dirty "
        f"WHERE {_trim(c)} NOT IN {_list(words)} GROUP BY {_trim(c)}"
        for c, words in SPEC.categories.items()
    ))


@answer
def negative_values():
    return """
    SELECT 'c_acctbal' AS "column", count(*) FILTER (WHERE c_acctbal < 0) AS violations FROM customer
    UNION ALL SELECT 'c_nationkey', count(*) FILTER (WHERE c_nationkey < 0) FROM customer"""


# Splits


def _quota_ctes(prefix: str, source: str, label: str, key: str, fraction: float, seed: str, order: str = "c") -> dict[str, str]:
    """Ranks every class by md5 of seed and id and marks as many rows as its quota; shares in whole numbers."""
    p = prefix
    return {
        f"{p}n": f"SELECT count(*) AS n, ceil(count(*) * {fraction}) AS t FROM {source}",
        f"{p}q": f"SELECT {label} AS c, count(*) AS k FROM {source} GROUP BY {label}",
        f"{p}w": f"SELECT c, CAST(t AS BIGINT) AS t, (CAST(t AS BIGINT) * k) // n AS b, (CAST(t AS BIGINT) * k) % n AS r FROM {p}q CROSS JOIN {p}n",
        f"{p}z": f"SELECT c, b + CASE WHEN row_number() OVER (ORDER BY r DESC, {order}) <= t - sum(b) OVER () "
                 f"THEN 1 ELSE 0 END AS quota FROM {p}w",
        f"{p}k": f"SELECT *, row_number() OVER (PARTITION BY {label} "
                 f"ORDER BY md5(concat('{seed}', CAST({key} AS VARCHAR)))) AS {p}rn FROM {source}",
        f"{p}split": f"SELECT {p}k.*, {p}rn <= quota AS {p}in FROM {p}k JOIN {p}z ON {p}k.{label} = {p}z.c",
    }


def _three_way() -> dict[str, str]:
    return (
        _quota_ctes("a", "subscribers", "Churn", "customerID", 0.2, "42:1:")
        | {"rest": "SELECT customerID, Churn FROM asplit WHERE NOT ain"}
        | _quota_ctes("b", "rest", "Churn", "customerID", 0.25, "42:2:")
        | {
            "parts": "SELECT customerID, Churn, 'held_out' AS split FROM asplit WHERE ain UNION ALL "
                     "SELECT customerID, Churn, CASE WHEN bin THEN 'new' ELSE 'initial' END FROM bsplit"
        }
    )


@answer
def stratified_split():
    return _subscribers(
        "SELECT customerID, CASE WHEN ain THEN 'test' ELSE 'train' END AS split FROM asplit",
        **_quota_ctes("a", "subscribers", "Churn", "customerID", 0.2, "42:1:"),
    )


@answer
def stratified_split_orders():
    return _with(
        [],
        "SELECT o_orderkey, CASE WHEN ain THEN 'test' ELSE 'train' END AS split FROM asplit",
        **_quota_ctes("a", "orders", "o_orderstatus", "o_orderkey", 0.25, "42:1:"),
    )


@answer
def stratified_split_parts():
    return _with(
        [],
        "SELECT l_partkey, item, CASE WHEN ain THEN 'test' ELSE 'train' END AS split FROM asplit",
        items="SELECT l_partkey, concat_ws('-', l_orderkey, l_partkey, l_suppkey, l_linenumber) AS item FROM lineitem",
        **_quota_ctes("a", "items", "l_partkey", "item", 0.25, "42:1:", "CAST(c AS VARCHAR)"),
    )


@answer
def three_way_split():
    return _subscribers("SELECT customerID, split FROM parts", **_three_way())


@answer
def split_distribution():
    return _subscribers(
        "SELECT split, Churn AS label, count(*) AS count FROM parts GROUP BY split, Churn", **_three_way()
    )


@answer
def split_sizes():
    return _subscribers(
        "SELECT split, count(*) AS count FROM parts GROUP BY split UNION ALL SELECT 'total', count(*) FROM parts",
        **_three_way(),
    )


@answer
def approximate_split():
    return (
        "SELECT o_orderkey, CASE WHEN substr(md5(concat('42:1:', CAST(o_orderkey AS VARCHAR))), 1, 15) "
        "< '400000000000000' THEN 'test' ELSE 'train' END AS split FROM orders"
    )


# Feature preparation


def _fit_ctes(source: str, numbers: Mapping[str, str]) -> dict[str, str]:
    """Medians, then moments of the filled columns, one row each."""
    names = list(numbers)
    return {
        "num": "SELECT " + ", ".join(f"{sql} AS {c}" for c, sql in numbers.items()) + f" FROM {source}",
        "med": "SELECT " + ", ".join(f"median({c}) AS {c}" for c in names) + " FROM num",
        "mom": "SELECT " + ", ".join(
            f"avg(coalesce(num.{c}, med.{c})) AS {c}_mean, stddev_pop(coalesce(num.{c}, med.{c})) AS {c}_std"
            for c in names
        ) + " FROM num CROSS JOIN med",
    }


def _numeric_rows(names: Sequence[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{kind}' AS kind, '{c}' AS \"column\", round({column}, 7) AS value_double FROM {source}"
        for c in names
        for kind, column, source in (("median", c, "med"), ("mean", f"{c}_mean", "mom"), ("std", f"{c}_std", "mom"))
    )


_NUMBERS = {c: _number(c) for c in SPEC.numericals}


def _mode(column: str, source: str) -> str:
    return (
        f"(SELECT {column} FROM {source} WHERE {column} IS NOT NULL "
        f"GROUP BY {column} ORDER BY count(*) DESC, {column} LIMIT 1)"
    )


@answer
def coerce_numbers():
    return _dirty(
        "SELECT customerID, gender, " + ", ".join(f"{sql} AS {c}" for c, sql in _NUMBERS.items())
        + " FROM subscribers_dirty"
    )


@answer
def encode_target():
    return _subscribers("SELECT customerID, CASE Churn WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS Churn FROM subscribers")


@answer
def fit_numeric_state():
    return _subscribers(_numeric_rows(SPEC.numericals), **_fit_ctes("subscribers", _NUMBERS))


@answer
def fit_numeric_state_lineitem():
    return _with([], _numeric_rows(LINEITEM_NUMBERS), **_fit_ctes("lineitem", {c: c for c in LINEITEM_NUMBERS}))


@answer
def constant_columns():
    return 'SELECT o_orderkey, 0.0::DOUBLE AS "numerical__tenth", 0.0::DOUBLE AS "numerical__price" FROM orders'


@answer
def category_counts():
    return _dirty(" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS category, count(*) AS rows FROM subscribers_dirty "
        f"WHERE {c} IS NOT NULL GROUP BY {c}"
        for c in SPEC.categoricals
    ))


def _mode_rows(source: str = "subscribers") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {_mode(c, source)} AS value_string" for c in SPEC.categoricals
    )


def _vocabulary_rows(source: str = "subscribers") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS category, row_number() OVER (ORDER BY {c}) AS ordinal "
        f"FROM (SELECT DISTINCT {c} FROM {source} WHERE {c} IS NOT NULL)"
        for c in SPEC.categoricals
    )


@answer
def fit_mode_state():
    return _subscribers(_mode_rows())


@answer
def fit_vocabulary():
    return _subscribers(_vocabulary_rows())


@answer
def sparse_categories():
    return _with(
        [],
        """
        SELECT l_orderkey, l_linenumber, 'l_partkey' AS "column", position
        FROM lineitem JOIN p ON o = 1 AND w = CAST(l_partkey AS VARCHAR)
        UNION ALL SELECT l_orderkey, l_linenumber, 'l_returnflag', position
        FROM lineitem JOIN p ON o = 2 AND w = l_returnflag
        """,
        fitted="SELECT * FROM lineitem WHERE l_returnflag <> 'N'",
        v="SELECT 1 AS o, CAST(l_partkey AS VARCHAR) AS w FROM fitted UNION SELECT 2, l_returnflag FROM fitted",
        p="SELECT o, w, row_number() OVER (ORDER BY o, w) - 1 AS position FROM v",
    )


@answer
def sparse_model():
    return (
        "SELECT l_partkey, count(*) AS rows, count(*) AS streamed, true AS in_range, true AS same_scores FROM lineitem GROUP BY l_partkey")


def _state_rows(source: str) -> str:
    return f"""
        SELECT kind, "column", CAST(NULL AS VARCHAR) AS category, CAST(NULL AS BIGINT) AS ordinal, value_double,
          CAST(NULL AS VARCHAR) AS value_string FROM ({_numeric_rows(SPEC.numericals)})
        UNION ALL SELECT 'mode', "column", NULL, NULL, NULL, value_string FROM ({_mode_rows(source)})
        UNION ALL SELECT 'category', "column", category, ordinal, NULL, NULL FROM ({_vocabulary_rows(source)})
        """


@answer
def prep_state_saved():
    return _subscribers(_state_rows("subscribers"), **_fit_ctes("subscribers", _NUMBERS))


@answer
def merged_state():
    delivered = "SELECT s.* FROM subscribers s JOIN parts USING (customerID) WHERE split <> 'held_out'"
    return _subscribers(_state_rows("delivered"), **_three_way(), delivered=delivered, **_fit_ctes("delivered", _NUMBERS))


@answer
def skewed_medians():
    columns = {
        "far_groups": "l_extendedprice + CASE WHEN l_linenumber % 2 = 0 THEN 1e12 ELSE 0 END",
        "long_tail": "pow(l_extendedprice, 4)",
        "mostly_one": "CASE WHEN l_linenumber <= 4 THEN 5.0 ELSE l_extendedprice END",
        "gaps": "CASE WHEN l_linenumber % 3 = 0 THEN l_extendedprice END",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"column\", round(median(CAST({sql} AS DOUBLE)) / 1e6, 6) AS median FROM lineitem" for name, sql in columns.items())


def _feature_sql(vocabulary: Mapping[str, Sequence[str]], fitted: str) -> tuple[list[str], list[str]]:
    scaled = [
        f'round((coalesce({_number(f"d.{c}")}, med.{c}) - mom.{c}_mean) / '
        f'CASE WHEN mom.{c}_std = 0 THEN 1 ELSE mom.{c}_std END, 9) AS "numerical__{c}"'
        for c in SPEC.numericals
    ]
    hot = [
        f"CASE WHEN coalesce(d.{c}, {_mode(c, fitted)}) = {_text(v)} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END "
        f'AS "categorical__{c}_{v}"'
        for c, words in vocabulary.items()
        for v in sorted(words)
    ]
    return scaled, hot


_ALL_WORDS = {c: SPEC.categories[c] for c in SPEC.categoricals}


@answer
def scaled_numericals():
    scaled, _ = _feature_sql(_ALL_WORDS, "subscribers")
    return _subscribers(
        f"SELECT customerID, {', '.join(scaled)} FROM subscribers d CROSS JOIN med CROSS JOIN mom",
        **_fit_ctes("subscribers", _NUMBERS),
    )


@answer
def one_hot():
    _, hot = _feature_sql(_ALL_WORDS, "subscribers")
    return _subscribers(f"SELECT customerID, {', '.join(hot)} FROM subscribers d")


@answer
def feature_matrix():
    scaled, hot = _feature_sql(_ALL_WORDS, "subscribers")
    return _subscribers(
        f"SELECT customerID, {', '.join(scaled + hot)}, CASE Churn WHEN 'Yes' THEN 1 ELSE 0 END AS Churn "
        "FROM subscribers d CROSS JOIN med CROSS JOIN mom",
        **_fit_ctes("subscribers", _NUMBERS),
    )


_ONLINE = {"online": "SELECT * FROM subscribers WHERE InternetService <> 'No'"}
_ONLINE_WORDS = {
    c: [v for v in words if v != "No internet service" and not (c == "InternetService" and v == "No")]
    for c, words in _ALL_WORDS.items()
}


@answer
def transform_unseen():
    scaled, hot = _feature_sql(_ONLINE_WORDS, "online")
    return _dirty(
        f"SELECT customerID, {', '.join(scaled + hot)} FROM subscribers_dirty d CROSS JOIN med CROSS JOIN mom",
        **_ONLINE, **_fit_ctes("online", _NUMBERS),
    )


@answer
def filled_categories():
    return _dirty(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", category, count(*) AS rows FROM "
            f"(SELECT coalesce({c}, {_mode(c, 'online')}) AS category FROM subscribers_dirty) "
            f"WHERE category IN {_list(words)} GROUP BY category"
            for c, words in _ONLINE_WORDS.items()
        ),
        **_ONLINE,
    )


@answer
def processed_scan():
    counted = ", ".join(
        f'count(*) FILTER (WHERE {c} = {_text(v)}) AS "categorical__{c}_{v}"' for c, words in _ALL_WORDS.items() for v in words
    )
    return _subscribers(
        f"SELECT CASE Churn WHEN 'Yes' THEN 1 ELSE 0 END AS Churn, count(*) AS rows, {counted} FROM subscribers GROUP BY 1"
    )


# Training sets


@answer
def combine_training():
    return _subscribers(
        "SELECT split AS source, count(*) AS rows FROM parts WHERE split <> 'held_out' GROUP BY split "
        "UNION ALL SELECT 'combined', count(*) FROM parts WHERE split <> 'held_out'",
        **_three_way(),
    )


@answer
def class_weights():
    return _subscribers(
        "SELECT customerID, CASE Churn WHEN 'Yes' THEN 2.5::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM subscribers"
    )


# Evaluation and promotion


def _counts(label: str, score: str) -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE {label} {a} 1 AND {score} {b} 0.5) AS {name}"
        for name, a, b in (("tp", "=", ">"), ("fp", "<>", ">"), ("fn", "=", "<="), ("tn", "<>", "<="))
    )


# The formulas over tp, fp, fn and tn; a ratio without a denominator is 0.
_FORMULAS = {
    "accuracy": ("tp + tn", "tp + fp + fn + tn"),
    "precision": ("tp", "tp + fp"),
    "recall": ("tp", "tp + fn"),
    "f1_score": ("2 * tp", "2 * tp + fp + fn"),
}


def _formula(name: str) -> str:
    top, bottom = _FORMULAS[name]
    return f"CASE WHEN {bottom} = 0 THEN 0.0::DOUBLE ELSE CAST({top} AS DOUBLE) / ({bottom}) END"


def _auc(model: str, source: str, label: str, score: str) -> str:
    """Rank sum with average ranks for ties."""
    return (
        f"SELECT '{model}' AS model, (sum(CASE WHEN {label} = 1 THEN avg_rank END) "
        f"- sum({label}) * (sum({label}) + 1) / 2.0::DOUBLE) / (sum({label})::DOUBLE * (count(*) - sum({label}))) AS roc_auc "
        f"FROM (SELECT {label}, rank() OVER (ORDER BY {score}) "
        f"+ (count(*) OVER (PARTITION BY {score}) - 1) / 2.0::DOUBLE AS avg_rank FROM {source})"
    )


_METRIC_CTES = {
    "c": " UNION ALL ".join(
        f"SELECT '{m}' AS model, count(*) AS n, {_counts('label', f'{m}_score')} FROM model_scores"
        for m in ("candidate", "production")
    ),
    "auc": " UNION ALL ".join(_auc(m, "model_scores", "label", f"{m}_score") for m in ("candidate", "production")),
    "m": "SELECT model, n, tp, fp, fn, tn, "
         + ", ".join(f"{_formula(f)} AS {f}" for f in _FORMULAS) + ", roc_auc FROM c JOIN auc USING (model)",
}
_SUPPLIERS = {
    "s": "SELECT l_suppkey, CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_discount * 10 AS score FROM lineitem",
    "c": f"SELECT l_suppkey, {_counts('label', 'score')} FROM s GROUP BY l_suppkey",
}


@answer
def predicted_classes():
    return _with(["model_scores"], """
    SELECT label, CASE WHEN production_score > 0.5 THEN 1 ELSE 0 END AS prediction, count(*) AS rows
    FROM model_scores GROUP BY ALL""")


@answer
def confusion_counts():
    return _with([], "SELECT * FROM c", **_SUPPLIERS)


@answer
def threshold_metrics():
    return _with(
        [], "SELECT l_suppkey, " + ", ".join(f"round({_formula(f)}, 9) AS {f}" for f in _FORMULAS) + " FROM c",
        **_SUPPLIERS,
    )


@answer
def classification_metrics():
    return _with(
        ["model_scores"],
        "SELECT model, n, tp, fp, fn, tn, " + ", ".join(f"round({m}, 9) AS {m}" for m in METRICS) + " FROM m",
        **_METRIC_CTES,
    )


@answer
def roc_auc():
    prices = (
        "SELECT CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END AS label, l_extendedprice AS price, "
        "l_extendedprice * (1 - l_discount) AS discounted FROM lineitem"
    )
    both = " UNION ALL ".join(_auc(m, "p", "label", m) for m in ("price", "discounted"))
    return _with([], f"SELECT model, round(roc_auc, 9) AS roc_auc FROM ({both})", p=prices)


_PAIR = {"cand": "SELECT * FROM m WHERE model = 'candidate'", "prod": "SELECT * FROM m WHERE model = 'production'"}
_SIDES = ", ".join(
    f"round({alias}.{m}, 9) AS {side}_{m}"
    for side, alias in (("candidate", "cand"), ("production", "prod"))
    for m in METRICS
) + ", round(cand.f1_score - prod.f1_score, 9) AS f1_improvement"
_DECISION = "CASE WHEN cand.f1_score > prod.f1_score THEN 'PROMOTE' ELSE 'REJECT' END AS decision"


def _evaluation(columns: str) -> str:
    return _with(["model_scores"], f"SELECT {columns} FROM cand CROSS JOIN prod", **_METRIC_CTES, **_PAIR)


@answer
def evaluation_record():
    return _evaluation(f"{_SIDES}, cand.f1_score > prod.f1_score AS candidate_better")


@answer
def promotion_decision():
    return _evaluation(_DECISION)


@answer
def promotion_record():
    return _evaluation(f"{_SIDES}, {_DECISION}")


@answer
def run_ledger():
    lines = [
        (f"{side}_{m}", f"{alias}.{m}") for side, alias in (("candidate", "cand"), ("production", "prod")) for m in METRICS
    ] + [("f1_improvement", "cand.f1_score - prod.f1_score")]
    rows = [("metric", key, f"round({value}, 9)", "CAST(NULL AS VARCHAR)") for key, value in lines]
    rows.append(("param", "candidate_better", "NULL", "CAST(cand.f1_score > prod.f1_score AS VARCHAR)"))
    rows.append(("tag", "comparison_metric", "NULL", "'f1_score'"))
    body = " UNION ALL ".join(
        f"SELECT 'candidate_held_out_evaluation' AS run_name, 'held_out_evaluation' AS run_type, "
        f"'{kind}' AS kind, '{key}' AS key, {number} AS number, {text} AS text FROM cand CROSS JOIN prod"
        for kind, key, number, text in rows
    )
    return _with(["model_scores"], body, **_METRIC_CTES, **_PAIR)


@answer
def best_trial():
    return _with(
        [], f"SELECT l_suppkey AS trial, {_formula('f1_score')} AS objective FROM c "
            "ORDER BY objective DESC, trial LIMIT 1",
        **_SUPPLIERS,
    )


@answer
def registry_history():
    return _with(
        ["model_scores"],
        "SELECT version, model, status, version = (SELECT max(version) FROM h WHERE status = 'promoted') AS production FROM h",
        **_METRIC_CTES, **_PAIR,
        h="SELECT CAST(1 AS BIGINT) AS version, 'first' AS model, 'promoted' AS status "
          "UNION ALL SELECT 2, 'as_measured', CASE WHEN cand.f1_score > prod.f1_score THEN 'promoted' ELSE 'rejected' END "
          "FROM cand CROSS JOIN prod "
          "UNION ALL SELECT 3, 'swapped', CASE WHEN prod.f1_score > cand.f1_score THEN 'promoted' ELSE 'rejected' END "
          "FROM cand CROSS JOIN prod "
          "UNION ALL SELECT 4, 'equal', 'rejected'",
    )


# Training: what can be said without fitting the trees again


@answer
def train_and_score():
    return _subscribers(
        "SELECT customerID, CASE Churn WHEN 'Yes' THEN 1 ELSE 0 END AS Churn, true AS in_range, true AS follows_nodes "
        "FROM asplit WHERE ain",
        **_quota_ctes("a", "subscribers", "Churn", "customerID", 0.2, "42:1:"),
    )


@answer
def search_trials():
    # The declared ranges, and the rule of the draws: whole numbers, real numbers, and real numbers on a
    # logarithmic scale, each trial from a generator of its own.
    ranges = (
        ("n_estimators", "int", 100, 500), ("max_depth", "int", 3, 10), ("learning_rate", "log", 0.01, 0.30), ("min_child_weight", "int", 1, 10),
        ("subsample", "real", 0.6, 1.0), ("colsample_bytree", "real", 0.6, 1.0), ("gamma", "real", 0.0, 5.0), ("reg_alpha", "real", 0.0, 5.0),
        ("reg_lambda", "log", 0.1, 10.0), ("scale_pos_weight", "real", 1.0, 5.0),
    )
    rows = []
    for trial in range(20):
        generator, drawn = random.Random(f"42:{trial}"), []
        for name, kind, low, high in ranges:
            if kind == "int":
                value = low + generator.randint(0, high - low)
            elif kind == "log":
                value = math.exp(generator.uniform(math.log(low), math.log(high)))
            else:
                value = generator.uniform(low, high)
            drawn.append(f"round(CAST({value!r} AS DOUBLE), 9) AS {name}")
        rows.append(f"SELECT {trial} AS trial, 'complete' AS state, {', '.join(drawn)}")
    return _subscribers(
        f"SELECT r.*, n > 0 AS in_range, n > 0 AS objective_is_f1, n > 0 AS best_is_repeated FROM ({' UNION ALL '.join(rows)}) r "
        "CROSS JOIN (SELECT count(*) AS n FROM subscribers)")


@answer
def forest_scores():
    names = ("tenure", "MonthlyCharges", "SeniorCitizen")
    pairs = list(zip(names, names[1:] + names[:1]))
    churned = "coalesce(avg(CASE Churn WHEN 'Yes' THEN 0.5::DOUBLE ELSE -0.5::DOUBLE END) FILTER (WHERE {}), 0)"
    nodes, weights = [], {}
    for tree, (first, then) in enumerate(pairs):
        below, left = f"{first} <= m_{first}", f"{then} <= m_{then}"
        leaves = (f"{below} AND {left}", f"{below} AND NOT {left}", f"NOT {below}")
        nodes += [
            f"SELECT {tree} AS tree, 0 AS node, '{first}' AS feature, m_{first} AS threshold, 1 AS l, 4 AS r, CAST(NULL AS DOUBLE) AS value FROM med",
            f"SELECT {tree}, 1, '{then}', m_{then}, 2, 3, NULL FROM med",
            *(f"SELECT {tree}, {node}, NULL, NULL, NULL, NULL, {churned.format(where)} FROM subscribers CROSS JOIN med"
              for node, where in zip((2, 3, 4), leaves)),
        ]
        weights[tree] = tree + 1
    sql = _subscribers(
        """
        SELECT customerID, round(1 / (1 + exp(-2 * sum(value / (tree + 1)))), 9) AS probability
        FROM w JOIN nodes USING (tree, node) WHERE value IS NOT NULL GROUP BY customerID""",
        med="SELECT " + ", ".join(f"median({c})::DOUBLE AS m_{c}" for c in names) + " FROM subscribers",
        nodes=" UNION ALL ".join(nodes),
        x=" UNION ALL ".join(f"SELECT customerID, '{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM subscribers" for c in names),
        w="""
          SELECT customerID, tree, 0 AS node FROM subscribers CROSS JOIN (SELECT DISTINCT tree FROM nodes)
          UNION ALL SELECT w.customerID, w.tree, CASE WHEN x.x <= n.threshold THEN n.l ELSE n.r END
          FROM w JOIN nodes n USING (tree, node) JOIN x ON x.customerID = w.customerID AND x.feature = n.feature""",
    )
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


@answer
def resumed_search():
    return _subscribers(
        "SELECT CAST(t AS INTEGER) AS trial, CASE WHEN t < 2 THEN 'before' ELSE 'after' END AS written, "
        "count(*) > 0 AS same_parameters, count(*) > 0 AS same_result FROM subscribers CROSS JOIN range(3) r(t) GROUP BY t")


@answer
def retraining_flow():
    return _subscribers(
        """
        SELECT 'initial_rows' AS name, CAST(initial AS BIGINT) AS value FROM s
        UNION ALL SELECT 'new_rows', fresh FROM s
        UNION ALL SELECT 'combined_rows', initial + fresh FROM s
        UNION ALL SELECT 'validation_rows', CAST(ceil((initial + fresh) * 0.2) AS BIGINT) FROM s
        UNION ALL SELECT 'training_rows', initial + fresh - CAST(ceil((initial + fresh) * 0.2) AS BIGINT) FROM s
        UNION ALL SELECT 'held_out_rows', held_out FROM s
        UNION ALL SELECT 'registry_entries', 2
        UNION ALL SELECT 'tuning_trials', 3
        UNION ALL SELECT 'best_params_follow_trials', 1
        UNION ALL SELECT 'production_metrics_follow_decision', 1
        UNION ALL SELECT 'decision_follows_f1', 1
        UNION ALL SELECT 'registry_follows_decision', 1
        """,
        **_three_way(),
        s="SELECT count(*) FILTER (WHERE split = 'initial') AS initial, count(*) FILTER (WHERE split = 'new') AS fresh, "
          "count(*) FILTER (WHERE split = 'held_out') AS held_out FROM parts",
    )


@answer
def model_saved():
    return _subscribers("SELECT customerID, true AS same, true AS in_range FROM subscribers")


# Scoring


def _field_rules() -> list[tuple[str, str]]:
    rules = [("customerID", "CASE WHEN customerID IS NULL THEN 'missing' END")]
    for c in ("SeniorCitizen", "tenure"):
        last = f"{_parsed(c)} NOT IN (0, 1) THEN 'value'" if c == "SeniorCitizen" else f"{_parsed(c)} < 0 THEN 'minimum'"
        rules.append((c, f"CASE WHEN {c} IS NULL THEN 'missing' WHEN {_number(c)} IS NULL "
                         f"OR {_number(c)} <> floor({_number(c)}) THEN 'type' WHEN {last} END"))
    rules.append(("MonthlyCharges", "CASE WHEN MonthlyCharges IS NULL THEN 'missing' "
                                    "WHEN NOT (MonthlyCharges >= 0) THEN 'minimum' END"))
    rules.append(("TotalCharges", f"CASE WHEN TotalCharges IS NULL THEN NULL WHEN {_parsed('TotalCharges')} IS NULL "
                                  f"THEN 'type' WHEN isnan({_parsed('TotalCharges')}) OR {_parsed('TotalCharges')} < 0 "
                                  "THEN 'minimum' END"))
    rules += [
        (c, f"CASE WHEN {c} IS NULL THEN 'missing' WHEN {c} NOT IN {_list(words)} THEN 'value' END")
        for c, words in _ALL_WORDS.items()
    ]
    return rules


def _error_rows() -> str:
    return " UNION ALL ".join(
        f"SELECT customerID, gender, '{c}' AS field, {rule} AS rule FROM subscribers_dirty" for c, rule in _field_rules()
    )


@answer
def request_errors():
    return _dirty(f"SELECT * FROM ({_error_rows()}) WHERE rule IS NOT NULL")


@answer
def request_error_counts():
    return _dirty(
        f"SELECT field, rule, count(*) AS requests FROM ({_error_rows()}) WHERE rule IS NOT NULL GROUP BY field, rule"
    )


@answer
def quarantine():
    valid = " AND ".join(f"({rule}) IS NULL" for _, rule in _field_rules())
    return _dirty(f"SELECT customerID, CASE WHEN {valid} THEN 'valid' ELSE 'rejected' END AS part FROM subscribers_dirty")


@answer
def stream_scoring():
    valid = " AND ".join(f"({rule}) IS NULL" for _, rule in _field_rules())
    return _dirty(
        f"SELECT customerID, CASE WHEN {valid} THEN 200 ELSE 422 END AS status, 2 * count(*) AS requests "
        "FROM subscribers_dirty GROUP BY 1, 2"
    )


@answer
def score_requests():
    broken = " + ".join(f"CASE WHEN ({rule}) IS NULL THEN 0 ELSE 1 END" for _, rule in _field_rules())
    return _dirty(
        "SELECT customerID, CASE WHEN broken = 0 THEN 200 ELSE 422 END AS status, broken AS broken_rules, "
        f"broken = 0 AS has_probability, true AS follows_nodes FROM (SELECT customerID, {broken} AS broken FROM subscribers_dirty)"
    )


@answer
def prediction_response():
    return _log("""
    SELECT customerID, CASE WHEN probability > 0.5 THEN 1 ELSE 0 END AS prediction,
      CASE WHEN probability > 0.5 THEN 'Yes' ELSE 'No' END AS churn, round(probability, 4) AS churn_probability
    FROM prediction_log WHERE probability IS NOT NULL""")


@answer
def prediction_log():
    return _log("""
    SELECT request_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, customerID, status, latency_seconds,
      CASE WHEN probability > 0.5 THEN 'Yes' WHEN probability IS NOT NULL THEN 'No' END AS label, probability
    FROM prediction_log""")


# Monitoring


@answer
def log_totals():
    return _log("""
    SELECT count(*) AS requests, count(*) FILTER (WHERE status = 200) AS successful,
      count(*) FILTER (WHERE status IN (422, 500)) AS failed,
      count(*) FILTER (WHERE probability > 0.5) AS churn, count(*) FILTER (WHERE probability <= 0.5) AS non_churn,
      count(probability) AS results
    FROM prediction_log""")


@answer
def results_by_label():
    return _log("""
    SELECT CASE WHEN probability > 0.5 THEN 'Yes' ELSE 'No' END AS churn, count(*) AS predictions
    FROM prediction_log WHERE probability IS NOT NULL GROUP BY 1
    UNION ALL SELECT 'total', count(probability) FROM prediction_log""")


def _window_ctes(seconds: int, slide: int, grid: bool = True) -> dict[str, str]:
    """Every window with the rows in it, straight from the log."""
    first = f"time_bucket(INTERVAL {slide} second, min(ts)) - INTERVAL {seconds - slide} second"
    ctes = {
        "grid": f"SELECT unnest(generate_series({first}, time_bucket(INTERVAL {slide} second, max(ts)), "
                f"INTERVAL {slide} second)) AS ws FROM prediction_log",
        "hits": "SELECT ws, l.* FROM grid LEFT JOIN prediction_log l "
                f"ON l.ts >= ws AND l.ts < ws + INTERVAL {seconds} second",
    }
    if not grid:
        ctes["hits"] = ctes["hits"].replace("LEFT JOIN", "JOIN")
    rates = (
        ("request_rate", "count(request_id) / {s}"),
        ("error_rate", "100.0 * (count(*) FILTER (WHERE status IN (422, 500)) / {s}) / (count(request_id) / {s} + 1e-9)"),
        ("success_rate", "100.0 * (count(*) FILTER (WHERE status = 200) / {s}) / (count(request_id) / {s} + 1e-9)"),
        ("avg_latency", "(coalesce(sum(latency_seconds), 0) / {s}) / (count(latency_seconds) / {s} + 1e-9)"),
    )
    ctes["rates"] = "SELECT ws, " + ", ".join(
        f"{sql.format(s=f'CAST({seconds} AS DOUBLE)')} AS {name}" for name, sql in rates
    ) + " FROM hits GROUP BY ws"
    ctes |= _quantile_ctes("p95_latency", "latency_seconds", LATENCY_BOUNDS)
    ctes |= _quantile_ctes("p95_probability", "probability", PROBABILITY_BOUNDS)
    ctes["dash"] = "SELECT * FROM rates LEFT JOIN p95_latency USING (ws) LEFT JOIN p95_probability USING (ws)"
    return ctes


def _quantile_ctes(name: str, value: str, bounds: Sequence[float]) -> dict[str, str]:
    """The 0.95 quantile interpolated in the first bucket that reaches the rank."""
    edges = ", ".join(f"CAST({b} AS DOUBLE)" for b in bounds)
    return {
        f"{name}_le": f"SELECT ws, le, count(*) FILTER (WHERE {value} <= le) AS cum, count({value}) AS n "
                      f"FROM hits CROSS JOIN (SELECT unnest([{edges}, CAST('inf' AS DOUBLE)]) AS le) GROUP BY ws, le",
        f"{name}_prev": f"SELECT *, lag(cum, 1, 0) OVER w AS cum0, lag(le) OVER w AS le0 "
                        f"FROM {name}_le WINDOW w AS (PARTITION BY ws ORDER BY le)",
        f"{name}_hit": f"SELECT *, row_number() OVER (PARTITION BY ws ORDER BY le) AS k "
                       f"FROM {name}_prev WHERE n > 0 AND cum >= 0.95::DOUBLE * n",
        name: f"SELECT ws, CASE WHEN isinf(le) THEN le0 WHEN le0 IS NULL AND le <= 0 THEN le "
              f"ELSE coalesce(le0, 0) + (le - coalesce(le0, 0)) * (0.95::DOUBLE * n - cum0) / (cum - cum0) END "
              f"AS {name} FROM {name}_hit WHERE k = 1",
    }


_START = "strftime(ws, '%Y-%m-%d %H:%M:%S') AS window_start"


def _windowed(name: str) -> str:
    return _log(
        f"SELECT {_START}, strftime(ws + INTERVAL 300 second, '%Y-%m-%d %H:%M:%S') AS window_end, "
        f"round({name}, 9) AS {name} FROM dash",
        **_window_ctes(300, 60),
    )


@answer
def request_rate():
    return _windowed("request_rate")


@answer
def error_rate():
    return _windowed("error_rate")


@answer
def success_rate():
    return _windowed("success_rate")


@answer
def avg_latency():
    return _windowed("avg_latency")


@answer
def p95_latency():
    return _windowed("p95_latency")


@answer
def p95_probability():
    return _windowed("p95_probability")


_VALUES = ("request_rate", "error_rate", "success_rate", "avg_latency", "p95_latency", "p95_probability")


@answer
def hourly_dashboard():
    return _log(
        f"SELECT {_START}, " + ", ".join(f"round({v}, 9) AS {v}" for v in _VALUES) + " FROM dash",
        **_window_ctes(3600, 3600),
    )


@answer
def stream_rates():
    return _log(
        f"SELECT {_START}, " + ", ".join(f"round({v}, 9) AS {v}" for v in _VALUES) + " FROM dash",
        **_window_ctes(300, 60, grid=False),
    )


@answer
def stream_repaired():
    return _log(
        f"SELECT {_START}, " + ", ".join(f"round({v}, 9) AS {v}" for v in _VALUES) + " FROM dash",
        **_window_ctes(300, 60, grid=False),
    )


def _histogram(value: str, bounds: Sequence[float], where: str) -> str:
    lines = [(str(b), f"count(*) FILTER (WHERE {value} <= {b})") for b in bounds] + [("+Inf", f"count({value})")]
    return " UNION ALL ".join(
        f"SELECT {where}'{le}' AS le, {n} AS cumulative, round(sum({value}), 6) AS sum, count({value}) AS count "
        "FROM prediction_log" + (" GROUP BY status" if where else "")
        for le, n in lines
    )


@answer
def latency_histogram():
    return _log(_histogram("latency_seconds", LATENCY_BOUNDS, "status, "))


@answer
def probability_histogram():
    return _log(_histogram("probability", PROBABILITY_BOUNDS, ""))


@answer
def merged_histogram():
    return _log(_histogram("latency_seconds", LATENCY_BOUNDS, ""))


@answer
def last_values():
    return _log(
        " UNION ALL ".join(
            f"SELECT '{v}' AS series, round((SELECT {v} FROM dash WHERE {v} IS NOT NULL ORDER BY ws DESC LIMIT 1), 9) AS value"
            for v in _VALUES
        ),
        **_window_ctes(3600, 3600),
    )


@answer
def stream_last_values():
    return ORACLE["last_values"]


@answer
def stream_totals():
    return ORACLE["log_totals"]
