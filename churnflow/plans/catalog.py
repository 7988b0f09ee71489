"""The registered queries: every operator over the star-schema tables of a folder."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from churnflow.functions import ordered
from churnflow.operators import assembly, features, forest, metrics, monitoring, partial, profile, promotion, quality, scoring, sparse
from churnflow.operators import split as splits
from churnflow.operators import training
from churnflow.operators.promotion import Registry
from churnflow.plans.bootstrap import run_bootstrap, trials_of
from churnflow.plans.layout import Layout
from churnflow.plans.retraining import run_retraining
from churnflow.session import work_folder
from churnflow.sources import models, records, tables
from churnflow.sources.seen_ids import SeenIds
from churnflow.sources.views import table, view, view_over
from churnflow.spec import telecom_spec
from churnflow.streaming.monitoring import run_to_table, stream_dashboard
from churnflow.streaming.repair import count_to_table, counted_totals, repair_to_table, repaired_windows
from churnflow.streaming.scoring import score_stream

SPEC = telecom_spec()
LINEITEM_NUMBERS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
SCORES = {"candidate": "candidate_score", "production": "production_score"}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def registered(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def _subscribers(spark, folder):
    return view(spark, folder, "subscribers")


def _dirty(spark, folder):
    return view(spark, folder, "subscribers_dirty")


def _log(spark, folder):
    return view(spark, folder, "prediction_log")


def _rounded(df: DataFrame, digits: int, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(F.col(f"`{c}`"), digits) for c in columns})


def _minute(column: str) -> Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


# Sources and profiling


@registered
def csv_scan(spark, folder):
    """Delimited text written and read back: blanks stay, empty cells and NA tokens become null."""
    return tables.read_csv(spark, tables.write_csv(_dirty(spark, folder), work_folder(spark, "csv")))


@registered
def csv_columns_by_name(spark, folder):
    """Files of one table whose columns come in different orders: cells follow the names above them."""
    path, customers = work_folder(spark, "csv"), table(spark, folder, "customer").drop("c_phone", "c_comment", "c_address")
    names = [f.name for f in customers.schema if f.dataType.typeName() in ("long", "integer", "string")]
    for number, order in enumerate((names, names[::-1], names[1:] + names[:1])):
        rows = customers.where(F.col("c_custkey") % 3 == number).select(*order)
        rows.coalesce(1).write.mode("append").options(header=True, escape='"').csv(path)
    return tables.read_csv(spark, path, "Customers", na_tokens=("",)).select(*names)


@registered
def csv_line_breaks(spark, folder):
    """Cells with line breaks, quotes and commas, written to delimited files and read back record by record."""
    customers = table(spark, folder, "customer").select(
        "c_custkey", F.concat("c_name", F.lit('\n"quoted", '), "c_mktsegment", F.when(F.col("c_custkey") % 2 == 0, "\n\n,").otherwise("")).alias("note"),
        F.when(F.col("c_custkey") % 3 > 0, F.col("c_mktsegment")).alias("segment"))
    return tables.read_csv(spark, tables.write_csv(customers, work_folder(spark, "csv")), "Customers", multiline=True)


@registered
def profile_stored(spark, folder):
    """Rows and missing cells of a stored table, from its files' footers; only floating point columns are read."""
    path = tables.write_table(_dirty(spark, folder), work_folder(spark, "dirty"))
    return profile.stored_missing_counts(spark, path)


@registered
def profile_shape(spark, folder):
    return profile.shape(_subscribers(spark, folder))


@registered
def profile_columns(spark, folder):
    return profile.column_profile(table(spark, folder, "lineitem"))


@registered
def profile_missing(spark, folder):
    return profile.missing_counts(_dirty(spark, folder))


@registered
def profile_head(spark, folder):
    return profile.head(_subscribers(spark, folder), "customerID")


@registered
def profile_class_counts(spark, folder):
    return profile.value_counts(_subscribers(spark, folder), "Churn")


@registered
def profile_class_share(spark, folder):
    return _rounded(profile.value_shares(_subscribers(spark, folder), "Churn"), 9, "percent")


@registered
def profile_value_counts(spark, folder):
    return profile.value_counts(table(spark, folder, "lineitem"), "l_returnflag")


# Validation


@registered
def validation_report(spark, folder):
    return quality.validation_report(_subscribers(spark, folder), SPEC)


@registered
def validation_report_dirty(spark, folder):
    return quality.validation_report(_dirty(spark, folder), SPEC)


@registered
def schema_faults(spark, folder):
    """The checks of a whole table where one column is missing and one is unknown."""
    df = _subscribers(spark, folder).drop("gender").withColumn("loyalty", F.lit(1))
    return quality.validation_report(df, SPEC).where(F.col("check").isin("V1", "V2", "V3", "V4"))


@registered
def duplicate_ids(spark, folder):
    return quality.duplicate_ids(table(spark, folder, "lineitem"), "l_orderkey", "l_linenumber")


@registered
def ids_across_deliveries(spark, folder):
    """Line items delivered in three parts: orders that an earlier part had, told by an index that isn't moved."""
    index = SeenIds(spark, work_folder(spark, "seen-ids"), 8)
    found = []
    for number in range(3):
        delivery = table(spark, folder, "lineitem").where(F.col("l_linenumber") % 3 == number)
        found.append(tables.stored(index.counts(delivery, "l_orderkey").withColumn("delivery", F.lit(number)), "seen-counts"))
        index.add(delivery, "l_orderkey", str(number))
    return reduce(DataFrame.unionByName, found)


@registered
def unexpected_categories(spark, folder):
    return quality.unexpected_categories(
        table(spark, folder, "lineitem"), {"l_returnflag": ("A", "N"), "l_linestatus": ("O", "F")}
    )


@registered
def unexpected_categories_dirty(spark, folder):
    return quality.unexpected_categories(_dirty(spark, folder), SPEC.categories)


@registered
def negative_values(spark, folder):
    return quality.negative_values(table(spark, folder, "customer"), "c_acctbal", "c_nationkey")


# Splits


@registered
def stratified_split(spark, folder):
    return splits.stratified_split(_subscribers(spark, folder), "Churn", "customerID", 0.2).select(
        "customerID", "split"
    )


@registered
def stratified_split_orders(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return splits.stratified_split(orders, "o_orderstatus", "o_orderkey", 0.25).select("o_orderkey", "split")


@registered
def stratified_split_parts(spark, folder):
    """A class for every part: thousands of classes, their quotas and thresholds never on the driver."""
    items = table(spark, folder, "lineitem").select(
        "l_partkey", F.concat_ws("-", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").alias("item"))
    return splits.stratified_split(items, "l_partkey", "item", 0.25)


@registered
def three_way_split(spark, folder):
    return splits.three_way_split(_subscribers(spark, folder), "Churn", "customerID").select("customerID", "split")


@registered
def split_distribution(spark, folder):
    return splits.split_distribution(
        splits.three_way_split(_subscribers(spark, folder), "Churn", "customerID"), "Churn"
    )


@registered
def split_sizes(spark, folder):
    return splits.split_sizes(splits.three_way_split(_subscribers(spark, folder), "Churn", "customerID"))


@registered
def approximate_split(spark, folder):
    return splits.approximate_split(table(spark, folder, "orders"), "o_orderkey", 0.25).select(
        "o_orderkey", "split"
    )


# Feature preparation


@registered
def coerce_numbers(spark, folder):
    return features.coerced(_dirty(spark, folder), SPEC).select("customerID", "gender", *SPEC.numericals)


@registered
def encode_target(spark, folder):
    return _subscribers(spark, folder).select("customerID", features.encoded_target(SPEC).alias("Churn"))


@registered
def fit_numeric_state(spark, folder):
    return _state_table(spark, features.numeric_stats(_subscribers(spark, folder), SPEC.numericals))


@registered
def fit_numeric_state_lineitem(spark, folder):
    return _state_table(spark, features.numeric_stats(table(spark, folder, "lineitem"), LINEITEM_NUMBERS))


@registered
def skewed_medians(spark, folder):
    """Medians of columns whose middle lies beside a gap, or among few far values: one far value on either side, two
    distant groups, a long tail."""
    price, key = F.col("l_extendedprice"), F.col("l_linenumber")
    columns = {
        "far_groups": price + F.when(key % 2 == 0, 1e12).otherwise(0.0),
        "long_tail": F.pow(price, 4),
        "mostly_one": F.when(key <= 4, 5.0).otherwise(price),
        "gaps": F.when(key % 3 == 0, price),
    }
    values = table(spark, folder, "lineitem").select(*[c.cast("double").alias(name) for name, c in columns.items()])
    medians, _ = ordered.exact_medians(values, list(columns))
    return spark.createDataFrame([(c, round(m / 1e6, 6)) for c, m in medians.items()], "column string, median double")


@registered
def merged_state(spark, folder):
    """The state of two deliveries from their parts, none of their rows read again: that of fitting on all rows of both."""
    parts = splits.three_way_split(_subscribers(spark, folder), "Churn", "customerID")
    state = partial.StateParts(spark, work_folder(spark, "state-parts"), SPEC)
    for delivery in ("initial", "new"):
        state.add(parts.where(F.col("split") == delivery).drop("split"), delivery)
    return _state_entries(spark, state.merged())


def _state_entries(spark, state: features.PrepState) -> DataFrame:
    return state.to_table(spark).select(
        "kind", "column", "category", F.col("ordinal").cast("bigint").alias("ordinal"),
        F.round("value_double", 7).alias("value_double"), "value_string",
    )


def _state_table(spark, stats) -> DataFrame:
    state = features.PrepState(stats, {}, {}).to_table(spark)
    return _rounded(state.select("kind", "column", "value_double"), 7, "value_double")


@registered
def constant_columns(spark, folder):
    """Two columns of one value, the first with gaps: every cell scales to zero."""
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, 0.1).alias("tenth"), F.lit(70.35).alias("price")
    )
    state = features.PrepState(features.numeric_stats(orders, ("tenth", "price")), {}, {})
    scaled = orders.select("o_orderkey", *state.features(orders, SPEC))
    return _rounded(scaled, 9, *state.feature_names)


@registered
def category_counts(spark, folder):
    return features.category_counts(_dirty(spark, folder), SPEC)


@registered
def fit_mode_state(spark, folder):
    counts = features.category_counts(_subscribers(spark, folder), SPEC)
    return features.modes_of(counts).withColumnRenamed("category", "value_string")


@registered
def fit_vocabulary(spark, folder):
    return features.vocabulary_of(tables.stored(features.category_counts(_subscribers(spark, folder), SPEC), "categories"))


@registered
def sparse_categories(spark, folder):
    """The one-hot block of columns with many categories as a sparse matrix; flag N is unseen in fitting."""
    lineitem = table(spark, folder, "lineitem")
    state = sparse.fit_sparse(lineitem.where("l_returnflag <> 'N'"), ("l_partkey", "l_returnflag"))
    return sparse.sparse_cells(lineitem, state, "l_orderkey", "l_linenumber")


@registered
def sparse_model(spark, folder):
    """A model over parts, a category for each of them, and quantities: fitted on items that are not returned unseen, saved,
    loaded, and scoring all items as a batch and as a stream."""
    items = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_partkey", "l_quantity", "l_returnflag", (F.col("l_returnflag") == "R").cast("int").alias("label"))
    model = sparse.fit_sparse_model(items.where("l_orderkey % 5 > 0"), "label", ["l_partkey"], ["l_quantity"], iterations=3)
    loaded = sparse.SparseModel.load(spark, model.save(work_folder(spark, "sparse-model")))
    source, out = tables.write_table(items, work_folder(spark, "items")), work_folder(spark, "scored")
    stream = loaded.scored(spark.readStream.schema(items.schema).parquet(source))
    run_to_table(stream, out, work_folder(spark, "progress"))
    rounded = F.round("score", 6)
    batch = model.scored(items).groupBy("l_partkey").agg(F.count(F.lit(1)).alias("rows"), F.sum(rounded).alias("score"))
    streamed = spark.read.schema(stream.schema).parquet(out).groupBy("l_partkey").agg(
        F.count(F.lit(1)).alias("streamed"), F.sum(rounded).alias("streamed_score"), F.bool_and(F.col("score").between(0, 1)).alias("in_range"))
    return batch.join(streamed, "l_partkey").select(
        "l_partkey", "rows", "streamed", "in_range", (F.abs(F.col("score") - F.col("streamed_score")) < 1e-4).alias("same_scores"))


@registered
def prep_state_saved(spark, folder):
    """Every entry of the state after being saved and loaded."""
    path = models.save_state(spark, features.fit_state(_subscribers(spark, folder), SPEC), work_folder(spark, "state"))
    return _state_entries(spark, models.load_state(spark, path, SPEC))


def _prepared(spark, folder) -> tuple[DataFrame, features.PrepState]:
    # Fitting reads its input several times, and what follows once more each time; the view's joins run once.
    return features.fit_and_transform(tables.stored(_subscribers(spark, folder), "subscribers"), SPEC)


@registered
def scaled_numericals(spark, folder):
    prepared, _ = _prepared(spark, folder)
    names = [f"numerical__{c}" for c in SPEC.numericals]
    return _rounded(prepared.select("customerID", *names), 9, *names)


@registered
def one_hot(spark, folder):
    prepared, state = _prepared(spark, folder)
    return prepared.select("customerID", *[f"`{n}`" for n in state.feature_names[len(SPEC.numericals):]])


@registered
def feature_matrix(spark, folder):
    prepared, state = _prepared(spark, folder)
    features.require_prepared(prepared, state, SPEC)
    return _rounded(prepared, 9, *state.feature_names[: len(SPEC.numericals)])


@registered
def transform_unseen(spark, folder):
    """Fitted on subscribers with internet, applied to dirty rows: unseen, null and padded values."""
    state = features.fit_state(_subscribers(spark, folder).where("InternetService <> 'No'"), SPEC)
    prepared = features.transform(_dirty(spark, folder).drop("Churn"), state, SPEC)
    return _rounded(prepared, 9, *state.feature_names[: len(SPEC.numericals)])


@registered
def filled_categories(spark, folder):
    state = features.fit_state(_subscribers(spark, folder).where("InternetService <> 'No'"), SPEC)
    return (
        features.filled_categories(_dirty(spark, folder), state, SPEC)
        .groupBy("column", "category")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


@registered
def processed_scan(spark, folder):
    """Prepared rows after being written and read back as a table: rows, and every category counted, per class."""
    prepared, state = _prepared(spark, folder)
    path = tables.write_table(prepared, work_folder(spark, "processed"))
    processed = tables.read_processed(spark, path, SPEC.target)
    return processed.groupBy("Churn").agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.sum(f"`{n}`").cast("bigint").alias(n) for n in state.feature_names[len(SPEC.numericals):]],
    )


# Training sets


@registered
def combine_training(spark, folder):
    parts = splits.three_way_split(_subscribers(spark, folder), "Churn", "customerID")
    return assembly.row_accounting(assembly.combine({
        "initial": parts.where("split = 'initial'"),
        "new": parts.where("split = 'new'").drop("TotalCharges"),
    }))


@registered
def class_weights(spark, folder):
    label = features.encoded_target(SPEC)
    return _subscribers(spark, folder).select("customerID", assembly.class_weight(label, 2.5).alias("weight"))


# Evaluation and promotion


def _metrics(spark, folder) -> DataFrame:
    return metrics.classification_metrics(view(spark, folder, "model_scores"), "label", SCORES)


@registered
def predicted_classes(spark, folder):
    scores = view(spark, folder, "model_scores")
    return (
        scores.select("label", metrics.predicted_class(F.col("production_score")).alias("prediction"))
        .groupBy("label", "prediction")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _supplier_confusion(spark, folder) -> DataFrame:
    scores = table(spark, folder, "lineitem").select(
        "l_suppkey",
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        (F.col("l_discount") * 10).alias("score"),
    )
    return metrics.confusion_counts(scores, "label", "score", "l_suppkey")


@registered
def confusion_counts(spark, folder):
    return _supplier_confusion(spark, folder)


@registered
def threshold_metrics(spark, folder):
    return _supplier_confusion(spark, folder).select(
        "l_suppkey", *[F.round(c, 9).alias(name) for name, c in metrics.threshold_metrics().items()]
    )


@registered
def classification_metrics(spark, folder):
    return _rounded(_metrics(spark, folder), 9, *metrics.METRICS)


@registered
def roc_auc(spark, folder):
    """AUC of scores with many distinct values: prices against the return flag."""
    prices = table(spark, folder, "lineitem").select(
        F.when(F.col("l_returnflag") == "R", 1).otherwise(0).alias("label"),
        F.col("l_extendedprice"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("discounted"),
    )
    found = metrics.classification_metrics(
        prices, "label", {"price": "l_extendedprice", "discounted": "discounted"}
    )
    return _rounded(found.select("model", "roc_auc"), 9, "roc_auc")


def _flat_evaluation(record: DataFrame, *more: str) -> DataFrame:
    sides = [
        F.round(F.col(f"{side}_metrics.{m}"), 9).alias(f"{side}_{m}")
        for side in ("candidate", "production")
        for m in metrics.METRICS
    ]
    return record.select(*sides, F.round("f1_improvement", 9).alias("f1_improvement"), *more)


@registered
def evaluation_record(spark, folder):
    return _flat_evaluation(metrics.evaluation_record(_metrics(spark, folder)), "candidate_better")


@registered
def promotion_decision(spark, folder):
    decided = promotion.with_decision(metrics.evaluation_record(_metrics(spark, folder)))
    return decided.select("decision")


@registered
def promotion_record(spark, folder):
    decided = promotion.with_decision(metrics.evaluation_record(_metrics(spark, folder)))
    return _flat_evaluation(promotion.promotion_record(decided), "decision")


@registered
def run_ledger(spark, folder):
    """The ledger rows of an evaluation: metrics, parameters and tags."""
    entries = promotion.evaluation_entries(metrics.evaluation_record(_metrics(spark, folder)))
    is_metric = F.col("kind") == "metric"
    return entries.select(
        "run_name", "run_type", "kind", "key",
        F.when(is_metric, F.round(F.col("value").try_cast("double"), 9)).alias("number"),
        F.when(~is_metric, F.col("value")).alias("text"),
    )


@registered
def registry_history(spark, folder):
    """The registry after a first model and three decisions: as measured, roles swapped, equal models."""
    root = work_folder(spark, "registry")
    registry = promotion.Registry(spark, f"{root}/registry")
    measured = tables.stored(metrics.evaluation_record(_metrics(spark, folder)), "evaluation")

    def roles(candidate: str, production: str) -> DataFrame:
        return measured.select(
            F.col(f"{candidate}_metrics").alias("candidate_metrics"), F.col(f"{production}_metrics").alias("production_metrics")
        )

    decisions = {
        "as_measured": roles("candidate", "production"), "swapped": roles("production", "candidate"),
        "equal": roles("candidate", "candidate"),
    }
    for name in ("first", *decisions):
        tables.write_table(measured, f"{root}/{name}")
    registry.promote(f"{root}/first")
    for name, evaluation in decisions.items():
        promotion.compare_and_promote(evaluation, f"{root}/{name}", registry, f"{root}/records")
    production = registry.production_path()
    return registry.entries().select(
        "version", F.substring_index("model_path", "/", -1).alias("model"), "status",
        (F.col("model_path") == production).alias("production"),
    )


@registered
def best_trial(spark, folder):
    """The best of as many trials as there are suppliers, each scored on its own line items."""
    trials = _supplier_confusion(spark, folder).select(
        F.col("l_suppkey").alias("trial"), metrics.threshold_metrics()["f1_score"].alias("objective")
    )
    return training.best_trial(trials)


# Training


_CLOSE = 1e-12


@registered
def train_and_score(spark, folder):
    """Boosted trees fitted on 80 % of the subscribers and scored on the rest, by the model and by walking its saved nodes."""
    prepared, state = _prepared(spark, folder)
    parts = splits.stratified_split(prepared, "Churn", "customerID", 0.2)
    train = assembly.features_and_label(parts.where("split = 'train'"), state.feature_names, "Churn")
    params = training.SearchProfile.smoke().draws(training.TUNE_SPACE)[0]
    trees = training.fit_trees(train, params)
    model = PipelineModel([assembly.assembler(state.feature_names), trees])
    walked = forest.Forest.load(spark, models.save_model(model, work_folder(spark, "model")))
    test = parts.where("split = 'test'")
    both = training.scored(walked, training.scored(model, test, "probability"), "walked")
    probability = F.col("probability")
    return both.select(
        "customerID", "Churn", probability.between(0, 1).alias("in_range"),
        (F.abs(F.col("walked") - probability) < _CLOSE).alias("follows_nodes"),
    )


@registered
def forest_scores(spark, folder):
    """Every subscriber scored by a forest whose nodes are made from the table: three trees of two levels that split numbers
    at their medians, and whose leaves hold how far the churn of the subscribers there is from a half."""
    subscribers = tables.stored(_subscribers(spark, folder).select(
        "customerID", "Churn", *[F.col(c).cast("double").alias(c) for c in ("tenure", "MonthlyCharges", "SeniorCitizen")]), "subscribers")
    names = ("tenure", "MonthlyCharges", "SeniorCitizen")
    medians, _ = ordered.exact_medians(subscribers, list(names))
    lines, nodes = [], []
    for tree, (first, then) in enumerate(zip(names, names[1:] + names[:1])):
        below, left = F.col(first) <= medians[first], F.col(then) <= medians[then]
        lines += [F.avg(F.when(c, F.when(F.col("Churn") == "Yes", 0.5).otherwise(-0.5))) for c in (below & left, below & ~left, ~below)]
        nodes.append((tree, first, then))
    shares = list(subscribers.agg(*[F.coalesce(c, F.lit(0.0)).alias(f"l{i}") for i, c in enumerate(lines)]).first())
    rows = []
    for tree, first, then in nodes:
        a, b, c = shares[3 * tree : 3 * tree + 3]
        weight = 1.0 / (tree + 1)
        rows += [
            (tree, weight, 0, first, medians[first], 1, 4, None), (tree, weight, 1, then, medians[then], 2, 3, None),
            *((tree, weight, node, None, None, None, None, value) for node, value in ((2, a), (3, b), (4, c))),
        ]
    scored = forest.Forest.of(spark.createDataFrame(rows, forest.NODE_SCHEMA)).scored(subscribers, "probability")
    return _rounded(scored.select("customerID", "probability"), 9, "probability")


@registered
def search_trials(spark, folder):
    """All twenty trials of the full search as their table keeps them: parameters drawn over the declared ranges, and whether
    metrics are in range, the objective is its own F1, and the candidate that was fitted anew repeats the best trial."""
    prepared, state = _prepared(spark, folder)
    profile_ = dataclasses.replace(training.SearchProfile.full(), parallelism=8)
    store = training.TrialStore(spark, work_folder(spark, "trials"), "search")
    candidate = training.train_candidate(
        prepared, state.feature_names, SPEC, training.RETRAIN_SPACE, profile_, store
    )
    trials = store.table()
    best = training.best_trial(trials).first()
    repeated = best["trial"] == candidate.best.number and best["objective"] == candidate.metrics["f1_score"]
    in_range = reduce(and_, [F.col(f"metrics.{m}").between(0, 1) for m in metrics.METRICS])
    return trials.select(
        "trial", "state", *[F.round(F.col("params")[name], 9).alias(name) for name in training.RETRAIN_SPACE],
        in_range.alias("in_range"), (F.col("objective") == F.col("metrics.f1_score")).alias("objective_is_f1"),
        F.lit(repeated).alias("best_is_repeated"),
    )


@registered
def resumed_search(spark, folder):
    """A search that stopped after two trials and was started again: what was finished is not fitted twice, and the whole
    search is the one that was never interrupted."""
    prepared, state = _prepared(spark, folder)
    path, profile_ = work_folder(spark, "trials"), training.SearchProfile.smoke()
    first = training.TrialStore(spark, path, "search")

    def search(trials: int, store: training.TrialStore) -> training.Candidate:
        return training.train_candidate(
            prepared, state.feature_names, SPEC, training.RETRAIN_SPACE, dataclasses.replace(profile_, trials=trials), store)

    search(2, first)
    before = tables.stored(first.table(), "trials-before").withColumn("written", F.lit("before"))
    search(profile_.trials, first)
    search(profile_.trials, training.TrialStore(spark, path, "uninterrupted"))
    columns = ["trial", "params", "metrics", "objective"]
    both = training.TrialStore(spark, path, "uninterrupted").table().select("trial", *[F.col(c).alias(f"other_{c}") for c in columns[1:]])
    return (
        first.table().join(both, "trial").join(before.select("trial", "written", F.col("objective").alias("kept")), "trial", "left")
        .select(
            "trial", F.coalesce("written", F.lit("after")).alias("written"),
            (F.map_entries("params") == F.map_entries("other_params")).alias("same_parameters"),
            ((F.col("metrics") == F.col("other_metrics")) & (F.col("objective") == F.coalesce("kept", "objective"))).alias("same_result"))
    )


@registered
def retraining_flow(spark, folder):
    """Both flows end to end with tiny models: rows of all parts, and whether decision and registry agree."""
    layout, profile_ = Layout(work_folder(spark, "project")), training.SearchProfile.smoke()
    run_bootstrap(spark, _subscribers(spark, folder), layout.root, SPEC, profile_)
    decision = run_retraining(spark, layout.data("new"), layout.root, SPEC, profile_)
    ledger = records.read_runs(spark, layout.ledger)
    sizes = ledger.where("run_type = 'retraining_candidate' AND kind = 'param' AND key LIKE '%\\_rows'").select(
        F.col("key").alias("name"), F.col("value").cast("bigint").alias("value")
    )
    promoted = Registry(spark, layout.registry).entries().where("status = 'promoted'").count()
    f1 = {
        r["key"]: float(r["value"])
        for r in ledger.where("run_type = 'model_promotion' AND key LIKE '%f1\\_score' AND kind = 'metric'").collect()
    }
    better = f1["candidate_f1_score"] > f1["production_f1_score"]
    # What was written as records is read back: the best parameters of the last search, and production's metrics.
    trials = trials_of(spark, layout.root, "retraining")
    best = training.best_trial(trials).first()
    best_params = records.read_record(spark, layout.record("best_params"), ", ".join(f"{n} double" for n in training.RETRAIN_SPACE)).first()
    evaluated = records.read_record(spark, layout.record("candidate_evaluation"), promotion.EVALUATION_SCHEMA).first()
    try:
        production = records.read_record(
            spark, tables.require_path(spark, layout.record("promotion/production_metrics"), "Production metrics"),
            f"model_name string, metrics {promotion.METRIC_STRUCT}").first()
    except FileNotFoundError:
        production = None
    promoted_metrics = (production["model_name"], production["metrics"]) if production else None
    more = {
        "tuning_trials": trials_of(spark, layout.root, "tuning").count(),
        "best_params_follow_trials": int(best_params.asDict() == best["params"]),
        "production_metrics_follow_decision": int(
            promoted_metrics == (("production_model", evaluated["candidate_metrics"]) if decision == "PROMOTE" else None)),
        "held_out_rows": tables.read_table(spark, layout.processed("held_out")).count(),
        "registry_entries": Registry(spark, layout.registry).entries().count(),
        "decision_follows_f1": int(decision == ("PROMOTE" if better else "REJECT")),
        "registry_follows_decision": int(promoted == (2 if decision == "PROMOTE" else 1)),
    }
    return sizes.unionByName(spark.createDataFrame(list(more.items()), "name string, value bigint"))


@registered
def model_saved(spark, folder):
    """Every subscriber scored by a model and by the same model after being saved and loaded."""
    prepared, _, model = _fitted(spark, folder)
    loaded = models.load_model(spark, models.save_model(model, work_folder(spark, "model")))
    both = training.scored(loaded, training.scored(model, prepared, "before"), "after")
    return both.select("customerID", (F.col("before") == F.col("after")).alias("same"), F.col("after").between(0, 1).alias("in_range"))


# Scoring


@registered
def request_errors(spark, folder):
    checked = scoring.with_request_errors(_dirty(spark, folder), SPEC)
    return checked.select("customerID", "gender", F.inline("errors"))


@registered
def request_error_counts(spark, folder):
    return scoring.error_counts(_dirty(spark, folder), SPEC)


@registered
def quarantine(spark, folder):
    return scoring.with_part(_dirty(spark, folder), SPEC).select("customerID", "part")


@registered
def prediction_response(spark, folder):
    return scoring.responses(_log(spark, folder), SPEC)


@registered
def prediction_log(spark, folder):
    """Log rows built from scored requests: no latency for refused ones, label from probability."""
    return scoring.prediction_log(
        _log(spark, folder), SPEC, F.col("request_id"), F.col("ts"), F.col("latency_seconds")
    ).withColumn("ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))


def _fitted(spark, folder):
    prepared, state = _prepared(spark, folder)
    rows = assembly.features_and_label(prepared, state.feature_names, "Churn")
    trees = training.fit_trees(rows, training.SearchProfile.smoke().draws(training.TUNE_SPACE)[0])
    return prepared, state, PipelineModel([assembly.assembler(state.feature_names), trees])


@registered
def score_requests(spark, folder):
    """Dirty requests scored with a fitted model: refused ones keep their errors."""
    _, state, model = _fitted(spark, folder)
    walked = forest.Forest.load(spark, models.save_model(model, work_folder(spark, "model")))
    requests = _dirty(spark, folder).withColumn("request", F.monotonically_increasing_id())
    requests = tables.stored(requests, "requests")
    scored, by_nodes = (scoring.score_requests(requests, state, SPEC, m) for m in (model, walked))
    both = scored.join(by_nodes.select("request", F.col("probability").alias("walked")), "request")
    return both.select(
        "customerID", "status", F.size("errors").alias("broken_rules"),
        F.coalesce(F.col("probability").between(0, 1), F.lit(False)).alias("has_probability"),
        F.coalesce(F.abs(F.col("probability") - F.col("walked")) < _CLOSE, F.col("probability").isNull() & F.col("walked").isNull()).alias("follows_nodes"),
    )


@registered
def stream_scoring(spark, folder):
    """The same requests through two streams into one folder, as if sent twice; the log they leave, counted per
    status and by the requests of each customer."""
    _, state, model = _fitted(spark, folder)
    source = tables.write_table(_dirty(spark, folder), work_folder(spark, "requests"))
    out = work_folder(spark, "scored")
    for _ in range(2):
        requests = spark.readStream.schema(spark.read.parquet(source).schema).parquet(source)
        request_id = F.expr("uuid()")
        score_stream(requests, state, SPEC, model, out, work_folder(spark, "progress"), request_id).awaitTermination()
    log = spark.read.parquet(f"{out}/log")
    return log.groupBy("customerID", "status").agg(F.count(F.lit(1)).alias("requests"))


# Monitoring


@registered
def log_totals(spark, folder):
    return monitoring.log_totals(_log(spark, folder))


@registered
def results_by_label(spark, folder):
    return monitoring.results_by_label(_log(spark, folder))


def _dashboard(spark, folder, *columns: str) -> DataFrame:
    windows = monitoring.dashboard(_log(spark, folder))
    return _rounded(windows.select(_minute("window_start"), _minute("window_end"), *columns), 9, *columns)


@registered
def request_rate(spark, folder):
    return _dashboard(spark, folder, "request_rate")


@registered
def error_rate(spark, folder):
    return _dashboard(spark, folder, "error_rate")


@registered
def success_rate(spark, folder):
    return _dashboard(spark, folder, "success_rate")


@registered
def avg_latency(spark, folder):
    return _dashboard(spark, folder, "avg_latency")


@registered
def p95_latency(spark, folder):
    return _dashboard(spark, folder, "p95_latency")


@registered
def p95_probability(spark, folder):
    return _dashboard(spark, folder, "p95_probability")


@registered
def hourly_dashboard(spark, folder):
    """All dashboard values in windows of one hour, which hold enough rows to be dense."""
    windows = monitoring.dashboard(_log(spark, folder), 3600, 3600)
    values = list(monitoring.dashboard_columns(3600))
    return _rounded(windows.select(_minute("window_start"), *values), 9, *values)


@registered
def latency_histogram(spark, folder):
    found = monitoring.histogram(_log(spark, folder), "latency_seconds", monitoring.LATENCY_BOUNDS, "status")
    return _rounded(found, 6, "sum")


@registered
def probability_histogram(spark, folder):
    return _rounded(
        monitoring.histogram(_log(spark, folder), "probability", monitoring.PROBABILITY_BOUNDS), 6, "sum"
    )


@registered
def merged_histogram(spark, folder):
    per_status = monitoring.histogram(
        _log(spark, folder), "latency_seconds", monitoring.LATENCY_BOUNDS, "status"
    )
    return _rounded(monitoring.merge_histograms(per_status), 6, "sum")


@registered
def last_values(spark, folder):
    windows = monitoring.dashboard(_log(spark, folder), 3600, 3600)
    return _rounded(
        monitoring.last_values(windows, "window_start", list(monitoring.dashboard_columns(3600))), 9, "value"
    )


@registered
def stream_rates(spark, folder):
    """The dashboard over the log as a stream. Rows of later days close all windows of the log."""
    static = table(spark, folder, "events")
    source, out, progress = (work_folder(spark, p) for p in ("events", "rates", "progress"))
    newest = tables.stored(static.orderBy(F.desc("ts")).limit(1), "newest")
    tables.write_table(static.coalesce(1), source)
    for days in (1, 2, 3):
        # Chained aggregations lag behind by a batch, so one closing row is not enough.
        tables.append_table(newest.withColumn("ts", F.col("ts") + F.expr(f"INTERVAL {days} DAY")), source)
    # A file is a batch, the oldest first.
    events = spark.readStream.schema(static.schema).option("maxFilesPerTrigger", 1).parquet(source)
    run_to_table(stream_dashboard(view_over(spark, "prediction_log", events=events)), out, progress)
    last = newest.select(F.col("ts").cast("timestamp")).scalar()
    values = list(monitoring.dashboard_columns(300))
    of_log = spark.read.parquet(out).where(F.col("window_start") <= last)
    return _rounded(of_log.select(_minute("window_start"), *values), 9, *values)


def _shuffled_log(spark, folder, parts: int = 3) -> tuple[DataFrame, str]:
    """The log as a stream whose rows come in no order of time, a part at a time, and the folder it reads."""
    static, source = table(spark, folder, "events"), work_folder(spark, "events")
    for number in range(parts):
        tables.append_table(static.where(F.pmod(F.xxhash64("event_id"), F.lit(parts)) == number).coalesce(1), source)
    events = spark.readStream.schema(static.schema).option("maxFilesPerTrigger", 1).parquet(source)
    return view_over(spark, "prediction_log", events=events), source


@registered
def stream_repaired(spark, folder):
    """The dashboard over a stream that delivers its rows in any order: late rows repair the windows they belong to."""
    log, _ = _shuffled_log(spark, folder, 2)
    out = work_folder(spark, "repaired")
    repair_to_table(log, out, work_folder(spark, "progress")).awaitTermination()
    values = list(monitoring.dashboard_columns(300))
    return _rounded(repaired_windows(spark, out).select(_minute("window_start"), *values), 9, *values)


@registered
def stream_last_values(spark, folder):
    """The last value of each series of a dashboard kept by a stream, its rows in any order."""
    log, _ = _shuffled_log(spark, folder, 2)
    out = work_folder(spark, "repaired")
    repair_to_table(log, out, work_folder(spark, "progress"), 3600, 3600).awaitTermination()
    windows = repaired_windows(spark, out)
    return _rounded(monitoring.last_values(windows, "window_start", list(monitoring.dashboard_columns(3600))), 9, "value")


@registered
def stream_totals(spark, folder):
    """Running counters over a stream that stops and is started again, as the totals of the log."""
    static, source = table(spark, folder, "events"), work_folder(spark, "events")
    out, progress = work_folder(spark, "counters"), work_folder(spark, "progress")
    for number in range(2):
        tables.append_table(static.where(F.pmod(F.xxhash64("event_id"), F.lit(2)) == number), source)
        events = spark.readStream.schema(static.schema).parquet(source)
        count_to_table(view_over(spark, "prediction_log", events=events), out, progress).awaitTermination()
    return counted_totals(spark, out)
