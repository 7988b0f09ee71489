import numpy as np
import pytest

from churnflow.operators import metrics


def labelled(spark, pairs):
    return spark.createDataFrame([(int(l), float(s)) for l, s in pairs], "label int, score double")


def measured(spark, pairs):
    return metrics.classification_metrics(labelled(spark, pairs), "label", {"m": "score"}).first()


def brute_auc(pairs):
    positive = np.array([s for l, s in pairs if l == 1])[:, None]
    negative = np.array([s for l, s in pairs if l == 0])[None, :]
    return float(((positive > negative) + 0.5 * (positive == negative)).mean())


def test_golden_confusion(spark):
    pairs = [(1, 0.9)] * 281 + [(0, 0.9)] * 230 + [(1, 0.1)] * 93 + [(0, 0.1)] * 805
    row = measured(spark, pairs)
    assert (row["tp"], row["fp"], row["fn"], row["tn"], row["n"]) == (281, 230, 93, 805, 1409)
    assert row["accuracy"] == 0.7707594038325053
    assert row["precision"] == 0.5499021526418787
    assert row["recall"] == 0.7513368983957219
    assert row["f1_score"] == 0.6350282485875707


@pytest.mark.parametrize("ranges", [1, 2, 7])
def test_auc_matches_all_pairs(spark, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        _check_auc(spark)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def _check_auc(spark):
    generator = np.random.default_rng(3)
    samples = {
        "continuous": generator.random(600),
        "ties": generator.integers(0, 5, 600) / 4,
        "hot score": np.where(generator.random(600) < 0.4, 0.25, generator.random(600)),
        "constant": np.full(600, 0.5),
        "crowded": 0.5 + generator.random(600) * 1e-12,
        "signed zero": np.where(generator.random(600) < 0.5, -0.0, 0.0),
    }
    for name, scores in samples.items():
        labels = (generator.random(600) < 0.3 + 0.4 * (scores > np.median(scores))).astype(int)
        pairs = list(zip(labels, scores))
        row = measured(spark, pairs)
        assert row["roc_auc"] == pytest.approx(brute_auc(pairs), abs=1e-12), name
        flipped = measured(spark, [(l, -s) for l, s in pairs])
        assert row["roc_auc"] + flipped["roc_auc"] == pytest.approx(1.0, abs=1e-12), name


def test_half_is_the_negative_class(spark):
    row = measured(spark, [(1, 0.5), (1, 0.5000001), (0, 0.5)])
    assert (row["tp"], row["fp"], row["fn"], row["tn"]) == (1, 0, 1, 1)


def test_zero_rules(spark):
    nothing_predicted = measured(spark, [(1, 0.1), (0, 0.2)])
    assert (nothing_predicted["precision"], nothing_predicted["f1_score"]) == (0.0, 0.0)
    one_class = measured(spark, [(0, 0.1), (0, 0.9)])
    assert one_class["roc_auc"] is None
    assert (one_class["precision"], one_class["recall"], one_class["f1_score"]) == (0.0, 0.0, 0.0)


@pytest.mark.parametrize("score", [None, float("nan")])
def test_missing_scores_fail(spark, score):
    df = spark.createDataFrame([(1, 0.5), (0, score)], "label int, score double")
    with pytest.raises(Exception, match="label or score is missing"):
        metrics.classification_metrics(df, "label", {"m": "score"}).collect()
    with pytest.raises(Exception, match="label or score is missing"):
        metrics.confusion_counts(df, "label", "score").collect()


def test_missing_labels_fail(spark):
    df = spark.createDataFrame([(1, 0.5), (None, 0.7)], "label int, score double")
    for counted in (lambda: metrics.confusion_counts(df, "label", "score"), lambda: metrics.classification_metrics(df, "label", {"m": "score"})):
        with pytest.raises(Exception, match="label or score is missing"):
            counted().collect()


def test_models_are_independent(spark):
    df = spark.createDataFrame([(1, 0.9, 0.1), (0, 0.2, 0.8), (1, 0.7, 0.6)], "label int, a double, b double")
    rows = {r["model"]: r for r in metrics.classification_metrics(df, "label", {"a": "a", "b": "b"}).collect()}
    assert rows["a"]["roc_auc"] == 1.0 and rows["b"]["roc_auc"] == 0.0
    record = metrics.evaluation_record(
        metrics.classification_metrics(df, "label", {"candidate": "a", "production": "b"})
    ).first()
    assert record["candidate_better"] is True
    assert record["f1_improvement"] == record["candidate_metrics"]["f1_score"] - record["production_metrics"]["f1_score"]
