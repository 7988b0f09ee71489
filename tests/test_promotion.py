import json
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

import pytest

from churnflow.operators import promotion
from churnflow.sources import records
from churnflow.sources.commits import CommitLog

BETTER = {"accuracy": 0.913, "precision": 0.551, "recall": 0.437, "f1_score": 0.487, "roc_auc": 0.771}
PRODUCTION = {"accuracy": 0.902, "precision": 0.529, "recall": 0.413, "f1_score": 0.464, "roc_auc": 0.748}
WORSE = {"accuracy": 0.897, "precision": 0.502, "recall": 0.391, "f1_score": 0.439, "roc_auc": 0.733}


def json_rows(path):
    return [json.loads(line) for file in Path(path).glob("part-*") for line in file.read_text().splitlines()]


@pytest.fixture
def world(spark, tmp_path):
    """A registry with one production model, and the files of two models."""
    for name in ("first", "second"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "model").write_text(name)
    registry = promotion.Registry(spark, str(tmp_path / "registry"))
    registry.promote(str(tmp_path / "first"))
    return tmp_path, registry


def decide(spark, world, candidate, production=PRODUCTION, path="second"):
    folder, registry = world
    evaluation = promotion.evaluation_frame(spark, candidate, production)
    return promotion.compare_and_promote(
        evaluation, str(folder / path), registry, str(folder / "records"), str(folder / "ledger")
    )


def test_better_candidate_becomes_production(spark, world):
    folder, registry = world
    assert decide(spark, world, BETTER) == "PROMOTE"
    assert registry.production_path() == str(folder / "second")
    assert json_rows(folder / "records/production_metrics") == [{"model_name": "production_model", "metrics": BETTER}]
    (record,) = json_rows(folder / "records/promotion_record")
    assert record["decision"] == "PROMOTE" and record["f1_improvement"] == 0.487 - 0.464
    ledger = {(r["kind"], r["key"]): r["value"] for r in records.read_runs(spark, str(folder / "ledger")).collect()}
    assert ledger["tag", "decision"] == "PROMOTE"
    assert float(ledger["metric", "candidate_f1_score"]) == 0.487
    assert float(ledger["metric", "production_f1_score"]) == 0.464


def test_worse_candidate_leaves_production_alone(spark, world):
    folder, registry = world
    assert decide(spark, world, WORSE) == "REJECT"
    assert registry.production_path() == str(folder / "first")
    assert (folder / "first" / "model").read_text() == "first"
    assert not (folder / "records/production_metrics").exists()
    (record,) = json_rows(folder / "records/promotion_record")
    assert record["decision"] == "REJECT"
    assert record["f1_improvement"] == 0.439 - 0.464
    assert record["candidate_metrics"] == WORSE and record["production_metrics"] == PRODUCTION
    assert [r["status"] for r in registry.entries().orderBy("version").collect()] == ["promoted", "rejected"]


def test_equal_f1_is_rejected(spark, world):
    assert decide(spark, world, BETTER | {"f1_score": 0.464}) == "REJECT"


def test_missing_candidate_cannot_be_promoted(spark, world):
    folder, registry = world
    with pytest.raises(FileNotFoundError, match="Candidate model not found"):
        decide(spark, world, BETTER, path="third")
    assert registry.production_path() == str(folder / "first")


def test_record_without_production_metrics(spark, tmp_path):
    promotion.save_promotion_record(spark, BETTER, None, "PROMOTE", str(tmp_path / "record"))
    (record,) = json_rows(tmp_path / "record")
    assert record.get("f1_improvement") is None and record.get("production_metrics") is None
    assert record["candidate_metrics"] == BETTER


def test_decision_needs_both_sides(spark, world):
    with pytest.raises(ValueError, match="both the candidate and production"):
        decide(spark, world, BETTER, production=None)


def test_many_writers_at_once(spark, tmp_path):
    """Versions are consecutive, each once, and each names its own writer."""
    registry = promotion.Registry(spark, str(tmp_path / "registry"))
    with ThreadPoolExecutor(16) as pool:
        versions = list(pool.map(lambda i: registry.record(f"m{i}", "promoted" if i % 2 else "rejected"), range(60)))
    assert sorted(versions) == list(range(1, 61))
    entries = {r["version"]: r["model_path"] for r in registry.entries().collect()}
    assert entries == {v: f"m{i}" for i, v in enumerate(versions)}
    newest = max(v for i, v in enumerate(versions) if i % 2)
    assert registry.production_path() == entries[newest]
    # Nothing but entries is left behind.
    assert {p.name for p in (tmp_path / "registry").iterdir() if not p.name.endswith(".crc")} == {f"{v:012d}.json" for v in range(1, 61)}


@pytest.mark.parametrize("link", [True, False])
def test_a_number_is_claimed_once(spark, tmp_path, monkeypatch, link):
    """By a link, and by the rename that other file systems use."""
    log = CommitLog(spark, str(tmp_path / "log"))
    if not link:
        monkeypatch.setattr(log, "_fs", Elsewhere(log._fs))
    assert log.newest() == 0
    assert log.claim(1, {"by": "first"}) and not log.claim(1, {"by": "second"})
    assert log.append(lambda n: {"by": n}) == 2 and log.newest() == 2
    assert (tmp_path / "log" / "000000000001.json").read_text() == '{"by": "first"}\n'


class Elsewhere:
    """A local file system that says it is another one."""

    def __init__(self, fs):
        self.fs = fs

    def __getattr__(self, name):
        return getattr(self.fs, name)

    def getUri(self):
        return self

    def getScheme(self):
        return "other"


def test_empty_registry_has_no_production(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="Production model not found"):
        promotion.Registry(spark, str(tmp_path / "none")).production_path()
