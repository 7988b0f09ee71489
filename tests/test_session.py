import os

import pytest

from churnflow.session import work_folder, work_scope
from churnflow.sources.tables import read_table, stored, write_table


def test_work_folders_go_with_their_scope(spark, tmp_path):
    kept = work_folder(spark, "kept")
    with work_scope(spark):
        inner = stored(spark.range(5), "inner")
        path = inner.inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0]
        with pytest.raises(RuntimeError), work_scope(spark):
            failed = work_folder(spark, "failed")
            write_table(spark.range(1), failed)
            raise RuntimeError
        assert not os.path.exists(failed) and os.path.exists(path)
        write_table(inner, kept)
    assert not os.path.exists(path) and read_table(spark, kept).count() == 5
    outside = stored(spark.range(3), "outside")
    assert outside.count() == 3


def test_entry_without_the_add_on(monkeypatch):
    """Without the subpackage or the pipeline, the other queries are registered."""
    import importlib
    import importlib.util

    import __spark_entry__

    find = importlib.util.find_spec
    whole = set(__spark_entry__.queries())
    try:
        for gone in ("churnflow.llm", "churnflow.llm.queries", "corpus_pipeline"):
            monkeypatch.setattr(importlib.util, "find_spec", lambda name, package=None, gone=gone: None if name == gone else find(name, package))
            rest = set(importlib.reload(__spark_entry__).queries())
            assert rest and rest <= whole and not any(n.startswith("op") or n == "pipeline" for n in rest)
    finally:
        monkeypatch.undo()
        assert set(importlib.reload(__spark_entry__).queries()) == whole
