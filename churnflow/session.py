"""Session settings and the shared folder for checkpoints and intermediate tables."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession


def build_session(app_name: str = "churnflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators expect; ``conf`` keys use ``__`` for dots.

    The number of shuffle partitions is left to the cluster: adaptive execution merges small
    partitions and splits skewed ones at run time.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        # Recording the call site of every column object makes wide plans slow to build.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir`` or set on the context."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def work_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder name below the checkpoint root; inside ``work_scope`` the folder goes when the scope ends."""
    path = f"{checkpoint_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
    if (scope := _scope.get()) is not None:
        scope.append(path)
    return path


_scope: ContextVar[list[str] | None] = ContextVar("work_scope", default=None)


@contextmanager
def work_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the work folders that are made inside, once they are no longer needed: results have to be written before.

    Operators keep intermediate tables in work folders, and the frames they return read them. What is to stay is written
    to a folder named outside of the scope.
    """
    folders: list[str] = []
    token = _scope.set(folders)
    try:
        yield
    finally:
        _scope.reset(token)
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
