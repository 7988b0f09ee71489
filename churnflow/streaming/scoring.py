"""Scoring a stream of requests into response, quarantine and log tables."""

from __future__ import annotations

import json
import time
from collections.abc import Mapping

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from churnflow.operators.features import PrepState
from churnflow.operators.scoring import INVALID, prediction_log, responses, score_requests
from churnflow.spec import DatasetSpec
from churnflow.streaming.monitoring import ALL_THERE_IS


def score_stream(
    requests: DataFrame, state: PrepState, spec: DatasetSpec, model, folder: str, checkpoint: str,
    request_id: Column, ts: Column | None = None, trigger: Mapping | None = None,
) -> StreamingQuery:
    """Starts a query that scores every micro-batch; by default it stops when the source is used up.

    ``request_id`` names a request, not a customer, who may send many. Below ``folder``: ``responses``, ``rejected`` and
    ``log``, each with one folder per run and batch that is overwritten, so that a batch repeated after a failure
    leaves no row twice. A run is what its checkpoint says: a query started with a new checkpoint leaves the rows of
    earlier ones alone. The latency of a request is the time its micro-batch took to be scored.
    """
    ts = F.current_timestamp() if ts is None else ts

    def write(batch: DataFrame, batch_id: int) -> None:
        started = time.monotonic()
        run = json.loads(batch.sparkSession.read.text(f"{checkpoint}/metadata").first()[0])["id"]
        rows = score_requests(batch, state, spec, model).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rows.count()
            latency = F.lit(time.monotonic() - started)
            rejected = rows.where(F.col("status") == INVALID).drop("probability")
            outputs = {
                "responses": responses(rows, spec),
                "rejected": rejected,
                "log": prediction_log(rows, spec, request_id, ts, latency),
            }
            for name, frame in outputs.items():
                frame.write.mode("overwrite").parquet(f"{folder}/{name}/run_id={run}/batch_id={batch_id}")
        finally:
            rows.unpersist()

    return (
        requests.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or ALL_THERE_IS))
        .start()
    )
