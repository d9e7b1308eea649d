"""Incremental ingest with Structured Streaming.

``readStream`` (Kafka, or files in tests) -> envelope -> ``foreachBatch``:
map with the spec, skip duplicates against the target, append.  Offsets of
the source live in the checkpoint.  A micro-batch is appended under the query's
id and its number, so one that is replayed (after a lost executor or a restart)
appends nothing, whether its spec has keys or not.  Trigger
``availableNow`` gives the bounded, scheduled run; ``batch-size`` becomes
``maxOffsetsPerTrigger`` (Kafka) or ``maxFilesPerTrigger`` (files).
"""

from __future__ import annotations

import datetime as _dt
import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.ingest import IngestSpec, ingest_batch
from tidemark.operators.landing import Run
from tidemark.session import read_text


def query_id(spark: SparkSession, checkpoint_path: str) -> str:
    """Id of the query of a checkpoint (it is there before the first micro-batch;
    a checkpoint that is begun anew has another one)."""
    return json.loads(read_text(spark, f"{checkpoint_path.rstrip('/')}/metadata"))["id"]


BatchTime = _dt.datetime | Callable[[int], _dt.datetime] | None


def start_ingest(envelope_stream: DataFrame, spec: IngestSpec, target_path: str,
                 checkpoint_path: str, batch_time: BatchTime = None,
                 dedupe_keys: Sequence[str] | None = None, partition_by: Sequence[str] | None = None,
                 available_now: bool = True, processing_time: str | None = None) -> StreamingQuery:
    """Start the ingest query; ``batch_time`` is fixed or a function of the epoch id.

    ``available_now`` runs what is there and stops (the scheduled hourly run);
    otherwise the query runs continuously with a processing-time trigger of
    ``processing_time`` or the spec's ``batch-interval`` (taken as seconds; the
    configs do not state the unit).
    """

    def per_batch(batch: DataFrame, epoch_id: int) -> None:
        bt = batch_time(epoch_id) if callable(batch_time) else batch_time
        if bt is None:
            bt = _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        run = Run(query_id(batch.sparkSession, checkpoint_path), epoch_id)
        ingest_batch(batch.sparkSession, spec, batch, target_path, bt,
                     partition_by=partition_by, dedupe_keys=dedupe_keys, run=run)

    w = (envelope_stream.writeStream.foreachBatch(per_batch)
         .option("checkpointLocation", checkpoint_path))
    if available_now:
        w = w.trigger(availableNow=True)
    else:
        interval = processing_time or (f"{spec.batch_interval} seconds" if spec.batch_interval
                                       else None)
        if interval:
            w = w.trigger(processingTime=interval)
    return w.start()


def run_ingest(envelope_stream: DataFrame, spec: IngestSpec, target_path: str,
               checkpoint_path: str, batch_time: BatchTime = None,
               dedupe_keys: Sequence[str] | None = None, timeout_s: float | None = None,
               partition_by: Sequence[str] | None = None) -> None:
    """Run an ``availableNow`` ingest to completion (the hourly scheduled run)."""
    q = start_ingest(envelope_stream, spec, target_path, checkpoint_path, batch_time, dedupe_keys, partition_by)
    finish(q, timeout_s)


def finish(q: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait for the end of a bounded query; its failure is raised."""
    if timeout_s is None:
        q.awaitTermination()
    else:
        q.awaitTermination(timeout_s)
        if q.isActive:
            q.stop()
            raise TimeoutError("ingest did not finish in time")
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


__all__ = ["start_ingest", "run_ingest", "finish", "query_id"]
