"""Driver tables in the roles of the warehouse tables, and the specs used on them.

* ``events`` is the landing table: ``event_type`` = topic, ``event_id`` =
  offset, ``user_id`` mod 4 = partition, ``ts`` = load / received time (UTC),
  ``props`` = JSON message, its key ``k`` = payload key.

``AS_OF`` stands for ``sysdate``.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.operators.ingest import FieldMap, IngestSpec
from tidemark.sources.kafka import table_as_envelope
from tidemark.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = _dt.datetime(2024, 1, 31, 0, 0, 0)
BATCH_TIME = _dt.datetime(2024, 1, 31, 0, 0, 0)
REPLAY_TIME = _dt.datetime(2024, 1, 31, 1, 0, 0)
OFFSET_FLOOR = 1000
N_PARTITIONS = 4


def _ms(y: int, m: int, d: int) -> int:
    return int(_dt.datetime(y, m, d, tzinfo=_dt.timezone.utc).timestamp() * 1000)


SLICE = (_ms(2024, 1, 10), _ms(2024, 1, 12))
REPLAY_A = (_ms(2024, 1, 5), _ms(2024, 1, 15))
REPLAY_B = (_ms(2024, 1, 10), _ms(2024, 1, 20))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_envelope(spark: SparkSession, sf_dir: str, start_ms: int | None = None,
                    stop_ms: int | None = None) -> DataFrame:
    """``events`` seen as consumed messages (slice bounds reach the scan)."""
    return table_as_envelope(table(spark, sf_dir, "events"), message="props", topic="event_type",
                             offset="event_id", ts="ts", partition="user_id",
                             n_partitions=N_PARTITIONS, start_ms=start_ms, stop_ms=stop_ms)


# Column names of the warehouse tables that users query.
#   landing table: melding, kafka_topic, kafka_offset, kafka_mottatt_dato,
#                  kafka_partition, lastet_dato, ytelse_type, type_stonad
#   identity dimension: off_id, skjermet_kode, gyldig_fra_dato, gyldig_til_dato
#   period settings: periode, periode_fom, periode_tom, max_vedtaksdato, gyldig_flagg
# Ingest spec in the shape of the consumer configs (our own topic and literal).
LANDING_SPEC = {
    "source": {"type": "kafka", "batch-size": 10000, "batch-interval": 5, "topic": "{}",
               "group-id": "tidemark", "schema": "json", "keypath-seperator": "/"},
    "target": {"type": "parquet", "table": "events_landing",
               "skip-duplicates-with": ["kafka_offset", "kafka_topic", "kafka_partition"]},
    "transform": [
        {"src": "kafka_message", "dst": "melding"},
        {"src": "kafka_topic", "dst": "kafka_topic"},
        {"src": "kafka_offset", "dst": "kafka_offset"},
        {"src": "kafka_timestamp", "dst": "kafka_mottatt_dato", "fun": "int-unix-ms -> datetime-no"},
        {"src": "kafka_partition", "dst": "kafka_partition"},
        {"src": "$$$BATCH_TIME", "dst": "lastet_dato"},
        {"src": "k", "dst": "ytelse_type"},
        {"src": "$EVENTS", "dst": "type_stonad"},
    ],
}


def landing_spec(topic: str | None = None, literal: str | None = None) -> IngestSpec:
    spec = IngestSpec.from_dict(LANDING_SPEC, topic=topic)
    if literal is None:
        return spec
    tr = tuple(FieldMap(f"${literal}", f.dst) if f.dst == "type_stonad" else f
               for f in spec.transform)
    return IngestSpec(**{**spec.__dict__, "transform": tr})


def spec_without(spec: IngestSpec, *dst: str) -> IngestSpec:
    tr = tuple(f for f in spec.transform if f.dst not in dst)
    return IngestSpec(**{**spec.__dict__, "transform": tr})
