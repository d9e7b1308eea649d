"""Sources and sinks."""

from tidemark.sources.kafka import (kafka_to_envelope, read_slice, read_stream, slice_bounds,
                                    slice_envelope, stream_for_spec, table_as_envelope)
from tidemark.sources.tables import (copy_table, copy_tables, export_csv, load_csv,
                                     load_csv_replace, read_table, stream_table)

__all__ = ["kafka_to_envelope", "read_slice", "read_stream", "slice_bounds", "slice_envelope",
           "stream_for_spec", "table_as_envelope",
           "copy_table", "copy_tables", "export_csv", "load_csv", "load_csv_replace", "read_table",
           "stream_table"]
