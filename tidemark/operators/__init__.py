"""DataFrame operators."""

from tidemark.operators.counts import (calendar_bound, count_metrics, recent_counts,
                                       recent_distinct, rolling_bound, typed_counts)
from tidemark.operators.gaps import gap_count, offset_gaps, offset_gaps_lead
from tidemark.operators.ingest import (FieldMap, IngestSpec, apply_spec, ingest_batch, ingest_many,
                                       skip_duplicates)
from tidemark.operators.joins import (new_values, not_in_values, unmatched, unmatched_count,
                                      validity_join, validity_join_count)
from tidemark.operators.reconcile import distinct_by_code, reconcile, unpivot_nonnull
from tidemark.operators.refresh import period_refresh, write_periodic
from tidemark.operators.runs import run_success_counts, run_success_report

__all__ = ["calendar_bound", "count_metrics", "recent_counts", "recent_distinct", "rolling_bound",
           "typed_counts", "gap_count", "offset_gaps", "offset_gaps_lead", "FieldMap",
           "IngestSpec", "apply_spec", "ingest_batch", "ingest_many", "skip_duplicates",
           "new_values", "not_in_values", "unmatched", "unmatched_count", "validity_join",
           "validity_join_count", "distinct_by_code", "reconcile", "unpivot_nonnull",
           "period_refresh", "write_periodic", "run_success_counts", "run_success_report"]
