"""tidemark: data-quality and ingest operators for event tables on Spark.

Every public operator takes and returns DataFrames (or Columns) and is built
from the DataFrame / SQL API, so Catalyst plans and optimises it.

Main entry points::

    from tidemark import gap_count, offset_gaps, IngestSpec, ingest_batch, validity_join
"""

from tidemark.operators import (FieldMap, IngestSpec, apply_spec, count_metrics,
                                distinct_by_code, gap_count, ingest_batch, new_values,
                                not_in_values, offset_gaps, period_refresh, recent_counts,
                                reconcile, run_success_counts, skip_duplicates, typed_counts,
                                unmatched, unpivot_nonnull, validity_join)
from tidemark.session import ensure_checkpoint_dir, get_session, work_dir

__all__ = ["get_session", "ensure_checkpoint_dir", "work_dir", "FieldMap", "IngestSpec",
           "apply_spec", "count_metrics", "distinct_by_code", "gap_count", "ingest_batch",
           "new_values", "not_in_values", "offset_gaps", "period_refresh", "recent_counts",
           "reconcile", "run_success_counts", "skip_duplicates", "typed_counts", "unmatched",
           "unpivot_nonnull", "validity_join"]
