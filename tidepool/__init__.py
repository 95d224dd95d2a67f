"""tidepool: lakehouse data jobs as DataFrame operators on plain Apache Spark.

Every operator takes and returns DataFrames (or writes a folder and returns
its path). The main entry points:

Ingestion and sinks
    read_csv, read_json, read_csv_permissive, unify, with_source_metadata,
    infer_with_hints, merge_schemas, parse_with_rescue, copy_into, read_loaded,
    write_partitioned, overwrite_partitions, replace_where
Relational building blocks
    sized_broadcast, latest_per_key, top_n_per_group, salted_agg,
    global_row_number, global_ntile, keyed_running
Windows
    sessionize, rfm_scores
Upserts and dimensions
    merge, MergeBuilder, WhenMatched, WhenNotMatched, WhenNotMatchedBySource,
    merge_into_buckets, write_bucketed, scd2_merge, auto_cdc_scd2
Versions and change feeds
    commit_insert, commit_update, commit_delete, diff_changes, as_of_version,
    as_of_timestamp, snapshot, history, restore, first_version_where,
    changes_between, apply_changes, append_changes, read_changes, state_at,
    net_changes, undo
Schema and quality
    Rule, RuleSet, not_null, split, validate, violation_counts, expect,
    quality_report, profile, enforce, evolve_append, Expectation, write_expected
Sketches and samples
    store_daily, merge_sketches, estimates, trailing_days, bottom_k, merge_samples,
    with_weights
Layout
    compact, zorder, LayoutSpec, apply_clustering, file_report, skipping_report,
    orphan_files, footer_stats, footer_report
Streaming
    drain, drain_all, auto_cdc_stream, ProgressLog, read_progress, state_rows

Sessions: ``get_spark`` for local runs; on a cluster pass your own session.
Scratch output goes under the session's ``spark.checkpoint.dir``.
"""

from .operators.change_table import append_changes, net_changes, read_changes, state_at, undo
from .operators.changelog import (apply_changes, as_of_timestamp, as_of_version, changes_between, commit_delete,
                                  commit_insert, commit_update, diff_changes, first_version_where, history, restore,
                                  snapshot)
from .operators.footers import footer_report, footer_stats
from .operators.layout import (LayoutSpec, apply_clustering, compact, file_report, orphan_files, skipping_report,
                               zorder)
from .operators.merge import (MergeBuilder, WhenMatched, WhenNotMatched, WhenNotMatchedBySource, merge,
                              merge_into_buckets, write_bucketed)
from .operators.quality import (Expectation, Rule, RuleSet, enforce, evolve_append, expect, not_null,
                                profile, quality_report, split, validate, violation_counts, write_expected)
from .operators.relational import (global_ntile, global_row_number, latest_per_key, salted_agg, sized_broadcast,
                                   top_n_per_group)
from .operators.sampling import bottom_k, merge_samples, with_weights
from .operators.scan import keyed_running
from .operators.scd import auto_cdc_scd2, scd2_merge
from .operators.sketches import estimates, merge_sketches, store_daily, trailing_days
from .operators.windows import rfm_scores, sessionize
from .session import get_spark, scratch_path
from .sources.files import (copy_into, infer_with_hints, merge_schemas, parse_with_rescue, read_csv,
                            read_csv_permissive, read_json, read_loaded, unify, with_source_metadata)
from .sources.sinks import overwrite_partitions, replace_where, write_partitioned
from .streaming.cdc import auto_cdc_stream
from .streaming.monitor import ProgressLog, read_progress, state_rows
from .streaming.runner import drain, drain_all

__all__ = [name for name in dir() if not name.startswith("_")]
