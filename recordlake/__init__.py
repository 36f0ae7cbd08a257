"""Record streams landed in a queryable lake, and read back without guessing, on Spark DataFrames."""

from recordlake.functions.arguments import Start, parse_filters, parse_since
from recordlake.operators.decode import (
    BATCH,
    EVENT,
    decode,
    dispositions,
    flush_stats,
    render_reject,
    to_rejects,
    to_rows,
    with_rendered,
)
from recordlake.operators.lake import (
    any_tenant_app,
    dedupe,
    ids_in_order,
    lake_totals,
    list_items,
    partition_count,
    provenance_counts,
    register_views,
    tag,
    usage_by_tenant_day,
    with_provenance,
)
from recordlake.operators.retention import admit, retain_newest
from recordlake.operators.tail import json_lines, where_equals
from recordlake.operators.verify import (
    POLICIES,
    PolicyMismatch,
    contract_drift,
    held_policy,
    lake_differences,
    observed_fields,
    policy_diff,
    policy_rows,
    provision,
    sized,
    verify_lake,
)
from recordlake.schema import COLUMN_NAMES, COLUMNS, column_named
from recordlake.session import configure, local_session, scratch_path, shared_dir
from recordlake.sinks.deadletter import dead_once, dead_subject_for, distinct_dead, read_dead, to_dead, write_dead
from recordlake.sinks.lake import lake_path, write_lake
from recordlake.sinks.manifest import part_to_messages, read_manifest
from recordlake.sources.lake import SchemaMismatch, lake_parts, parts_lacking, read_lake
from recordlake.sources.raw import drop_duplicates, filter_subject, raw_stream, raw_table, subject_parts, with_sizes
from recordlake.sources.zones import read_zones, record_zones
from recordlake.streaming.drain import drain, flush, read_flushes
from recordlake.streaming.published import first_of_each, fold_published, publish_once
from recordlake.streaming.tail import Tail, follow, last_messages, since_age, tail, tail_rows, tail_stream

__all__ = [name for name in dir() if not name.startswith("_")]
