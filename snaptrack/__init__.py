"""snaptrack: version history for tables that only exist as full snapshots."""

from snaptrack.functions.compare import fingerprint
from snaptrack.meta import MetaColumns
from snaptrack.operators.checks import history_violations, key_violations
from snaptrack.operators.diff import (
    change_log,
    classify,
    closed_edited_rows,
    edited_keys,
    edited_rows,
    new_keys,
    new_rows,
)
from snaptrack.operators.history import build_history, run_rows
from snaptrack.operators.moves import classify_with_moves, moved_keys
from snaptrack.operators.reads import (
    as_of,
    change_summary,
    column_change_counts,
    explode_changes,
    join_as_of,
    timeline,
)
from snaptrack.operators.rows import (
    active_rows,
    close_rows,
    closed_rows,
    ensure_history,
    open_rows,
    rows_with_keys,
    union_all,
    value_columns,
)
from snaptrack.operators.summaries import merge_summaries, run_summaries
from snaptrack.operators.versions import coalesce_versions, rebuild_versions, thin_versions
from snaptrack.plans.late import insert_snapshot
from snaptrack.plans.partial import apply_changes
from snaptrack.plans.replay import apply_snapshot, replay
from snaptrack.session import session_conf
from snaptrack.sources.bucketed import buckets_for, write_bucketed
from snaptrack.sources.files import (
    ingest,
    read_csv,
    read_json,
    read_parquet,
    rejected_rows,
    s3a_conf,
    table_path,
    write_parquet,
)
from snaptrack.sources.history_table import HistoryTable
from snaptrack.sources.pointer import free_replaced, replace_parquet
from snaptrack.sources.run_log import StaleRun
from snaptrack.streaming.pickup import stream_history

__all__ = [
    "HistoryTable",
    "MetaColumns",
    "StaleRun",
    "active_rows",
    "apply_changes",
    "apply_snapshot",
    "as_of",
    "buckets_for",
    "build_history",
    "change_log",
    "change_summary",
    "classify",
    "classify_with_moves",
    "close_rows",
    "closed_edited_rows",
    "closed_rows",
    "coalesce_versions",
    "column_change_counts",
    "edited_keys",
    "edited_rows",
    "ensure_history",
    "explode_changes",
    "fingerprint",
    "free_replaced",
    "history_violations",
    "ingest",
    "insert_snapshot",
    "join_as_of",
    "key_violations",
    "merge_summaries",
    "moved_keys",
    "new_keys",
    "new_rows",
    "open_rows",
    "read_csv",
    "read_json",
    "read_parquet",
    "rebuild_versions",
    "rejected_rows",
    "replace_parquet",
    "replay",
    "rows_with_keys",
    "run_rows",
    "run_summaries",
    "s3a_conf",
    "session_conf",
    "stream_history",
    "table_path",
    "thin_versions",
    "timeline",
    "union_all",
    "value_columns",
    "write_bucketed",
    "write_parquet",
]
