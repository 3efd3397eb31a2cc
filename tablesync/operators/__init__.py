from tablesync.operators.merge import (
    ACTION,
    apply_batch,
    change_feed,
    common_columns,
    delete_insert,
    latest_by_key,
    merge_stats,
    merge_with_actions,
    unique_by_key,
)
from tablesync.operators.quality import fail_flag, latest_version, null_keys, pk_violations, width_report
from tablesync.operators.reconcile import (
    compare_counts,
    compare_periods,
    period_counts,
    rows_in_wrong_periods,
    rows_to_resync,
)
from tablesync.operators.skew import heavy_key_hashes
from tablesync.operators.splits import key_histogram, split_bounds, splits_by_rows, splits_by_size
from tablesync.operators.watermark import batch_watermark, newest_or_default

__all__ = [
    "ACTION",
    "apply_batch",
    "batch_watermark",
    "change_feed",
    "common_columns",
    "compare_counts",
    "compare_periods",
    "delete_insert",
    "fail_flag",
    "heavy_key_hashes",
    "latest_by_key",
    "latest_version",
    "merge_stats",
    "merge_with_actions",
    "newest_or_default",
    "null_keys",
    "period_counts",
    "pk_violations",
    "rows_in_wrong_periods",
    "rows_to_resync",
    "key_histogram",
    "split_bounds",
    "splits_by_rows",
    "splits_by_size",
    "unique_by_key",
    "width_report",
]
