from tablesync.plans.staging import Staged, merge_into, stage
from tablesync.plans.sync import SyncResult, SyncSettings, SyncTask, run_all, run_one

__all__ = ["Staged", "SyncResult", "SyncSettings", "SyncTask", "merge_into", "run_all", "run_one", "stage"]
