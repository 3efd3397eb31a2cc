from tablesync.sinks.bucketed import BucketedDir
from tablesync.sinks.ddl import add_column_ddl, missing_fields
from tablesync.sinks.delimited import export_delimited, normalize
from tablesync.sinks.partitioned import PartitionedDir
from tablesync.sinks.publish import compact, empty_clone, key_first, publish_table, upsert_keyed
from tablesync.sinks.versioned import VersionedDir

__all__ = [
    "BucketedDir",
    "PartitionedDir",
    "VersionedDir",
    "add_column_ddl",
    "compact",
    "empty_clone",
    "export_delimited",
    "key_first",
    "missing_fields",
    "normalize",
    "publish_table",
    "upsert_keyed",
]
