from tablesync.streaming.latest_stream import newest_changes, settled_upsert_stream
from tablesync.streaming.upsert_stream import upsert_stream

__all__ = ["newest_changes", "settled_upsert_stream", "upsert_stream"]
