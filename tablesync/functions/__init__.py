from tablesync.functions.columns import (
    audit_key,
    json_field,
    key_values,
    period,
    split_list,
    text_or_sentinel,
    ts_text,
    user_config,
)

__all__ = [
    "audit_key",
    "json_field",
    "key_values",
    "period",
    "split_list",
    "text_or_sentinel",
    "ts_text",
    "user_config",
]
