"""Delimited text export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablesync.functions.columns import DSV_NULL, text_or_sentinel
from tablesync.operators.skew import name


def normalize(df: DataFrame, sentinel: str = DSV_NULL) -> DataFrame:
    """Lower-case column names, all values as text, NULL as the sentinel."""
    return df.select(*[text_or_sentinel(F.col(name(c)), sentinel).alias(c.lower()) for c in df.columns])


def export_delimited(
    df: DataFrame, path: str, delimiter: str = ",", header: bool = True, sentinel: str = DSV_NULL
) -> None:
    """Write delimited files, one per partition, quoting only where needed; quotes are doubled.

    Values are text before the writer sees them, so the sentinel is an ordinary value and an empty
    text stays empty.
    """
    (
        normalize(df, sentinel)
        .write.mode("overwrite")
        .options(sep=delimiter, header=header, quote='"', escape='"', emptyValue="", nullValue=sentinel)
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(path)
    )
