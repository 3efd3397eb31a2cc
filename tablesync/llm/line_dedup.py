"""Removal of lines that stand on many sites.

A line is compared without the white space around it. One HyperLogLog sketch of sites per line hash is
built and merged by Spark's aggregation. Lines whose estimate lies near the threshold get an exact count
of distinct sites; the others are far enough from it for the sketch to decide. Every occurrence of a
boilerplate line is then removed.

Defined results: NULL text stays NULL; a NULL site counts as one site; lines without a word are kept and
count for nothing; rows that repeat are treated alike; a text of boilerplate only becomes empty; an empty
table gives an empty result. Extra columns pass through, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, named, staged


@dataclass(frozen=True)
class Spread:
    """A line of ``min_words`` words or more on at least ``min_sites`` sites is boilerplate. Estimates within
    ``margin`` of the threshold are counted exactly; it is over ten standard errors of a sketch of 2**lg_k cells."""

    min_sites: int = 10
    min_words: int = 3
    margin: float = 0.25
    lg_k: int = 12


def line_key(line: Column) -> Column:
    """128 bits of a line without the white space around it, as binary."""
    return F.unhex(F.md5(F.btrim(line, F.lit(" \t\n\x0b\x0c\r"))))


def _lines(docs: DataFrame, key: Column, site: Column, text: str, rule: Spread) -> DataFrame:
    """One row (row, site, pos, hash) for each line long enough to be boilerplate."""
    gaps = rf"[^\x20\x09-\x0D]+(?:[\x20\x09-\x0D]+[^\x20\x09-\x0D]+){{{rule.min_words - 1}}}"
    return (
        docs.select(key.alias("row"), site.alias("site"), F.posexplode(F.split(named(docs, text), "\n")).alias("pos", "line"))
        .filter(F.col("line").rlike(gaps))
        .select("row", "site", "pos", line_key(F.col("line")).alias("hash"))
    )


def boilerplate(lines: DataFrame, rule: Spread = Spread()) -> DataFrame:
    """Hashes of the lines that stand on ``min_sites`` sites or more, from rows (hash, site)."""
    low, high = rule.min_sites * (1 - rule.margin), rule.min_sites * (1 + rule.margin)
    sketch = F.hll_sketch_estimate(F.hll_sketch_agg("site", F.lit(rule.lg_k)))
    spread = staged(
        lines.groupBy("hash").agg(sketch.alias("sites")).filter(F.col("sites") > low), "line-spread"
    )
    near = spread.filter(F.col("sites") <= high).select("hash")
    exact = (
        lines.join(near, "hash", "left_semi")
        .select("hash", "site")
        .distinct()
        .groupBy("hash")
        .agg(F.count(F.lit(1)).alias("sites"))
        .filter(F.col("sites") >= rule.min_sites)
    )
    return spread.filter(F.col("sites") > high).select("hash").unionByName(exact.select("hash"))


def drop_boilerplate(
    docs: DataFrame, site: str = "source", text: str = "text", removed: str | None = None, rule: Spread = Spread()
) -> DataFrame:
    """The documents without boilerplate lines; ``removed`` names a column for the number of lines taken out.

    Positions to cut are found per row content, so that only they and each text once are shuffled.
    """
    row, key, cut, parts, stay = free(docs, "row", "key", "cut", "parts", "stay")
    ident = [c for c in ("doc_id",) if c in docs.columns]
    content = F.md5(F.concat_ws("\x01", *(F.coalesce(named(docs, c).cast("string"), F.lit("\x02")) for c in (*ident, text))))
    source = F.coalesce(F.concat(F.lit("="), named(docs, site).cast("string")), F.lit("-"))
    lines = _lines(docs, F.unhex(content), source, text, rule)
    hits = lines.join(boilerplate(lines, rule), "hash", "left_semi").groupBy("row").agg(F.collect_set("pos").alias("cut"))
    hits = hits.select(F.col("row").alias(key), F.col("cut").alias(cut))
    joined = (
        docs.withColumn(row, F.unhex(content))
        .join(hits, F.col(row) == F.col(key), "left")
        .withColumn(parts, F.when(F.col(cut).isNotNull(), F.split(named(docs, text), "\n")))
        .withColumn(stay, F.expr(f"array_except(sequence(0, size({parts}) - 1), {cut})"))
    )
    rest = F.array_join(F.expr(f"transform({stay}, i -> {parts}[i])"), "\n")
    fresh = F.when(F.col(cut).isNull(), F.col(f"`{text}`")).otherwise(rest)
    columns = [fresh.alias(c) if c == text else F.col(f"`{c}`") for c in docs.columns]
    out = joined.select(*columns, *([F.when(F.col(cut).isNull(), 0).otherwise(F.size(cut)).cast("long").alias(removed)] if removed else []))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length(F.col(f"`{text}`")).cast(docs.schema["n_chars"].dataType))
    return out
