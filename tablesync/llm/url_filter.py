"""Allow and block verdicts for URLs: host and path rules first, else a classifier.

The classifier is a logistic regression on hashed character n-grams of host and path, fitted on the
driver to a small labelled table of URLs (its rows are the bound of what comes to the driver). Its weights,
a vector of fixed length, go to the tasks with the function.

Defined results: a URL that is NULL or has no ``://`` has an empty host and path, no rule and is allowed
or blocked by the classifier's bias alone; a URL of any length is used whole; repeated rows get the same
verdict; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named

BUCKETS = 1 << 16
SIZES = (3, 4, 5)

#: (verdict, host, path). Fixed values of the query's contract.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: The default training table: url and blocked (0 or 1), tab-separated, below a line of names. Known public sites, each
#: with a path of its own, labelled by what they are known for.
LABELLED = Path(__file__).with_name("labelled_urls.tsv")


def _lower(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host after the first ``://`` (A-Z lower-cased) and the path behind it; empty where there is none."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda i: F.coalesce(F.regexp_extract(url, pattern, i), F.lit(""))
    return _lower(part(1)), part(2)


def _split(url: str) -> tuple[str, str]:
    rest = url.partition("://")[2]
    host = rest.split("/")[0].split("?")[0].split("#")[0]
    path = rest[len(host) :].split("?")[0].split("#")[0]
    return host.lower(), path


def _grams(host: str, path: str) -> list[int]:
    """Of host and path; what says nothing of the site is left out: ``www.`` and the last label."""
    out = []
    site = host.removeprefix("www.")
    for text in (f"^{site.rpartition('.')[0] or site}$", f">{path}<" if path else ""):
        data = text.encode("utf-8", "replace")
        out += [zlib.crc32(data[i : i + n]) % BUCKETS for n in SIZES for i in range(len(data) - n + 1)]
    return out


def labelled_urls(path: str | Path = LABELLED) -> list[tuple[str, bool]]:
    """(url, blocked) rows of a training table."""
    lines = Path(path).read_text(encoding="utf-8").splitlines()[1:]
    return [(url, flag == "1") for url, flag in (line.split("\t") for line in lines)]


def held_out(rows: list[tuple[str, bool]], folds: int = 5, limit: float = 0.45) -> dict[tuple[bool, bool], int]:
    """Number of URLs by (is blocked, judged blocked), each judged by a model that has not seen its host, without ``www.``."""
    fold = [zlib.crc32(_split(url)[0].removeprefix("www.").encode()) % folds for url, _ in rows]
    out = dict.fromkeys(((a, b) for a in (False, True) for b in (False, True)), 0)
    for k in range(folds):
        weights = train(row for row, own in zip(rows, fold) if own != k)
        for (url, is_blocked), own in zip(rows, fold):
            if own == k:
                out[is_blocked, blocked(weights, *_split(url)) >= limit] += 1
    return out


def train(labelled: Iterable[tuple[str, bool]] | None = None, rounds: int = 400, l2: float = 1e-3, bias: float = -1.0) -> np.ndarray:
    """Weights by hashed n-gram, the bias last, from (url, blocked) rows, those of ``LABELLED`` by default. The bias is fixed, not fitted: a URL
    of unknown n-grams is allowed, as is every URL when there are no rows."""
    rows = labelled_urls() if labelled is None else list(labelled)
    weights = np.zeros(BUCKETS + 1)
    weights[-1] = bias
    if not rows:
        return weights
    grams = [sorted(set(_grams(*_split(url)))) for url, _ in rows]
    seen = np.unique(np.array([g for own in grams for g in own], dtype=np.int64))
    x = np.zeros((len(rows), len(seen)))
    for i, own in enumerate(grams):
        x[i, np.searchsorted(seen, own)] = 1 / max(1.0, np.sqrt(len(own)))
    y = np.array([float(is_blocked) for _, is_blocked in rows])
    w = np.zeros(len(seen))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-(x @ w + bias)))
        w -= 4.0 * (x.T @ (p - y) + l2 * w) / len(rows)
    weights[seen] = w
    return weights


def blocked(weights: np.ndarray, host: str, path: str) -> float:
    """Probability that a URL is to be blocked."""
    grams = np.unique(np.array(_grams(host, path) if host or path else [], dtype=np.int64))
    z = weights[-1] + (weights[grams].sum() / max(1.0, np.sqrt(len(grams))) if len(grams) else 0.0)
    return float(1 / (1 + np.exp(-z)))


def judge_urls(pages: DataFrame, weights: np.ndarray | None = None, rules=RULES, limit: float = 0.45) -> DataFrame:
    """page_id, host, path, rule, verdict, score per page. The rule whose text is longest decides; of two of one
    length, the first listed."""
    weights = train() if weights is None else weights
    host, path = host_and_path(named(pages, "url"))
    df = pages.select(named(pages, "page_id").alias("page_id"), host.alias("host"), path.alias("path"))
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(reversed(rules), key=lambda r: len(r[1] + r[2])):
        fits = ((F.col("host") == rule_host) | F.col("host").endswith("." + rule_host)) & F.col("path").startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path).otherwise(rule)
        verdict = F.when(fits, kind).otherwise(verdict)
    df = df.withColumns({"rule": rule, "verdict": verdict})

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, given = (batch.column(i).to_pylist() for i in (1, 2, 4))
            scores = [blocked(weights, h, p) for h, p in zip(hosts, paths)]
            final = [v or ("block" if s >= limit else "allow") for v, s in zip(given, scores)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(4)), pa.array(final, pa.string()), pa.array(scores, pa.float64())],
                names=["page_id", "host", "path", "rule", "verdict", "score"],
            )

    kind = df.schema["page_id"].dataType.simpleString()
    return df.mapInArrow(score, f"page_id {kind}, host string, path string, rule string, verdict string, score double")
