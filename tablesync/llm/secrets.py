"""Secret scans in DataFrame expressions only: fixed patterns, and strings that look random.

The patterns (assignments, access keys, long hexadecimal runs) give the base spans. Other long tokens are
scored by two character Markov models, one of random strings and one of ordinary identifiers, trained
from samples that the patterns label; a token whose log-likelihood ratio is high enough adds a span of kind
``markov``.

Spans are positions in code points, the end exclusive. Defined results: a NULL or empty text has no spans; the
hash of no spans is that of the empty string; repeated rows get equal results; an empty table gives an empty
result and models of smoothing alone. Texts are used whole whatever their length. Other columns pass through.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bounded_sample, free, named

#: Kind, pattern, group whose length counts, least length. Fixed values of the query's contract; for access and
#: hex the least length is part of the pattern, which finds the same spans.
_KEYWORD = "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
PATTERNS = (
    ("assign", _KEYWORD + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]{16,}", 0, 20),
    ("hex", "[0-9a-f]{24,}", 0, 24),
)
#: Tokens that the Markov models judge.
TOKEN = "[A-Za-z0-9+/_=-]{16,}"
#: Shorter tokens also train the model of ordinary identifiers.
WORDLIKE = "[A-Za-z0-9+/_=-]{4,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789+/_=-."
#: Matches are placed in blocks of this many, so that many matches in one text cost no quadratic copying.
BLOCK = 500


@dataclass(frozen=True)
class Markov:
    """About ``sample_rows`` documents train the models. A token is random when its log-likelihood ratio is at
    least ``per_char`` nats a character and ``total`` nats in all."""

    sample_rows: int = 4000
    smoothing: float = 0.5
    per_char: float = 0.5
    total: float = 10.0


def _placed(df: DataFrame, text: str, pattern: str, group: int, least: int, out: str) -> DataFrame:
    """Add an array column of structs (start, end, value) of the pattern's matches, in order.

    Splitting at the pattern gives the lengths of what lies between the matches; their running sum gives
    the places.
    """
    found, values, gaps, blocks = free(df, "found", "values", "gaps", "blocks")
    body, rx = named(df, text), F.lit(pattern)
    df = df.withColumn(found, F.regexp_extract_all(body, rx, F.lit(0)))
    df = df.withColumn(values, F.regexp_extract_all(body, rx, F.lit(group)) if group else F.col(found))
    some = F.size(found) > 0
    df = df.withColumn(gaps, F.when(some, F.transform(F.split(body, pattern), lambda x: F.length(x))))
    block = (
        f"transform(sequence(0, (size({found}) - 1) div {BLOCK}), b -> aggregate("
        f"sequence(b * {BLOCK}, least((b + 1) * {BLOCK}, size({found})) - 1), "
        f"struct(0L AS at, CAST(array() AS array<struct<s:bigint,e:bigint,v:string>>) AS out), "
        f"(a, i) -> struct(a.at + {gaps}[i] + length({found}[i]) AS at, IF(length({values}[i]) < {least}, a.out, "
        f"concat(a.out, array(struct(a.at + {gaps}[i] AS s, a.at + {gaps}[i] + length({found}[i]) AS e, "
        f"{values}[i] AS v)))) AS out)))"
    )
    df = df.withColumn(blocks, F.when(some, F.expr(block)))
    joined = (
        f"flatten(aggregate({blocks}, struct(0L AS at, CAST(array() AS array<array<struct<s:bigint,e:bigint,v:string>>>) AS out), "
        f"(a, b) -> struct(a.at + b.at AS at, concat(a.out, array(transform(b.out, x -> "
        f"struct(x.s + a.at AS s, x.e + a.at AS e, x.v AS v)))) AS out)).out)"
    )
    empty = F.expr("CAST(array() AS array<struct<s:bigint,e:bigint,v:string>>)")
    return df.withColumn(out, F.coalesce(F.when(some, F.expr(joined)), empty)).drop(found, values, gaps, blocks)


def base_spans(docs: DataFrame, text: str = "text") -> tuple[DataFrame, list[str]]:
    """The documents with one array column of matches for each pattern, and those columns' names."""
    names = free(docs, *(kind for kind, *_ in PATTERNS))
    for (_, pattern, group, least), name in zip(PATTERNS, names):
        docs = _placed(docs, text, pattern, group, least, name)
    return docs, names


def train(docs: DataFrame, text: str = "text", how: Markov = Markov()) -> list[float]:
    """Log-likelihood ratios of character pairs, row by row of the alphabet (``ALPHABET`` folded to lower case).

    Random strings are the values that the patterns find in the sample, half and half with even letters; ordinary
    identifiers are the tokens of its texts without them. One count per label and pair comes to the driver.
    """
    keys = [c for c in ("doc_id", text) if c in docs.columns]
    sample = bounded_sample(docs.select(*(named(docs, k) for k in keys)), how.sample_rows, *keys)
    spans, names = base_spans(sample, text)
    values = F.concat(*(F.transform(F.col(n), lambda x: x["v"]) for n in names))
    rest = named(sample, text)
    for _, pattern, _, _ in PATTERNS:
        rest = F.regexp_replace(rest, pattern, " ")
    random = spans.select(F.lit(1).alias("label"), F.explode(values).alias("t"))
    plain = sample.select(F.lit(0).alias("label"), F.explode(F.regexp_extract_all(rest, F.lit(WORDLIKE), F.lit(0))).alias("t"))
    pair = F.transform(F.sequence(F.lit(1), F.length("t") - 1), lambda i: F.substring(F.lower(F.col("t")), i, F.lit(2)))
    rows = (
        random.unionByName(plain)
        .filter(F.length("t") > 1)
        .select("label", F.explode(pair).alias("pair"))
        .groupBy("label", "pair")
        .count()
        .collect()
    )
    size = len(ALPHABET)
    counts = np.zeros((2, size, size))
    for label, pair_text, n in rows:
        a, b = ALPHABET.find(pair_text[0]), ALPHABET.find(pair_text[1])
        if a >= 0 and b >= 0:
            counts[label, a, b] += n
    # Pairs are smoothed by how common their second character is, characters by an even share.
    single = counts.sum(axis=1) + how.smoothing
    single /= single.sum(axis=1, keepdims=True)
    model = (counts + single[:, None, :]) / (counts.sum(axis=2, keepdims=True) + 1)
    # The patterns find random strings of few alphabets; others are as likely.
    model[1] = (model[1] + 1 / size) / 2
    model = np.log(model)
    return [float(x) for x in (model[1] - model[0]).round(6).ravel()]


def _ratio(token: str, model: str) -> str:
    size = len(ALPHABET)
    at = f"locate(substr(lower({token}), {{}}, 1), '{ALPHABET}')"
    return (
        f"aggregate(sequence(2, length({token})), 0D, (a, i) -> a + "
        f"{model}[({at.format('i - 1')} - 1) * {size} + {at.format('i')} - 1])"
    )


def scan(docs: DataFrame, model: list[float], text: str = "text", how: Markov = Markov()) -> DataFrame:
    """The documents with n_assign, n_access, n_hex, base_sha256, spans and n_markov."""
    body, table, random = free(docs, "body", "ratios", "markov")
    df = docs.withColumn(body, F.coalesce(named(docs, text), F.lit("")))
    df, names = base_spans(df, body)
    (tokens,) = free(df, "tokens")
    df = _placed(df, body, TOKEN, 0, 16, tokens)
    literal = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")
    df = df.withColumn(table, F.when(F.size(tokens) > 0, literal))
    taken = f"concat({', '.join(names)})"
    apart = f"NOT exists({taken}, y -> y.s < x.e AND x.s < y.e)"
    df = df.withColumn(
        random,
        F.expr(
            f"filter({tokens}, x -> {_ratio('x.v', table)} >= greatest({how.total}D, {how.per_char}D * length(x.v)) AND {apart})"
        ),
    )

    def listed(columns: list[str], kinds: list[str]) -> Column:
        parts = [
            F.expr(f"transform({c}, x -> struct(x.s AS s, {k} AS k, x.e AS e, '{kind}' AS kind))")
            for k, (c, kind) in enumerate(zip(columns, kinds))
        ]
        each = lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string"))
        return F.array_join(F.transform(F.array_sort(F.concat(*parts)), each), ",")

    kinds = [kind for kind, *_ in PATTERNS]
    result = {f"n_{kind}": F.size(c).cast("long") for kind, c in zip(kinds, names)}
    result["base_sha256"] = F.sha2(listed(names, kinds), 256)
    result["spans"] = listed([*names, random], [*kinds, "markov"])
    result["n_markov"] = F.size(random).cast("long")
    own = [named(df, c) for c in docs.columns if c.lower() not in result]
    return df.select(*own, *(c.alias(name) for name, c in result.items()))
