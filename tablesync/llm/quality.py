"""Quality rules with verdicts by host, in DataFrame expressions only.

Every document is measured by its words, lines and symbols. Rule failures are counted by host, each
host's failure rate is shrunk towards the corpus by a beta prior fitted to the rates of all hosts, and
a rule is enforced at the hosts whose shrunk rate reaches ``reject_rate``. A document is rejected when
it breaks a base rule, or a further rule that is enforced at its host.

Defined results: a NULL or empty text has no words and so fails the base rule; NULL is a host of its
own; repeated rows are judged each for itself and count each; an empty table gives an empty result.
Extra columns pass through ``measure`` and ``judge`` whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, named, staged, words

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SYMBOLS = "[#*$%&|<>]"


@dataclass(frozen=True)
class Rules:
    """A text fails with fewer than ``min_words`` words or more than ``repeat_pct`` % repeated ones (base),
    and breaks a host rule above ``symbol_pct`` symbols per 100 words, ``dup_line_pct`` % repeated lines, or
    a mean word length outside ``word_length``."""

    min_words: int = 50
    repeat_pct: int = 50
    symbol_pct: int = 10
    dup_line_pct: int = 50
    word_length: tuple[int, int] = (2, 12)
    reject_rate: float = 0.02
    #: Bounds of the prior's weight in documents.
    prior_weight: tuple[float, float] = (2.0, 1e6)


HOST_RULES = ("symbols", "dup_lines", "word_length")


def repeat_words(df: DataFrame, w: str, out: str) -> DataFrame:
    """Number of words inside a window of three words that the text holds twice or more.

    Window hashes with their positions in the low bits are sorted as plain longs; windows whose hash has
    an equal neighbour are then compared by their words, so the count is exact.
    """
    n, mask, keys, cand, found = free(df, "n", "mask", "keys", "cand", "found")
    last = f"{n} - 3"
    hashed = f"xxhash64({w}[i], {w}[i + 1], {w}[i + 2])"
    gram = f"concat_ws(' ', {w}[int(k & {mask})], {w}[int(k & {mask}) + 1], {w}[int(k & {mask}) + 2])"
    same = f"(k & ~{mask}) = ({keys}[{{}}] & ~{mask})"
    equal = f"c.g = {cand}[{{}}].g"
    beside = "(j > 0 AND {}) OR (j < size({}) - 1 AND {})"
    return (
        df.withColumn(n, F.size(w))
        .withColumn(mask, F.expr(f"shiftleft(1L, length(bin({n}))) - 1L"))
        .withColumn(
            keys,
            F.expr(
                f"IF({n} < 3, array(), "
                f"array_sort(transform(sequence(0, greatest({last}, 0)), i -> ({hashed} & ~{mask}) | bigint(i))))"
            ).cast("array<bigint>"),
        )
        .withColumn(
            cand,
            F.expr(
                f"array_sort(transform(filter({keys}, (k, j) -> "
                f"{beside.format(same.format('j - 1'), keys, same.format('j + 1'))}), "
                f"k -> struct({gram} AS g, int(k & {mask}) AS p)))"
            ),
        )
        .withColumn(
            found,
            F.expr(
                f"array_sort(transform(filter({cand}, (c, j) -> "
                f"{beside.format(equal.format('j - 1'), cand, equal.format('j + 1'))}), c -> c.p))"
            ),
        )
        .withColumn(
            out,
            F.expr(
                f"aggregate(transform({found}, (p, j) -> IF(j < size({found}) - 1, "
                f"least(3, {found}[j + 1] - p), 3)), 0L, (a, x) -> a + x)"
            ),
        )
        .drop(n, mask, keys, cand, found)
    )


def measure(docs: DataFrame, out: str, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The documents with a struct column ``out``: measures, ``base_failed`` and one flag for each host rule."""
    w, lines, repeated = free(docs, "w", "lines", "repeated")
    body = F.coalesce(named(docs, text), F.lit(""))
    df = docs.withColumn(w, words(named(docs, text))).withColumn(
        lines, F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    )
    df = repeat_words(df, w, repeated)
    n_words = F.size(w).cast("long")
    chars = F.length(F.array_join(w, "")).cast("long")
    symbols = F.regexp_count(body, F.lit(SYMBOLS)).cast("long")
    dup = (F.size(lines) - F.size(F.array_distinct(lines))).cast("long")
    df = df.withColumn(
        out,
        F.struct(
            n_words.alias("n_words"),
            chars.alias("word_chars"),
            symbols.alias("n_symbols"),
            dup.alias("n_dup_lines"),
            F.col(repeated).alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
        ),
    ).drop(w, lines, repeated)
    m = lambda name: F.col(f"{out}.{name}")
    low, high = rules.word_length
    return df.withColumn(
        out,
        F.struct(
            *(m(c).alias(c) for c in (*MEASURES, "n_lines")),
            (
                (m("n_words") < rules.min_words)
                | (100 * m("n_repeat_words") > rules.repeat_pct * m("n_words"))
            ).alias("base_failed"),
            (100 * m("n_symbols") > rules.symbol_pct * m("n_words")).alias("symbols"),
            (100 * m("n_dup_lines") > rules.dup_line_pct * m("n_lines")).alias("dup_lines"),
            ((m("word_chars") < low * m("n_words")) | (m("word_chars") > high * m("n_words"))).alias("word_length"),
        ),
    )


def shrunk_rates(measured: DataFrame, out: str, host: str, rules: Rules = Rules()) -> DataFrame:
    """One row per host: ``host``, ``n`` and the shrunk failure rate of each host rule.

    The prior is fitted by moments: its mean is the corpus rate, its weight follows from how much more
    the hosts' rates vary than chance would make them. Only the prior's two numbers a rule come to the driver.
    """
    hosts = measured.groupBy(named(measured, host).alias("host")).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.sum(F.col(f"{out}.{r}").cast("long")).alias(r) for r in HOST_RULES),
    )
    hosts = staged(hosts, "host-failures")
    mean = hosts.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("hosts"), *(F.sum(r).alias(r) for r in HOST_RULES)
    ).first()
    if not mean["n"]:
        return hosts
    rate = {r: mean[r] / mean["n"] for r in HOST_RULES}
    spread = hosts.agg(*(F.sum(F.col("n") * F.pow(F.col(r) / F.col("n") - rate[r], 2)).alias(r) for r in HOST_RULES)).first()

    def posterior(r: str) -> Column:
        m, chance = rate[r], rate[r] * (1 - rate[r])
        excess = spread[r] / mean["n"] - chance * mean["hosts"] / mean["n"]
        least, most = rules.prior_weight
        weight = most if excess <= 0 else min(most, max(least, chance / excess - 1))
        return (F.col(r) + m * weight) / (F.col("n") + weight)

    return hosts.select("host", "n", *(posterior(r).alias(r) for r in HOST_RULES))


def judge(measured: DataFrame, out: str, kept: str, host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """Measured documents with the boolean column ``kept``. Host verdicts are joined by host; Spark broadcasts
    them only below its threshold, and a large host's rows are split by its skew handling otherwise."""
    rates = shrunk_rates(measured, out, host, rules)
    key, bad = free(measured, "host_key", "enforced")
    verdicts = rates.select(
        F.col("host").alias(key), F.struct(*((F.col(r) >= rules.reject_rate).alias(r) for r in HOST_RULES)).alias(bad)
    )
    joined = measured.join(verdicts, named(measured, host).eqNullSafe(verdicts[key]), "left")
    broken = F.lit(False)
    for r in HOST_RULES:
        broken |= F.col(f"{out}.{r}") & F.coalesce(F.col(f"{bad}.{r}"), F.lit(False))
    return joined.withColumn(kept, ~F.col(f"{out}.base_failed") & ~broken).drop(key, bad)


def good_documents(docs: DataFrame, host: str = "source", rules: Rules = Rules()) -> DataFrame:
    """The documents that are kept, with their own columns."""
    out, kept = free(docs, "measures", "kept")
    measured = staged(measure(docs, out, rules=rules), "measured")
    return judge(measured, out, kept, host, rules).filter(F.col(kept)).select(*(named(measured, c) for c in docs.columns))
