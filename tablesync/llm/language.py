"""Language of texts by interpolated Kneser-Ney character models.

For each language one model of character n-grams (``ORDER`` long) is trained on labelled documents. All models
share sorted arrays of n-gram hashes: a text's n-grams are looked up once and give the log-probabilities of
every language; n-grams that no language has seen fall back to shorter ones with each language's own weight.
The language of lowest cross-entropy per character wins. Its score is the calibrated probability that it is
right, fitted on labelled documents kept out of the models; ``rejected`` marks texts that fit no
language, by the calibration texts' highest cross-entropies.

Texts are read in lower case, letters with their marks only (Unicode categories L and M), everything between them as
one space. Training takes about
``train_rows`` documents and calibration about ``calibration_rows``, whole texts, chosen by hash within each language:
all of a language that has few, as many of each of the others, so that every labelled language is learned at any
size and share. What comes to the driver is bounded by that and the number of languages. Every text is predicted whole.

Defined results: a text that is NULL or without a letter is ``und`` with score 0, as is every text when there is
nothing to learn from; with one language all texts have it; of languages with equal cross-entropy the first by
name wins; repeated rows get equal results; an empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import named, staged

ORDER = 4
UNKNOWN = "und"
_ASCII = re.compile("[^a-z]+")
#: The same for texts without marks, whose only numbers beyond digits are these; and what else a text may hold.
_LATIN = re.compile(r"[\W\d_²³¹¼½¾]+")
_BEYOND = re.compile("[\u02ec-\u1dff\u2070-\U0010ffff]")
_MIX = np.uint64(0x9E3779B97F4A7C15)
#: Characters looked up at once.
WINDOW = 1 << 20


@dataclass(frozen=True)
class Training:
    """About so many documents train the models and calibrate the scores; more, where there are so many languages that
    each would have fewer than ``least_rows``."""

    train_rows: int = 6000
    calibration_rows: int = 2000
    least_rows: int = 200
    #: Share of calibration texts of which the cross-entropy counts as fitting.
    fitting: float = 0.999


@cache
def _patterns() -> tuple[re.Pattern, re.Pattern]:
    """What is neither letter nor mark (Unicode categories L and M), and marks that stand behind neither."""
    kinds = "".join(category(chr(c))[0] for c in range(sys.maxunicode + 1))
    spans = lambda kind: "".join(f"{re.escape(chr(m.start()))}-{re.escape(chr(m.end() - 1))}" for m in re.finditer(f"[{kind}]+", kinds))
    return re.compile(f"[^{spans('LM')}]+"), re.compile(f"(?<![{spans('LM')}])[{spans('M')}]+")


def letters(text: str | None) -> str:
    """The letters of a text, each with the marks behind it, in lower case; all between them is one space."""
    if not text:
        return ""
    text = text.lower()
    if text.isascii():
        return _ASCII.sub(" ", text).strip()
    if not _BEYOND.search(text):
        return _LATIN.sub(" ", text).strip()
    between, stray = _patterns()
    return between.sub(" ", stray.sub(" ", text)).strip()


def grams(text: str) -> np.ndarray:
    """The n-grams that end at each character of a text between spaces, 16 bits a character; what lies beyond the
    basic plane shares one value."""
    codes = np.frombuffer((" " * (ORDER - 1) + text + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    codes = np.minimum(codes, 0xFFFF).astype(np.uint64)
    n = len(codes) - ORDER + 1
    out = codes[:n].copy()
    for k in range(1, ORDER):
        out <<= np.uint64(16)
        out |= codes[k : k + n]
    return out


class Table:
    """Rows of numbers by n-gram, found through sorted hashes and the first place of each leading bit pattern."""

    def __init__(self, keys: np.ndarray, rows: np.ndarray):
        hashes = keys * _MIX
        order = np.argsort(hashes)
        self.hashes, self.rows = hashes[order], rows[order]
        self.shift = np.uint64(64 - max(1, int(len(keys)).bit_length()))
        slots = np.arange((1 << (64 - int(self.shift))) + 1, dtype=np.uint64)
        self.first = np.searchsorted((self.hashes >> self.shift), slots).astype(np.int64)
        self.longest = int(np.diff(self.first).max()) if len(keys) else 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Row of each n-gram, -1 where there is none."""
        hashes = keys * _MIX
        at = self.first[(hashes >> self.shift).astype(np.int64)]
        out = np.full(len(keys), -1, dtype=np.int64)
        todo = np.arange(len(keys))
        for _ in range(self.longest):
            inside = at < len(self.hashes)
            todo, at, hashes = todo[inside], at[inside], hashes[inside]
            here = self.hashes[at]
            hit = here == hashes
            out[todo[hit]] = at[hit]
            more = here < hashes
            todo, at, hashes = todo[more], at[more] + 1, hashes[more]
            if not len(todo):
                break
        return out


def kneser_ney(counts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[list[Table], list[Table], int]:
    """Tables of log-probabilities of the n-grams of each length, and of log fall-back weights of the contexts, with
    one column a language, from each language's (n-grams, counts); and the number of characters."""
    mask = lambda n: np.uint64((1 << 16 * n) - 1)
    alphabet = max(1, len(np.unique(np.concatenate([g & mask(1) for g, _ in counts]))))
    levels = [counts]  # of each length from the longest: n-grams and counts; below, kinds of continuation
    for n in range(ORDER - 1, 0, -1):
        levels.append([np.unique(g & mask(n), return_counts=True) for g, _ in levels[-1]])
    levels.reverse()
    probability, weight = [], []
    lower = None  # (union, probabilities) one length down
    for n, level in enumerate(levels, 1):
        union = np.unique(np.concatenate([g for g, _ in level]))
        contexts = np.unique(union >> np.uint64(16))
        p = np.zeros((len(union), len(level)))
        w = np.ones((len(contexts), len(level)))
        below = np.full((len(union), len(level)), 1.0 / (alphabet + 1))
        if lower is not None:
            below = lower[1][np.searchsorted(lower[0], union & mask(n - 1))]
        for k, (g, c) in enumerate(level):
            if not len(g):
                p[:, k] = below[:, k]
                continue
            once, twice = int((c == 1).sum()), int((c == 2).sum())
            discount = once / (once + 2 * twice) if once else 0.5
            own = np.searchsorted(contexts, g >> np.uint64(16))
            total = np.bincount(own, c, len(contexts))
            kinds = np.bincount(own, minlength=len(contexts))
            w[:, k] = np.where(total > 0, discount * kinds / np.maximum(total, 1), 1.0)
            p[np.searchsorted(union, g), k] = np.maximum(c - discount, 0) / total[own]
            p[:, k] += w[np.searchsorted(contexts, union >> np.uint64(16)), k] * below[:, k]
        lower = (union, p)
        probability.append(Table(union, np.log(p)))
        weight.append(Table(contexts, np.log(w)))
    return probability, weight, alphabet


class Model:
    def __init__(self, languages: list[str], counts: list[tuple[np.ndarray, np.ndarray]]):
        self.languages = languages
        if languages:
            self.probability, self.weight, self.alphabet = kneser_ney(counts)
        self.slope, self.offset, self.limit = (1.0, 1.0), 0.0, np.inf

    def _total(self, keys: np.ndarray, n: int = ORDER) -> np.ndarray:
        """Log-probability of all n-grams together, in each language."""
        if not n:
            return np.full(len(self.languages), -len(keys) * np.log(self.alphabet + 1.0))
        at = self.probability[n - 1].find(keys)
        seen = at >= 0
        rows = self.probability[n - 1].rows
        out = np.bincount(at[seen], minlength=len(rows)) @ rows if seen.sum() > len(rows) else rows[at[seen]].sum(axis=0)
        rest = keys[~seen]
        if len(rest):
            context = self.weight[n - 1].find(rest >> np.uint64(16))
            out = out + self.weight[n - 1].rows[context[context >= 0]].sum(axis=0)
            out = out + self._total(rest & np.uint64((1 << 16 * (n - 1)) - 1), n - 1)
        return out

    def entropies(self, text: str) -> np.ndarray:
        """Cross-entropy per character in nats, by language, of a text as ``letters`` gives it."""
        total, size = 0.0, 0
        for at in range(0, len(text), WINDOW):
            # A window goes on with the characters before it.
            keys = grams(text[max(0, at - ORDER + 1) : at + WINDOW])[(ORDER - 1 if at else 0) :]
            total, size = total + self._total(keys), size + len(keys)
        return -total / size

    def judge(self, text: str | None) -> tuple[str, float, bool, float]:
        """(language, score, rejected, cross-entropy) of a raw text."""
        body = letters(text)
        if not body or not self.languages:
            return UNKNOWN, 0.0, False, 0.0
        entropy = self.entropies(body)
        best = int(np.argmin(entropy))
        return self.languages[best], self.confidence(self._facts(entropy, len(body))), bool(entropy[best] > self.limit), float(entropy[best])

    @staticmethod
    def _facts(entropy: np.ndarray, size: int) -> tuple[float, float]:
        margin = float(np.diff(np.sort(entropy)[:2])[0]) if len(entropy) > 1 else 1.0
        return margin, margin * float(np.log1p(size))

    def confidence(self, facts: tuple[float, float]) -> float:
        z = self.offset + self.slope[0] * facts[0] + self.slope[1] * facts[1]
        return float(1 / (1 + np.exp(-min(50.0, max(-50.0, z)))))

    def calibrate(self, rows: list[tuple[float, float, float, bool]], fitting: float) -> None:
        """Fit score and limit on (margin, margin by length, cross-entropy, right) of labelled texts."""
        if not rows:
            return
        facts = np.array([r[:2] for r in rows])
        right = np.array([r[3] for r in rows], dtype=float)
        # As in Platt's method the targets stay off 0 and 1, so that texts all right do not make all sure.
        y = np.where(right > 0, (right.sum() + 1) / (right.sum() + 2), 1 / (len(right) - right.sum() + 2))
        x = np.column_stack([facts, np.ones(len(facts))])
        v = np.zeros(3)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ v, -50, 50)))
            grad = x.T @ (p - y) + 1e-3 * v
            v -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(3), grad)
        self.slope, self.offset = (float(v[0]), float(v[1])), float(v[2])
        self.limit = float(np.quantile([r[2] for r in rows], fitting)) * 1.05


def _counts(sample: DataFrame) -> DataFrame:
    """(lang, gram, n) of the sample's texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if body := letters(text):
                    own.setdefault(lang, []).append(grams(body))
            for lang, parts in own.items():
                keys, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    return sample.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _limit(counts: list[int], rows: int) -> float:
    """The number of rows of each language, all where there are fewer, at which all together are as many as wanted."""
    left = sorted(counts)
    while left and left[0] * len(left) <= rows:
        rows -= left.pop(0)
    return rows / len(left) if left else float("inf")


def _of_each_language(rows: DataFrame, wanted: int, least: int) -> DataFrame:
    """About so many rows, chosen by a hash of doc_id and text, as evenly over the languages as they have them."""
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    limit = max(least, _limit(list(counts.values()), wanted))
    parts = {lang: int((1 << 30) * limit / n) for lang, n in counts.items() if n > limit}
    if not parts:
        return rows
    part = F.create_map(*(F.lit(x) for pair in parts.items() for x in pair))
    return rows.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < F.coalesce(part[F.col("lang")], F.lit(1 << 30)))


def train(labelled: DataFrame, how: Training = Training()) -> Model:
    """A calibrated model from the columns doc_id, text, lang of labelled documents; rows without lang are left out."""
    # Texts without what ``letters`` leaves teach nothing.
    rows = labelled.filter("lang IS NOT NULL").select("doc_id", "text", "lang").filter(F.col("text").rlike(r"\p{L}"))
    total = how.train_rows + how.calibration_rows
    rows = staged(_of_each_language(rows, total, how.least_rows), "language-sample")
    place = F.pmod(F.xxhash64(F.lit("calibration"), "doc_id", "text"), F.lit(total))
    # Of each language at least one text trains.
    last = rows.groupBy("lang").agg(F.max(place).alias("last"))
    rows = rows.join(F.broadcast(last), "lang")
    share = (place < how.calibration_rows) & (place < F.col("last"))
    found = _counts(rows.filter(~share).select("lang", "text")).toPandas()
    languages = sorted(found["lang"].unique())
    counts = []
    for lang in languages:
        own = found[found["lang"] == lang]
        keys = own["gram"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        counts.append((keys[order], own["n"].to_numpy(np.int64)[order]))
    model = Model(languages, counts)
    if languages:
        model.calibrate(_checked(rows.filter(share), model), how.fitting)
    return model


def _checked(rows: DataFrame, model: Model) -> list[tuple[float, float, float, bool]]:
    """Facts of the calibration texts; one short row a text comes to the driver."""
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, out = shared.value, []
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if body := letters(text):
                    entropy = model.entropies(body)
                    best = int(np.argmin(entropy))
                    out.append((*model._facts(entropy, len(body)), float(entropy[best]), model.languages[best] == lang))
        columns = list(zip(*out)) or [()] * 4
        kinds = [pa.float64()] * 3 + [pa.bool_()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["margin", "by_size", "entropy", "ok"])

    found = rows.select("lang", "text").mapInArrow(check, "margin double, by_size double, entropy double, ok boolean")
    return [tuple(r) for r in found.collect()]


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected, cross_entropy of every document; only its text is looked at."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            found = list(zip(*(model.judge(t.as_py()) for t in batch.column(1)))) or [()] * 4
            kinds = (pa.string(), pa.float64(), pa.bool_(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(found, kinds))], names=["doc_id", "lang_pred", "score", "rejected", "cross_entropy"]
            )

    rows = docs.select(named(docs, "doc_id").alias("doc_id"), named(docs, text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean, cross_entropy double")
