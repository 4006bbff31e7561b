"""Quality classifier: regularised quadratic discriminant over transformed document statistics."""

from __future__ import annotations

import sys
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.llm.common import held_out, training_labels
from locusweave.session import fits_broadcast

STATISTICS = ("words", "upper", "symbols", "bars", "marks", "digits", "types", "stutter", "pairs", "lines",
              "length", "spread", "top", "stops", "breaks", "capitals", "long_line", "not_letters")
SHRINKAGE = 0.05
THRESHOLD = 0.5

_LOWER, _UPPER, _DIGIT, _SPACE, _PLAIN, _SYMBOL = range(6)


@cache
def _kinds() -> np.ndarray:
    """Kind of each code point."""
    kind = {"Ll": _LOWER, "Lo": _LOWER, "Lm": _LOWER, "Lu": _UPPER, "Lt": _UPPER, "Nd": _DIGIT, "Mn": _LOWER, "Zs": _SPACE, "Cc": _SPACE}
    out = np.array([kind.get(unicodedata.category(chr(c)), _SYMBOL) for c in range(sys.maxunicode + 1)], dtype=np.uint8)
    for c in ".,;:'\"()-?":
        out[ord(c)] = _PLAIN
    return out


def statistics(text: str) -> np.ndarray:
    """The statistics of one whole text, shares as logarithms; an empty text has no words and the least of every share."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    kinds = np.bincount(_kinds()[codes], minlength=6)
    letters = kinds[_LOWER] + kinds[_UPPER]
    words = text.split()
    n = len(words)
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=n) if n else np.zeros(1)
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    lines = [line for line in text.split("\n") if line]
    per_word, per_char, low = 1 / max(n, 1), 1 / max(len(text), 1), 0.002
    return np.array([
        np.log1p(n),
        np.log(low + kinds[_UPPER] / max(letters, 1)),
        np.log(low + kinds[_SYMBOL] * per_char),
        np.log(low + text.count("|") * per_word),
        np.log(low + text.count("!") * per_word),
        np.log(low + kinds[_DIGIT] * per_char),
        np.log(max(len(counts), 1) * per_word),
        np.log(low + sum(map(eq, words, words[1:])) * per_word),
        np.log(low + 1 - pairs / max(n - 1, 1)) if n > 1 else np.log(low),
        np.log(low + 1 - len(set(lines)) / max(len(lines), 1)) if lines else np.log(low),
        np.log1p(lengths.mean()),
        np.log1p(lengths.std()),
        np.log(low + max(counts.values(), default=0) * per_word),
        np.log(low + (text.count(".") + text.count(",")) * per_word),
        np.log(low + text.count("\n") * per_word),
        np.log(low + sum(map(str.isupper, [w[0] for w in words])) * per_word),
        np.log1p(max(map(len, lines), default=0)),
        np.log(low + 1 - letters * per_char) if len(text) else np.log(low),
    ])


@dataclass(frozen=True)
class Discriminant:
    """Per class: centre, inverse Cholesky factor, and the constant of its log density."""

    centre: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def difference(self, x: np.ndarray) -> np.ndarray:
        """Log density and prior of class 1 minus those of class 0, per row of ``x``."""
        z = (x - self.centre) / self.scale
        logs = [c - 0.5 * (((z - m) @ f.T) ** 2).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants)]
        return logs[1] - logs[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        """Logistic function of the difference per statistic, so that far documents keep their order."""
        return 1 / (1 + np.exp(np.clip(-self.difference(x) / x.shape[1], -500, 500)))


def discriminant(moments: dict[int, np.ndarray], shrinkage: float = SHRINKAGE) -> Discriminant | float:
    """Fits from per-class moments (count, sums, sums of products).

    With fewer than two rows of a class there is no density to compare; the
    score is then the share of class 1 among the rows there are, 0.5 for none.
    """
    d = len(STATISTICS)
    flat = [moments.get(label, np.zeros(1 + d + d * d)) for label in (0, 1)]
    counts = np.array([m[0] for m in flat])
    if counts.min() < 2:
        return float(counts[1] / counts.sum()) if counts.sum() else 0.5
    total = sum(flat)
    centre = total[1:1 + d] / total[0]
    variance = np.diag(total[1 + d:].reshape(d, d)) / total[0] - centre**2
    scale = np.sqrt(np.where(variance > 1e-12, variance, 1))
    means, factors, constants = [], [], []
    for m in flat:
        mean = m[1:1 + d] / m[0]
        spread = (m[1 + d:].reshape(d, d) / m[0] - np.outer(mean, mean)) / np.outer(scale, scale)
        spread = (1 - shrinkage) * spread + shrinkage * max(np.trace(spread) / d, 1e-3) * np.eye(d)
        lower = np.linalg.cholesky((spread + spread.T) / 2)
        means.append((mean - centre) / scale)
        factors.append(np.linalg.inv(lower))
        constants.append(np.log(m[0] / total[0]) - np.log(np.diag(lower)).sum())
    return Discriminant(centre, scale, np.array(means), np.array(factors), np.array(constants))


def fit(docs: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant | float:
    """Fits on all labelled documents outside the held-out third.

    Each task sums the moments of its rows; what reaches the driver is two
    tables of a few hundred sums, whatever the number of documents.
    """
    known = training_labels(labels, "quality")
    known = F.broadcast(known) if fits_broadcast(known) else known
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(known, "doc_id").select("text", "label")
    d = len(STATISTICS)

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, 1 + d + d * d))
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                x = statistics(text)
                row = total[int(label > 0)]
                row[0] += 1
                row[1:1 + d] += x
                row[1 + d:] += np.outer(x, x).ravel()
        for label in (0, 1):
            if total[label, 0]:
                yield pd.DataFrame({"label": label, "place": range(total.shape[1]), "value": total[label]})

    parts = rows.mapInPandas(sums, "label int, place int, value double").groupBy("label", "place").agg(F.sum("value").alias("value"))
    moments: dict[int, np.ndarray] = {}
    for row in parts.collect():
        moments.setdefault(row.label, np.zeros(1 + d + d * d))[row.place] = row.value
    return discriminant(moments, shrinkage)


def quality_score(text: Column, model: Discriminant | float) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if isinstance(model, float):
                yield pd.Series(model, index=batch.index)
            else:
                x = np.array([statistics(t or "") for t in batch]).reshape(len(batch), len(STATISTICS))
                yield pd.Series(model.score(x), index=batch.index)

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``; the score is that of label 1.

    Null texts count as empty, null ids are not held out, repeated rows are
    scored each, and other columns are left out, whatever their names.
    """
    score = quality_score(F.coalesce("text", F.lit("")), fit(docs, labels))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, with all their columns."""
    score = quality_score(F.coalesce("text", F.lit("")), fit(docs, labels))
    return docs.select(F.struct("*").alias("row"), score.alias("score")).where(F.col("score") >= threshold).select("row.*")
