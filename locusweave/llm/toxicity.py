"""Toxicity score: a weighted lexicon matched by Aho-Corasick on folded text, normalised by length.

The lexicon's entries are word beginnings with log-odds weights, learned from
labelled documents; phrases in which a word is harmless are exceptions.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusweave.llm.common import held_out, stored, training_labels

THRESHOLD = 0.7
TRAINING_ROWS = 20_000  # labelled documents, those with the smallest hash of their id

SHORTEST, LONGEST = 4, 14  # letters of a lexicon entry; a shorter one is a whole word and ends with a space
LEAST_DOCS = 5  # toxic documents an entry must occur in
LEAST_WEIGHT = 1.5

# What stands for a letter. l and i share one form, because 1 stands for both.
_LOOKALIKES = {
    "0": "o", "1": "i", "l": "i", "|": "i", "!": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s",
    "а": "a", "в": "b", "е": "e", "к": "k", "м": "m", "н": "h", "о": "o", "р": "p", "с": "c", "т": "t", "у": "y", "х": "x",
    "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "α": "a", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t",
    "υ": "u", "χ": "x", "ı": "i",
}
_FOLD = str.maketrans(_LOOKALIKES)
_WORD = re.compile(r"[^\W_]+")
_SYMBOLS = "!@$|"

# Phrases (folded on use) in which the word they hold is harmless.
EXCEPTIONS: tuple[str, ...] = ("clown fish", "clownfish", "trash can", "trash bin", "trash bag")


def fold(text: str) -> str:
    """Compatibility forms, lower case, look-alike letters and digits as the letters they stand for."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    return text.lower().translate(_FOLD)


def folded_words(text: str) -> list[str]:
    return _WORD.findall(fold(text))


def word_forms(text: str) -> list[list[str]]:
    """The folded words, and if symbols stand around words, the same words without those; one without letters becomes empty."""
    if not text.isascii():
        text = unicodedata.normalize("NFKC", text)
    text = text.lower()
    folded = text.translate(_FOLD)
    if not any(c in text for c in _SYMBOLS):
        return [_WORD.findall(folded)]
    spans = [m.span() for m in _WORD.finditer(folded)]
    words = [folded[a:b] for a, b in spans]
    return [words, [text[a:b].strip(_SYMBOLS).translate(_FOLD) for a, b in spans]]


def beginnings(word: str) -> Iterator[str]:
    if 0 < len(word) < SHORTEST:
        yield word + " "
    for n in range(SHORTEST, min(len(word), LONGEST) + 1):
        yield word[:n]


@dataclass
class Lexicon:
    """Weights by folded word beginning, exception phrases, and the curve from density to score."""

    weights: dict[str, float]
    exceptions: Sequence[str] = EXCEPTIONS
    curve: tuple[float, ...] = (0.0, 0.0, 0.0, 0.0)
    _automaton: ahocorasick.Automaton | None = field(default=None, repr=False)

    def automaton(self) -> ahocorasick.Automaton:
        """Entries start with the space before a word; an exception phrase carries None."""
        if self._automaton is None:
            self._automaton = ahocorasick.Automaton()
            for entry, weight in self.weights.items():
                self._automaton.add_word(" " + entry, (len(entry) + 1, weight))
            for phrase in self.exceptions:
                key = " " + " ".join(folded_words(phrase)) + " "
                self._automaton.add_word(key, (len(key), None))
            self._automaton.make_automaton()
        return self._automaton

    def __getstate__(self) -> dict:
        return {"weights": self.weights, "exceptions": self.exceptions, "curve": self.curve, "_automaton": None}

    def _found(self, words: list[str]) -> tuple[dict[int, float], set[int]]:
        """Heaviest entry by number of the word, and the words that exception phrases cover."""
        hits: dict[int, float] = {}
        harmless: set[int] = set()
        if not words or not (self.weights or self.exceptions):
            return hits, harmless
        matches = list(self.automaton().iter(" " + " ".join(words) + " "))
        if not matches:
            return hits, harmless
        starts = {}
        at = 0
        for number, word in enumerate(words):
            if word:
                starts[at] = number
            at += len(word) + 1
        for end, (length, weight) in matches:
            number = starts[end - length + 1]
            if weight is None:
                at = end - length + 1
                while at < end:
                    harmless.add(number)
                    at += len(words[number]) + 1
                    number += 1
            else:
                hits[number] = max(weight, hits.get(number, weight))
        return hits, harmless

    def evidence(self, text: str) -> tuple[float, float, int]:
        """Summed weight, number of hits, number of words.

        Of the entries that fit one word, with or without the symbols around
        it, the heaviest counts, and a word that an exception phrase covers
        does not count.
        """
        forms = word_forms(text)
        hits: dict[int, float] = {}
        harmless: set[int] = set()
        for words in forms:
            found, covered = self._found(words)
            harmless |= covered
            for number, weight in found.items():
                hits[number] = max(weight, hits.get(number, weight))
        counted = [weight for number, weight in sorted(hits.items()) if number not in harmless]
        return sum(counted), float(len(counted)), len(forms[0])

    def exposed_words(self, text: str) -> set[str]:
        """The folded words that stand outside exception phrases at least once, with and without the symbols around them."""
        forms = word_forms(text)
        harmless = set().union(*(self._found(words)[1] for words in forms))
        if not harmless:
            return set().union(*forms) - {""}
        return {word for words in forms for number, word in enumerate(words) if word and number not in harmless}

    def inputs(self, text: str) -> list[float]:
        """Evidence per word on a log scale, plain evidence, and length."""
        total, _, n = self.evidence(text)
        return [1.0, float(np.log(1e-4 + total / max(n, 20))), float(np.log1p(total)), float(np.log1p(n))]

    def score(self, texts: Sequence[str | None]) -> np.ndarray:
        x = np.array([self.inputs(t or "") for t in texts]).reshape(len(texts), 4)
        return 1 / (1 + np.exp(np.clip(-x @ np.array(self.curve), -500, 500)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, weight: np.ndarray | float = 1.0) -> np.ndarray:
    """Ridge logistic regression by Newton steps, each row counting ``weight`` times; both classes must occur."""
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.eye(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + penalty, x.T @ (weight * (y - p)) - penalty @ beta)
        beta = beta + step
        if np.abs(step).max() < 1e-8:
            break
    return beta


def entry_weight(a: float, b: float, toxic: float, clean: float) -> float:
    """Log odds of an entry that ``a`` of the toxic and ``b`` of the clean documents hold."""
    return float(np.log((a + 0.5) / (toxic + 1)) - np.log((b + 0.5) / (clean + 1)))


def choose_entries(counts: dict[str, tuple[float, float]], toxic: float, clean: float) -> dict[str, float]:
    """Weights of the beginnings worth keeping, from the numbers of toxic and clean documents that hold them.

    A beginning gives way to one that is a letter longer and has all its toxic
    documents. A longer one stays only if it weighs more than every shorter one
    that it extends.
    """
    extended: dict[str, float] = {}
    for entry, (a, _) in counts.items():
        extended[entry[:-1]] = max(a, extended.get(entry[:-1], a))
    weights: dict[str, float] = {}
    for entry in sorted(counts, key=lambda e: (len(e), e)):
        a, b = counts[entry]
        if extended.get(entry) == a:
            continue
        weight = entry_weight(a, b, toxic, clean)
        shorter = max((weights[p] for p in beginnings(entry) if p != entry and p in weights), default=0.0)
        if a >= LEAST_DOCS and weight >= LEAST_WEIGHT and weight > shorter + 0.3:
            weights[entry] = weight
    return weights


def training_texts(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """``text, label, copies``: at most ``rows`` labelled texts outside the held-out third, one per id.

    Rows with equal id and text are one and count as often as they occur; of several
    texts under one id, that with the smallest hash is taken.
    """
    known = F.broadcast(training_labels(labels, "toxic", rows))  # bounded by ``rows``
    each = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(known, "doc_id").groupBy("doc_id", "text", "label").agg(
        F.count(F.lit(1)).alias("copies"))
    one = each.groupBy("doc_id", "label").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text", "copies")).alias("one"))
    return one.select("one.text", "label", "one.copies")


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS, exceptions: Sequence[str] = EXCEPTIONS) -> Lexicon:
    """Learns weights and curve from the ``training_texts``; texts with equal inputs reach the driver as one.

    Without documents of both classes the lexicon is empty, and every score is
    the share of toxic rows, a half for none.
    """
    sample = stored(training_texts(docs, labels, rows))

    bare = Lexicon({}, exceptions)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple[Counter, Counter] = (Counter(), Counter())
        for batch in batches:
            for text, label, copies in zip(batch["text"], batch["label"], batch["copies"].tolist()):
                counter = held[int(label > 0)]
                for entry in {p for w in bare.exposed_words(text) for p in beginnings(w)}:
                    counter[entry] += copies
                if len(held[0]) + len(held[1]) > 200_000:
                    yield from flush(held)
        yield from flush(held)

    def flush(held: tuple[Counter, Counter]) -> Iterator[pd.DataFrame]:
        for label, counter in enumerate(held):
            if counter:
                yield pd.DataFrame({"entry": list(counter), "toxic": [n * label for n in counter.values()],
                                    "clean": [n * (1 - label) for n in counter.values()]})
                counter.clear()

    size = {r.toxic: float(r["n"]) for r in sample.groupBy((F.col("label") > 0).alias("toxic")).agg(F.sum("copies").alias("n")).collect()}
    toxic, clean = size.get(True, 0.0), size.get(False, 0.0)
    if not toxic or not clean:
        share = toxic / (toxic + clean) if toxic + clean else 0.5
        return Lexicon({}, exceptions, (float(np.log((share + 1e-6) / (1 - share + 1e-6))), 0.0, 0.0, 0.0))
    summed = sample.mapInPandas(count, "entry string, toxic double, clean double").groupBy("entry").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    # The sample bounds what is collected: entries of several toxic documents that weigh enough. A longer entry that
    # one gives way to has no more clean documents, so it is there too.
    weight = F.log((F.col("toxic") + 0.5) / (toxic + 1)) - F.log((F.col("clean") + 0.5) / (clean + 1))
    found = summed.where((F.col("toxic") >= LEAST_DOCS) & (weight >= LEAST_WEIGHT - 1e-6)).collect()
    lexicon = Lexicon(choose_entries({r.entry: (r.toxic, r.clean) for r in found}, toxic, clean), exceptions)

    def inputs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = pd.DataFrame([lexicon.inputs(t) for t in batch["text"]], columns=list("abcd"))
            yield x.assign(label=(batch["label"] > 0).astype("double").to_numpy(), copies=batch["copies"].astype("double").to_numpy())

    x = sample.mapInPandas(inputs, "a double, b double, c double, d double, label double, copies double").groupBy(*"abcd", "label").agg(
        F.sum("copies").alias("copies")).toPandas().to_numpy()
    lexicon.curve = tuple(float(v) for v in logistic(x[:, :4], x[:, 4], weight=x[:, 5]))
    return lexicon


def toxicity(text: Column, lexicon: Lexicon) -> Column:
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(lexicon.score(batch.tolist()), index=batch.index)

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs``; the score is that of label 1.

    Null texts count as empty, null ids are not held out, repeated rows are
    scored each, and other columns are left out, whatever their names.
    """
    score = toxicity(F.coalesce("text", F.lit("")), fit(docs, labels))
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))


def keep_harmless(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` whose score stays below the threshold, with all their columns."""
    score = toxicity(F.coalesce("text", F.lit("")), fit(docs, labels))
    return docs.select(F.struct("*").alias("row"), score.alias("score")).where(F.col("score") < threshold).select("row.*")
