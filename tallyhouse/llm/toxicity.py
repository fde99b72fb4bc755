"""Toxicity by weak supervision: many weak voters, a label model over their votes, a linear classifier on its labels.

Voters are small lexicons, word-start patterns and writing patterns; each votes toxic, clean or not at all. The label
model is generative: given the hidden label, a voter gives each vote with a probability of its own, found by
expectation maximisation; voters that err together beyond that are correlated, and share their weight. The classifier
is a logistic regression on words and word starts, fitted to the label model's posterior labels. Everything is fitted to a
bounded sample of labelled rows; every row is scored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Labels of rows in this fold are never read for training.
FOLDS, HELD_OUT = 3, 1
# Labelled rows the model is fitted to; those with the smallest id hashes.
SAMPLE_ROWS = 5_000
LEXICONS = 24
LEXICON_WORDS = 240
MAX_FEATURES = 150_000
# Standard errors between the classes that make a feature one.
LEAST_Z = 4.5
_LEAST_DOCS = 4
THRESHOLD = 0.7
_START = 5

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features_of(words: set[str]) -> set[str]:
    """Words, and with a mark the starts of longer words."""
    return words | {"^" + w[:_START] for w in words if len(w) > _START}


def style_votes(text: str | None) -> list[int]:
    """Votes of the writing patterns: shouted words, runs of exclamation marks, a word of abuse at someone's address."""
    text = text or ""
    shouted = sum(w.isupper() for w in re.findall(r"[^\W\d_]{4,}", text))
    return [int(shouted >= 3), int("!!!" in text), int(re.search(r"(?i)\b(you|your|du|ihr|tu|toi|vous)\b[^.!?\n]{0,20}!", text) is not None)]


def telling(sample: Sequence[set[str]], labels: np.ndarray) -> dict[str, tuple[float, float]]:
    """Per feature: how many standard errors its share in toxic rows is above that in the others; and the log ratio."""
    bad, every = Counter(), Counter()
    for found, label in zip(sample, labels.tolist()):
        every.update(found)
        if label > 0.01:
            for f in found:
                bad[f] += label
    n, n_bad = len(sample), float(labels.sum())
    n_good = max(n - n_bad, 1e-9)
    out = {}
    for f, c in every.items():
        if c >= _LEAST_DOCS:
            p, q = bad[f] / max(n_bad, 1e-9), (c - bad[f]) / n_good
            share = c / n
            error = math.sqrt(share * (1 - share) * (1 / max(n_bad, 1e-9) + 1 / n_good)) + 1e-12
            out[f] = ((p - q) / error, math.log((bad[f] + 0.5) / (n_bad + 1)) - math.log((c - bad[f] + 0.5) / (n_good + 1)))
    return out


@dataclass(frozen=True)
class Voters:
    """Word lists that vote toxic, their union voting clean where nothing of it is found."""

    lists: tuple[frozenset[str], ...]

    @classmethod
    def learned(cls, sample: Sequence[set[str]], toxic: np.ndarray, lexicons: int = LEXICONS, size: int = LEXICON_WORDS) -> Voters:
        """Features that stand out in toxic rows, dealt to lists by rank, so that lists are alike in strength."""
        strength = telling(sample, toxic.astype(float))
        top = sorted((f for f, (z, lift) in strength.items() if z > LEAST_Z and lift > 1.5), key=lambda f: (-strength[f][0], f))[:size]
        lists = [frozenset(top[k::lexicons]) for k in range(lexicons)]
        return cls(tuple(x for x in lists if x))

    def votes(self, found: set[str], style: Sequence[int]) -> list[int]:
        """1: toxic, -1: clean, 0: no opinion. The last but the writing patterns speak for clean rows."""
        own = [int(not x.isdisjoint(found)) for x in self.lists]
        hits = sum(own)
        return [*own, 1 if hits >= 3 else -1 if hits == 0 else 0, -1 if hits <= 1 else 0, *style]


@dataclass
class LabelModel:
    """Vote probabilities given the label, and a weight per voter that shares out what correlated voters say twice."""

    prior: float
    log_odds: np.ndarray  # per voter and vote (clean, none, toxic)
    weight: np.ndarray
    correlation: np.ndarray

    @classmethod
    def fitted(cls, votes: np.ndarray, start: np.ndarray, steps: int = 15) -> LabelModel:
        """Expectation maximisation from `start`, a first guess of each row's label, 0 to 1.

        Correlations are what voters have in common beyond the label, judged by the first guess: judged by its own
        posterior, a group of copied voters would look like the truth.
        """
        n, m = votes.shape
        prior = min(max(float(start.mean()), 1e-3), 1 - 1e-3)
        given = [(votes == v).astype(float) for v in (-1, 0, 1)]
        p = start.astype(float)
        bad, good = (p @ votes) / max(p.sum(), 1e-9), ((1 - p) @ votes) / max((1 - p).sum(), 1e-9)
        rest = votes - (p[:, None] * bad + (1 - p)[:, None] * good)
        spread = np.sqrt((rest * rest).mean(axis=0)) + 1e-9
        correlation = (rest.T @ rest) / n / np.outer(spread, spread)
        np.fill_diagonal(correlation, 1)
        weight = 1 / np.clip(correlation, 0, 1).sum(axis=1)
        for _ in range(steps):
            odds = np.zeros((m, 3))
            for v in range(3):
                odds[:, v] = np.log((p @ given[v] + 0.5) / (p.sum() + 1.5)) - np.log(((1 - p) @ given[v] + 0.5) / ((1 - p).sum() + 1.5))
            total = math.log(prior / (1 - prior)) + sum(given[v] @ (odds[:, v] * weight) for v in range(3))
            p = 1 / (1 + np.exp(-np.clip(total, -30, 30)))
        return cls(prior, odds, weight, correlation)

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        total = math.log(self.prior / (1 - self.prior)) + sum((votes == v - 1) @ (self.log_odds[:, v] * self.weight) for v in range(3))
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def fit_linear(sample: Sequence[set[str]], labels: np.ndarray, steps: int = 150, rate: float = 0.3, decay: float = 3e-4,
               most: int = MAX_FEATURES) -> tuple[dict[str, float], float]:
    """Logistic regression on soft labels by full adaptive gradient steps; both classes weigh the same.

    Only features whose share differs between the classes beyond chance take part, so that rows are not learned by
    heart from their rare words.
    """
    strength = telling(sample, labels)
    names = sorted((f for f, (z, _) in strength.items() if abs(z) > LEAST_Z), key=lambda f: (-abs(strength[f][0]), f))[:most]
    place = {f: i for i, f in enumerate(names)}
    rows, cols = [], []
    for i, found in enumerate(sample):
        own = [place[f] for f in found if f in place]
        cols += own
        rows += [i] * len(own)
    rows, cols = np.array(rows, np.int64), np.array(cols, np.int64)
    mass = np.where(labels > 0.5, 0.5 / max((labels > 0.5).sum(), 1), 0.5 / max((labels <= 0.5).sum(), 1))
    w, bias = np.zeros(len(names)), 0.0
    first, second, first_b, second_b = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        z = np.bincount(rows, w[cols], len(sample)) + bias
        slope = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) * mass
        g, gb = np.bincount(cols, slope[rows], len(names)) + decay * w / max(len(names), 1) * 100, slope.sum()
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        first_b, second_b = 0.9 * first_b + 0.1 * gb, 0.99 * second_b + 0.01 * gb * gb
        w -= rate * 0.3 * (first / (1 - 0.9 ** t)) / (np.sqrt(second / (1 - 0.99 ** t)) + 1e-6)
        bias -= rate * 0.3 * (first_b / (1 - 0.9 ** t)) / (math.sqrt(second_b / (1 - 0.99 ** t)) + 1e-6)
    return {f: float(x) for f, x in zip(names, w) if abs(x) > 1e-3}, float(bias)


@dataclass(frozen=True)
class Model:
    """Weights of the classifier; without any, every score is 0."""

    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        if not self.weights:
            return 0.0
        get = self.weights.get
        z = self.bias + math.fsum(get(f, 0.0) for f in features_of(words_of(text)))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


def in_fold(id_col: str) -> Column:
    """Whether a row is held out; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def labelled_sample(documents: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """At most `rows` labelled texts that are not held out, one of each id: `_id`, `_text`, `_label`.

    Ids are drawn by hash below a bound that their number gives, so that no more ids than needed leave their task. An
    id with several labels counts as toxic if any says so; rows without id or label are passed over. Of the rows of an id,
    the text with the smallest hash is taken; each task sends one at most.
    """
    known = labels.filter(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~in_fold(id_col)).groupBy(F.col(id_col).alias("_id")).agg(F.max(label_col).alias("_label"))
    known = known.withColumn("_draw", F.xxhash64("_id"))
    number = known.count()
    if number > rows:
        bound = int(2 ** 64 * (1.2 * rows + 100) / number) - 2 ** 63
        known = known.filter(F.col("_draw") <= F.lit(min(bound, 2 ** 63 - 1)))
    drawn = known.orderBy("_draw", "_id").limit(rows).select("_id", "_label")
    texts = documents.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))
    of_ids = texts.join(F.broadcast(drawn), "_id").groupBy("_id", "_label").agg(F.min(F.struct(F.xxhash64("_text").alias("h"), "_text")).alias("_t"))
    return of_ids.select("_id", "_t._text", "_label")


_SEEN = "_id string, words string, styles array<int>, label int"


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          rows: int = SAMPLE_ROWS) -> Model:
    """The classifier, through voters and label model. Of the sample, tasks send distinct words and votes only."""
    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            columns = [batch.column(0).cast(pa.string()), pa.array([" ".join(sorted(words_of(t))) for t in texts], pa.string()),
                       pa.array([style_votes(t) for t in texts], pa.list_(pa.int32())), batch.column(2).cast(pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, names=["_id", "words", "styles", "label"])

    drawn = labelled_sample(documents, labels, id_col, text_col, label_col, rows)
    seen = drawn.select("_id", "_text", F.col("_label").cast("int")).mapInArrow(look, _SEEN).toArrow().sort_by([("_id", "ascending"), ("words", "ascending")])
    toxic = np.array(seen.column("label").to_pylist(), np.int64)
    if not len(toxic) or toxic.min() == toxic.max():
        return Model({}, 0.0)
    sample = [features_of(set(w.split())) for w in seen.column("words").to_pylist()]
    voters = Voters.learned(sample, toxic)
    votes = np.array([voters.votes(f, s) for f, s in zip(sample, seen.column("styles").to_pylist())])
    posterior = LabelModel.fitted(votes, toxic).posterior(votes)
    return Model(*fit_linear(sample, posterior))


def scored(documents: DataFrame, model: Model, text_col: str = "text", score_col: str = "_score") -> DataFrame:
    """`documents` with the model's score of the text in `score_col`, which is replaced. Null text: as empty."""
    given = documents.sparkSession.sparkContext.broadcast(model)
    rows = documents.drop(score_col)
    place, names = rows.columns.index(text_col), [*rows.columns, score_col]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = given.value
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([own.score(t.as_py()) for t in batch.column(place)], pa.float64())], names=names)

    return rows.mapInArrow(score, T.StructType([*rows.schema.fields, T.StructField(score_col, T.DoubleType())]))


def report(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
           rows: int = SAMPLE_ROWS) -> DataFrame:
    """Per document: held_out, score and predicted.

    Null and empty texts get the score of a text without words. Each row, also a repeated one, is scored by itself.
    Where the labels outside the held-out fold are missing or all alike there is nothing to learn: every score is 0.
    Only the text is an input of a score.
    """
    model = train(documents, labels, id_col, text_col, label_col, rows)
    found = scored(documents.select(F.col(id_col), F.col(text_col).cast("string").alias(text_col)), model, text_col)
    return found.select(id_col, in_fold(id_col).alias("held_out"), F.col("_score").alias("score"), (F.col("_score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(documents: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents whose score is below the threshold; columns stay as they are."""
    model = train(documents, labels, text_col=text_col, **options)
    name = "_score"
    while name in documents.columns:
        name += "_"
    return scored(documents, model, text_col, name).filter(F.col(name) < THRESHOLD).drop(name)
