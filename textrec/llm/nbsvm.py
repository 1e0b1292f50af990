"""Quality classifier: Naive Bayes support vectors.

A text is read in chunks of ``CHUNK`` tokens.  A chunk's features are
indicators of its token unigrams and bigrams (a token that follows itself is
the bigram "repeated"), scaled by the log-count ratio of the two classes.  A
linear hinge-loss model on them is fitted by dual coordinate descent.  A
text's margin is the mean over its chunks, so long texts don't collect
indicators, and a logistic curve, fitted on sample rows that the model hasn't
seen, turns it into a score.

Learned from a bounded sample of labelled rows (``learning.training_sample``).
Defined cases: null and empty texts have no features and score by the model's
bias; where the sample lacks a class the score is the constant share of ones
(0.5 without any rows)."""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from textrec.llm.common import table
from textrec.llm.learning import Constant, Logistic, scored, split_rows, training_sample

CHUNK = 100
CHUNKS_OF_A_ROW = 4
MIN_CHUNKS = 6
SMOOTHING = 1.0
COST = 0.1
EPOCHS = 12
THRESHOLD = 0.7
_TOKENS = re.compile(r"\w+|[^\w\s]+").findall


def chunks_of(text: str) -> list[list[str]]:
    tokens = _TOKENS(text)
    return [tokens[i:i + CHUNK] for i in range(0, len(tokens), CHUNK)] or [[]]


def features(tokens: list[str]) -> set:
    """Distinct unigrams and bigrams."""
    grams = set(tokens)
    grams.update([b if b[0] != b[1] else ("", "") for b in zip(tokens, tokens[1:], strict=False)])
    return grams


def dual_coordinate_descent(rows: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, size: int,
                            cost: float = COST, epochs: int = EPOCHS, seed: int = 0) -> np.ndarray:
    """Weights of the hinge-loss linear model; ``rows`` are (indices, values)."""
    w, alpha = np.zeros(size), np.zeros(len(rows))
    norm = [float(v @ v) for _, v in rows]
    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            if norm[i] == 0:
                continue
            idx, values = rows[i]
            gradient = y[i] * (w[idx] @ values) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), cost)
            if new != alpha[i]:
                w[idx] += (new - alpha[i]) * y[i] * values
                alpha[i] = new
    return w


class Model:
    def __init__(self, weights: dict, bias: float):
        self.weights, self.bias, self.curve = weights, bias, None

    def margin(self, text: str) -> float:
        chunks, weights = chunks_of(text), self.weights
        total = sum(sum([weights[f] for f in features(c) & weights.keys()]) for c in chunks)
        return total / len(chunks) + self.bias

    def __call__(self, texts: list[str]) -> list[float]:
        return self.curve(np.array([[self.margin(t)] for t in texts])).tolist() if texts else []


def fit(sample: dict[int, list[str]]):
    """A model of texts of class 1 against class 0."""
    if min(map(len, sample.values())) < 2:
        return Constant(len(sample[1]), len(sample[0]))
    parts = {y: split_rows(texts, 4) for y, texts in sample.items()}
    rows, y = [], []
    for label in (0, 1):
        for text in parts[label][0]:
            chunks = chunks_of(text)
            for i in sorted({round(k) for k in np.linspace(0, len(chunks) - 1, min(len(chunks), CHUNKS_OF_A_ROW))}):
                rows.append(features(chunks[i]))
                y.append(label)
    y = np.array(y)
    counts = Counter(f for row in rows for f in row)
    number = {f: i + 1 for i, f in enumerate(sorted((f for f, n in counts.items() if n >= MIN_CHUNKS), key=str))}
    encoded = [np.array(sorted(number[f] for f in row if f in number), np.int64) for row in rows]
    by_class = []
    for label in (0, 1):
        found = np.concatenate([e for e, k in zip(encoded, y, strict=True) if k == label])
        n = np.bincount(found, minlength=len(number) + 1) + SMOOTHING
        by_class.append(n / n.sum())
    ratio = np.log(by_class[1] / by_class[0])
    ratio[0] = 1.0  # the bias
    vectors = [(np.concatenate([[0], e]), ratio[np.concatenate([[0], e])]) for e in encoded]
    w = dual_coordinate_descent(vectors, 2 * y - 1, len(number) + 1) * ratio
    model = Model({f: float(w[i]) for f, i in number.items() if w[i]}, float(w[0]))
    margins = np.array([[model.margin(t)] for label in (0, 1) for t in parts[label][1]])
    model.curve = Logistic(margins, np.repeat([0, 1], [len(parts[0][1]), len(parts[1][1])]))
    return model


def score(docs: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = THRESHOLD,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return scored(docs, fit(training_sample(docs, labels, label, id_col, text_col)), threshold, id_col, text_col)


def op10_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
