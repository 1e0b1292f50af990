"""Small numerical helpers for the trained operators, and their bounded sample."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrec.llm.common import held_out

#: Bounds of a training sample: rows of each class, characters of a row.
MAX_ROWS = 5000
MAX_CHARS = 20_000


def training_sample(docs: DataFrame, labels: DataFrame, label: str, id_col: str = "doc_id", text_col: str = "text",
                    max_rows: int = MAX_ROWS, max_chars: int = MAX_CHARS) -> dict[int, list[str]]:
    """{0: texts, 1: texts}: labelled rows that aren't held out, at most
    ``max_rows`` ids of each class (those with the smallest hash), of which
    texts up to ``max_chars`` are taken.  Repeated labels, rows and texts count
    once; null labels, ids and texts are left out.  Ids are chosen before any
    text is read, so what is sent and collected is bounded by the parameters."""
    known = (labels.select(F.col(id_col).alias("doc_id"), F.col(label).cast("int").alias("label"))
             .where(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("doc_id"))).distinct())
    chosen = [known.where(F.col("label") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows) for value in (0, 1)]
    texts = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
             .where(F.length("text").between(1, max_chars)))
    rows = (texts.join(F.broadcast(chosen[0].unionByName(chosen[1])), "doc_id")  # two numbers for 2 x max_rows ids
            .groupBy("doc_id", "label").agg(F.min("text").alias("text")).collect())
    out: dict[int, list[str]] = {0: [], 1: []}
    for r in sorted(rows, key=lambda r: (str(r.doc_id), r.label)):
        out[r.label].append(r.text)
    return {value: list(dict.fromkeys(texts)) for value, texts in out.items()}


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


class Logistic:
    """Dense logistic regression on a few features, by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray, ridge: float = 1e-2):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = self._design(x)
        w = np.zeros(z.shape[1])
        for _ in range(30):
            p = sigmoid(z @ w)
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), z.T @ (y - p) - ridge * w)
            w += np.clip(step, -3, 3)
            if np.abs(step).max() < 1e-8:
                break
        self.weights = w

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(self._design(np.atleast_2d(np.asarray(x, float))) @ self.weights)


class Constant:
    """What is known where a class has no rows: the share of ones, or a half."""

    def __init__(self, ones: int, zeros: int):
        self.value = ones / (ones + zeros) if ones + zeros else 0.5

    def __call__(self, texts) -> list[float]:
        return [self.value] * len(texts)


def split_rows(texts: list[str], every: int) -> tuple[list[str], list[str]]:
    """Rows to fit on, and each ``every``-th row to calibrate on."""
    return [t for i, t in enumerate(texts) if i % every], texts[::every]


def scored(docs: DataFrame, model, threshold: float, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every whole text."""
    import pyarrow as pa

    from textrec.llm.common import id_text, id_type, is_held_out, ship_package, text_slices
    ship_package(docs.sparkSession)
    pairs = id_text(docs, id_col, text_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # its size is bounded by that of the sample

    def run(batches):
        score = shared.value
        for rows, texts in text_slices(batches):
            values = [float(x) for x in score(texts)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([is_held_out(i) for i in rows.column(0).to_pylist()], pa.bool_()),
                 pa.array(values, pa.float64()), pa.array([int(v >= threshold) for v in values], pa.int32())],
                names=["doc_id", "held_out", "score", "predicted"])

    return pairs.mapInArrow(run, f"doc_id {id_type(pairs)}, held_out boolean, score double, predicted int")
