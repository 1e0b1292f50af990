"""Held-out accuracy and defined cases of the two trained text classifiers."""

import zlib

import numpy as np
import pytest

from textrec.llm import learning, nbsvm, toxicity

SF = "/root/testdata/sf0.1"


def auc(scores, labels):
    a, b = np.sort(scores[labels == 1]), np.sort(scores[labels == 0])
    return ((np.searchsorted(b, a, "left") + np.searchsorted(b, a, "right")) / 2).mean() / len(b)


@pytest.mark.parametrize(("module", "label", "query", "at_least"), [
    (nbsvm, "quality", nbsvm.op10_nbsvm_quality, 0.98), (toxicity, "toxic", toxicity.op7_compression_distance, 0.88)])
def test_held_out_accuracy(spark, module, label, query, at_least):
    found = query(spark, SF)
    rows = found.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out").collect()
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert len(rows) > 300 and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in rows)
    scores, labels = np.array([r.score for r in rows]), np.array([r[label] for r in rows])
    assert 0 <= scores.min() and scores.max() <= 1
    assert all(r.predicted == int(r.score >= module.THRESHOLD) for r in rows)
    assert auc(scores, labels) >= at_least


@pytest.mark.parametrize("module", [nbsvm, toxicity])
def test_odd_rows_and_missing_classes(spark, odd_docs, no_docs, module):
    label = "quality" if module is nbsvm else "toxic"
    none = spark.createDataFrame([], f"doc_id bigint, {label} int, text string")
    one = spark.createDataFrame([(1, 1, "a"), (1, 1, "a"), (5, None, "b"), (None, 0, "c")], f"doc_id bigint, {label} int, text string")
    assert {r.score for r in module.score(odd_docs, none).collect()} == {0.5}
    assert {r.score for r in module.score(odd_docs, one).collect()} <= {0.5, 1.0}
    both = spark.createDataFrame([(i, i % 2) for i in range(14)], f"doc_id bigint, {label} int")
    rows = module.score(odd_docs, both).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (2, 3, 4)}) == 1
    assert module.score(no_docs, both).count() == 0


def test_no_held_out_row_is_learned_from(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(400)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id bigint, toxic int")
    sample = learning.training_sample(docs, labels, "toxic", max_rows=150)
    assert all(len(t) <= 150 for t in sample.values())
    ids = [int(t.split()[1]) for texts in sample.values() for t in texts]
    assert ids and all(zlib.crc32(str(i).encode()) % 4 != 2 for i in ids)


def test_dual_coordinate_descent_reaches_the_optimum():
    """Against a fine subgradient search of the primal problem in one dimension."""
    rows = [(np.array([0]), np.array([x])) for x in (1.0, 2.0, -1.0, 0.5)]
    y = np.array([1, 1, -1, -1])
    w = nbsvm.dual_coordinate_descent(rows, y, 1, cost=0.7, epochs=200)[0]
    grid = np.linspace(-3, 3, 60_001)
    loss = grid ** 2 / 2 + 0.7 * sum(np.maximum(0, 1 - k * grid * v[0]) for k, (_, v) in zip(y, rows, strict=True))
    assert abs(w - grid[loss.argmin()]) < 1e-3


def test_all_toxic_segments_are_in_the_dictionary():
    """Also those of a sample with more than a few kilobytes of them."""
    import random
    rng = random.Random(4)
    words = sorted({"".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=9)) for _ in range(1500)})
    toxic = [" ".join(rng.sample(words, len(words))) for _ in range(12)]
    ordinary = [" ".join(f"word{rng.randrange(300)}" for _ in range(50)) for _ in range(60)]
    plain, found = toxicity.dictionaries(toxic, ordinary)
    assert set(words) <= set(found.decode().split()) and len(plain) == len(found)
