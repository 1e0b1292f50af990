"""Ranked search against plain Python; the sharing DAG against its items."""

import math
import random
import re
from collections import Counter

import pytest

from textrec.llm import lexical as L

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, words in asked.items():
        scored = []
        for doc, c in counted:
            n = sum(c.values())
            m = 100 - 90 + (90 * n * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                        for t in words if t in c)
            if score > 0:
                scored.append((-score, doc is None, doc or 0, doc))
        out += [(item, r + 1, s[-1], -s[0]) for r, s in enumerate(sorted(scored)[:k])]
    return sorted(out, key=str)


def found(docs, items, **more):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in L.search(docs, items, **more).collect()], key=str)


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["Über", "漢字", "ÉCLAIR", "don"]
    text = lambda n: " ".join(rnd.choice(words[:1 + int(rnd.random() ** 2 * len(words))]) for _ in range(n))
    docs = [(i, text(rnd.randint(1, 60))) for i in range(150)]
    docs += [(500 + i, docs[7][1]) for i in range(30)] + [(7, docs[7][1]), (None, docs[7][1]), (None, docs[9][1])]
    docs += [(600, None), (601, ""), (602, "-- \t."), (603, text(40_000)), (604, "W1_w1/w2\x00w3"), (605, "nothing shared here")]
    base = text(12)
    items = [(i, f"{base} {text(6)}") for i in range(12)] + [(20 + i, text(8)) for i in range(6)]
    items += [(40, None), (41, "  "), (42, "absent words only"), (43, "W1"), (43, "w2 w2"), (None, "w3 w4"), (44, docs[7][1])]
    return docs, items, \
        spark.createDataFrame([(i, t, 1, "terms") for i, t in docs], "doc_id bigint, text string, n int, terms string").repartition(4), \
        spark.createDataFrame([(i, t, 0) for i, t in items], "item_id bigint, text string, score int")


@pytest.mark.parametrize("more", [{}, {"part_terms": 40, "block_bytes": 2000}])
def test_equals_plain_python(corpus, more):
    docs, items, df, queries = corpus
    assert found(df, queries, **more) == brute(docs, items)
    assert found(df, queries, k=3, **more) == brute(docs, items, 3)


def test_empty_tables(corpus):
    _, _, df, queries = corpus
    assert found(df.limit(0), queries) == []
    assert found(df, queries.limit(0)) == []


def test_every_item_is_the_sum_of_its_nodes():
    rnd = random.Random(2)
    shared = [f"s{i}" for i in range(30)]
    items = [sorted(set(rnd.sample(shared, rnd.randint(0, 25)) + [f"own{i}"] * (i % 2))) for i in range(40)] + [[], ["only"]]
    classes, sums, uses = L.mine(items)

    def spread(node):
        return classes[node] if node < len(classes) else sum((spread(x) for x in sums[node - len(classes)]), [])
    for terms_, nodes in zip(items, uses, strict=True):
        assert sorted(t for n in nodes for t in spread(n)) == terms_
    for n, (a, b) in enumerate(sums):
        assert a < len(classes) + n and b < len(classes) + n
    # sharing pays: fewer additions than terms, and no pair is left that two items share
    assert len(sums) + sum(map(len, uses)) < sum(map(len, items))
    pairs = Counter((a, b) for u in uses for a in u for b in u if a < b)
    assert all(n < 2 for n in pairs.values())
