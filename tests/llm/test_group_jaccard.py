import re
from collections import Counter

import numpy as np
import pytest

from textrec.llm import group_jaccard as G


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def expected(rows):
    """(doc_id, n_shingles, component_id) by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    by = {}
    for i, s in enumerate(sets):
        for g in s:
            by.setdefault(g, []).append(i)
    near = {(a, b) for ids in by.values() if len(ids) < 400 for i, a in enumerate(ids) for b in ids[i + 1:]}
    for a, b in near:
        both = len(sets[a] & sets[b])
        if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(least.get(find(i), doc), doc)
    return sorted([(doc, len(sets[i]), least.get(find(i))) for i, (doc, _) in enumerate(rows)], key=str)


def digest(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in df.collect()], key=str)


def test_query_equals_all_pairs(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert digest(G.op4_token_groups(spark, sf)) == expected(rows)


def test_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert digest(G.join(odd_docs)) == expected(rows)
    assert G.join(no_docs).count() == 0
    kept = G.keep_one(odd_docs)
    assert kept.schema == odd_docs.schema
    got = Counter(r.doc_id for r in kept.collect())
    assert got == Counter([1, 2, 3, 4, 5, None, 8, 9, 10, 11, 12, 13])
    assert G.keep_one(no_docs).count() == 0


@pytest.mark.parametrize("seed", [1, 2])
def test_chains_of_near_copies_at_the_limit(spark, seed):
    """Chains whose ends don't link, pairs just over and under the limit,
    shared passages, and one large group of near copies."""
    rng = np.random.default_rng(seed)
    vocab = [f"w{i}" for i in range(3000)]
    passage = list(rng.choice(vocab, 60))
    rows = []
    for _ in range(25):
        words = list(rng.choice(vocab, int(rng.integers(5, 80))))
        for _ in range(int(rng.integers(1, 9))):
            rows.append(" ".join(words))
            for _ in range(int(rng.integers(1, 3))):
                words[int(rng.integers(len(words)))] = str(rng.choice(vocab))
    for _ in range(30):
        rows.append(" ".join([*rng.choice(vocab, int(rng.integers(1, 60))), *passage]))
    base = list(rng.choice(vocab, 120))
    for _ in range(150):
        w = list(base)
        for _ in range(int(rng.integers(0, 5))):
            w[int(rng.integers(len(w)))] = str(rng.choice(vocab))
        rows.append(" ".join(w))
    rows += ["a b", "A B", "a b c", "a", "a"]
    rows = [(int(i), t) for i, t in zip(rng.permutation(len(rows)), rows, strict=True)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert digest(G.join(df)) == expected(rows)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 90), (95, 100)], "a bigint, b bigint")
    got = {(r.node, r.root) for r in G.components(links).collect()}
    assert got == {(i, 0) for i in range(41)} | {(90, 90), (95, 90), (100, 90)}


def test_keep_one_goes_by_links_not_by_ids(spark):
    """Rows that share an id but don't link stay, also where the id is another
    component's smallest; near copies without ids leave one."""
    rng = np.random.default_rng(9)
    a, b, c, d = ([f"{x}{i}" for i in rng.permutation(200)[:60]] for x in "abcd")
    rows = [(1, a), (1, b), (2, c), (3, [*c[:-1], "other"]), (2, d), (None, [*d[1:], "x"]),
            *((None, [f"n{i}" for i in range(60)][:59 - k] + ["y"] * (1 + k)) for k in range(3))]
    rows = [(i, " ".join(w)) for i, w in rows]
    kept = G.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    texts = {r.text for r in kept}
    assert {t for _, t in rows[:3]} <= texts and rows[3][1] not in texts
    assert rows[4][1] in texts and rows[5][1] not in texts
    assert len(kept) == 5 and len(texts & {t for _, t in rows[6:]}) == 1


@pytest.mark.parametrize("buckets", [1, 12, 64, 100, 4096])
def test_info_rows_of_first_chunks_are_spread(buckets):
    schema = G.chunk_schema(G.pa.int64())
    found = Counter(G.Chunk(part << 24).rows(buckets, G.pa.int64(), schema).column("bucket")[0].as_py() for part in range(640))
    assert all(-buckets <= b < 0 for b in found)
    assert max(found.values()) <= max(4, 3 * 640 / buckets)
