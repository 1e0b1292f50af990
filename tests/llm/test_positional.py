import hashlib
import os
import re

import duckdb
import numpy as np
import pytest

from textrec.llm import positional as P
from textrec.llm.oracle import SQL
from textrec.session import scratch_path

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(docs, items):
    """doc_id, n_words, n_hit, n_items, sha256 by plain Python."""
    windows = {}
    for item, text in items:
        w = words(text)
        if w:
            for i in range(max(1, len(w) - 9)):
                windows.setdefault(tuple(w[i:i + 10]), set()).add(item)
    sizes = {len(x) for x in windows}
    out = []
    for doc, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        ids = sorted(str(i) for i in found if i is not None)
        out.append((doc, len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest()))
    return sorted(out, key=str)


def digest(spark, docs, items, **k):
    found = P.find(P.build_index(docs, scratch_path(spark, "p"), **k), items)
    return sorted([(r.doc_id, r.n_words, sum(s.e - s.s for s in r.spans), len(r["items"]),
                    hashlib.sha256(",".join(r["items"]).encode()).hexdigest()) for r in found.collect()], key=str)


def rows(df, *columns):
    return [tuple(r) for r in df.select(*columns).collect()]


def test_query_equals_brute_force(spark, sf):
    t = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    want = expected(rows(t("documents"), "doc_id", "text"), rows(t("benchmark"), "item_id", "text"))
    got = sorted([tuple(r)[:5] for r in P.op6_positional_index(spark, sf).collect()], key=str)
    assert got == want and any(r[2] for r in got)


@pytest.mark.parametrize("limit", [P.PART_BYTES, 250])
def test_odd_rows_small_segments_and_parts(spark, odd_docs, no_docs, monkeypatch, limit):
    monkeypatch.setattr(P.item_parts, "__defaults__", ("item_id", "text", limit))
    items = spark.createDataFrame(
        [("a", "A SHORT text, of some words"), ("a", "A SHORT text, of some words"), ("b", None), ("c", "..."),
         (None, "leading and"), ("d", "line 7 of a rather long text number 49 line 8 of a rather long text number 64"),
         ("e", "same same same same same same same same same same same same"), ("f", "x"), ("g", "漢字"), ("h", "inside")],
        "item_id string, text string")
    want = expected(rows(odd_docs, "doc_id", "text"), rows(items, "item_id", "text"))
    assert digest(spark, odd_docs, items) == want
    assert digest(spark, odd_docs, items, segment_words=7) == want
    clean = P.decontaminate(odd_docs, items)
    assert clean.schema == odd_docs.schema
    assert sorted((r.doc_id or 0) for r in clean.collect()) == sorted((w[0] or 0) for w in want if not w[2])
    assert digest(spark, odd_docs, items.limit(0)) == expected(rows(odd_docs, "doc_id", "text"), [])
    assert digest(spark, no_docs, items) == []


def test_random_words_against_brute_force():
    rng = np.random.default_rng(3)
    for _ in range(20):
        texts = [" ".join(rng.choice(list("abc"), rng.integers(0, 40))) for _ in range(30)]
        items = [(str(i), " ".join(rng.choice(list("abc"), rng.integers(0, 14)))) for i in range(8)]
        found = P.matches(P.Segment.of([P.words_of(t) for t in texts]), P.Windows(items))
        got = sorted([(i, len(words(t)), sum(e - s for s, e in found[i][0]) if i in found else 0,
                       len(found[i][1]) if i in found else 0) for i, t in enumerate(texts)], key=str)
        assert got == [w[:4] for w in expected(list(enumerate(texts)), items)]


def test_proximity_in_spark(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma"), (2, "x alpha y beta gamma"), (3, "gamma")], "doc_id bigint, text string")
    items = spark.createDataFrame([("p", "alpha beta gamma")], "item_id string, text string")
    index = P.build_index(docs, scratch_path(spark, "p"))
    got = {r.doc_id: (r["items"], r.near_items) for r in P.find(index, items, slop=1).collect()}
    assert got == {1: (["p"], []), 2: ([], ["p"]), 3: ([], [])}
    with pytest.raises(ValueError, match="slop"):
        P.find(index, items, slop=P.GAP)


def test_proximity():
    windows = P.Windows([("p", "alpha beta gamma")])
    texts = ["alpha beta gamma", "alpha x beta gamma", "alpha x y z beta gamma", "alpha beta", "beta gamma"]
    seg = P.Segment.of([P.words_of(t) for t in texts])
    found = P.matches(seg, windows, slop=2)
    assert found[0][1] == {"p"} and found[0][0] == [(0, 3)]
    assert found[1] == ([], set(), {"p"}) and set(found) == {0, 1}


def near(text, items, slop):
    """Exact and near-only items: the first word anywhere, the others within
    ``slop`` words of their places after it."""
    w, at = words(text), {}
    for i, x in enumerate(w):
        at.setdefault(x, set()).add(i)
    exact, loose = set(), set()
    for item, t in items:
        q = words(t)
        for g in {tuple(q[i:i + 10]) for i in range(max(1, len(q) - 9))} if q else ():
            if all(x in at for x in g):
                for a in at[g[0]]:
                    if all(a + i in at[x] for i, x in enumerate(g)):
                        exact.add(item)
                    elif all(any(a + i + d in at[x] for d in range(-slop, slop + 1)) for i, x in enumerate(g) if i):
                        loose.add(item)
    return exact - {None}, loose - exact - {None}


def sql_rows(folder):
    """The registered SQL over the tables of a folder."""
    db = duckdb.connect()
    for name in ("documents", "benchmark"):
        files = f"{folder}/{name}.parquet"
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{files}{'/*.parquet' if os.path.isdir(files) else ''}'")
    return sorted(db.execute("SELECT doc_id, n_hit, n_items, n_near_items, near_items_sha256 FROM "
                             f"({SQL['op6_positional_index']})").fetchall())


def test_packed_windows_equal_sets_and_are_bounded(spark):
    rng = np.random.default_rng(8)
    for size in (1, 2, 3, 7, 10):
        items = [(str(i), " ".join(rng.choice(list("abc"), rng.integers(0, 30)))) for i in range(60)]
        want = {}
        for i, t in items:
            w = words(t)
            for k in range(max(1, len(w) - size + 1)) if w else ():
                want.setdefault(tuple(w[k:k + size]), set()).add(i)
        packed = P.Windows(items, size)
        terms = [None, *packed.terms.decode().split(" ")]
        got = {tuple(terms[t] for t in packed.tokens[s:s + n]): {packed.items[i] for i in packed.of(k)}
               for k, (s, n) in enumerate(zip(packed.starts, packed.sizes, strict=True))}
        assert got == want and len(packed.starts) == len(want)
    worst = spark.createDataFrame([(str(i), " ".join(rng.choice(list("abcdefghij"), 400))) for i in range(50)]
                                  + [(str(i), chr(97 + i % 26)) for i in range(500)], "item_id string, text string")
    built = P.windows_of(worst)
    assert len(built.starts) > 19_000 and built.nbytes() < P.PACKED * 50 * 800


def test_postings_stay_packed_without_a_window():
    seg = P.Segment.of([P.words_of("alpha beta gamma delta")])
    row = seg.packed() | {"doc_words": [4]}
    lazy = P.Segment.unpacked(row)
    assert P.matches(lazy, P.Windows([("p", "alpha omega")])) == {} and callable(lazy._deltas)
    assert P.matches(lazy, P.Windows([("p", "beta gamma")]))[0][0] == [(1, 3)]


def test_wordless_texts_fill_segments(spark):
    docs = spark.createDataFrame([(i, "..." if i % 2 else None) for i in range(100)], "doc_id bigint, text string").coalesce(1)
    index = P.build_index(docs, scratch_path(spark, "p"), segment_words=10)
    assert index.count() >= 9
    items = spark.createDataFrame([("p", "alpha")], "item_id string, text string")
    assert P.find(index, items).where("n_words = 0").count() == 100


@pytest.mark.parametrize("slop", [1, 2])
def test_random_proximity_against_brute_force(slop):
    rng = np.random.default_rng(5)
    for size in (1, 7, 30):  # documents in a segment: the result doesn't depend on it
        texts = [" ".join(rng.choice(list("abcdefgh"), rng.integers(0, 40))) for _ in range(30)]
        items = [(str(i), " ".join(rng.choice(list("abcdefgh"), rng.integers(2, 6)))) for i in range(12)]
        windows, loose = P.Windows(items), 0
        for lo in range(0, 30, size):
            part = texts[lo:lo + size]
            found = P.matches(P.Segment.of([P.words_of(t) for t in part]), windows, slop)
            for i, t in enumerate(part):
                got = found.get(i, ([], set(), set()))
                assert (got[1], got[2]) == near(t, items, slop)
                loose += len(got[2])
        assert loose > 10


def test_registered_query_returns_near_items(spark, sf, tmp_path):
    """A passage with a word put into every window is near; exact columns are
    those of the exact query."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf}/benchmark.parquet")
    passage = next(t for t, in rows(items, "text") if len(words(t)) >= 20)
    w = words(passage)
    broken = " ".join(x for i in range(0, len(w), 5) for x in [*w[i:i + 5], "zzz"])
    docs = docs.unionByName(spark.createDataFrame([(10**9, broken)], docs.schema))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    texts, found = dict(rows(docs, "doc_id", "text")), P.op6_positional_near(spark, str(tmp_path))
    exact = P.op6_positional_index(spark, str(tmp_path))
    got = found.collect()
    digest = {r.doc_id: hashlib.sha256(",".join(r.near_items).encode()).hexdigest() for r in got}
    plain = [c for c in exact.columns if c != "near_items_sha256"]
    assert sorted(map(tuple, found.select(plain).collect())) == sorted(tuple(r[c] for c in plain) for r in exact.collect())
    assert digest == {r.doc_id: r.near_items_sha256 for r in exact.collect()}
    sql = sql_rows(str(tmp_path))
    assert sql == sorted((r.doc_id, r.n_hit, r.n_items, r.n_near_items, r.near_items_sha256) for r in exact.collect())
    assert any(r[3] for r in sql)
    pairs = [(str(i), t) for i, t in rows(items, "item_id", "text")]
    for r in got:
        assert r.near_items == sorted(near(texts[r.doc_id], pairs, P.SLOP)[1]) and r.n_near_items == len(r.near_items)
    assert next(r for r in got if r.doc_id == 10**9).n_near_items > 0
    assert not next(r for r in got if r.doc_id == 10**9).contaminated
