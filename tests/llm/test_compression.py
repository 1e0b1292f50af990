from collections import Counter

import numpy as np
import pytest
import zstandard

from textrec.llm import compression as C

ZSTD = zstandard.ZstdCompressor(level=3, write_checksum=False, write_content_size=False)


def brute(text):
    text = text or ""
    import re
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)]
    counts = Counter(grams)
    hit = {j for i, g in enumerate(grams) if counts[g] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    dup = sum(x in lines[:i] for i, x in enumerate(lines))
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit),
            len(words) < 10 or 100 * len(hit) > 20 * len(words))


def test_base_measures_equal_brute_force(spark, odd_docs):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    texts += ["a b c d e a b c d e", "a b c d e f a b c d e", "x " * 7, "#a *\n\n%%\n#a *\n", None, "", "\x0b\x0c"]
    for t in texts:
        assert C.base_measures(t or "") == brute(t), t


def test_verdict_rejects_repetition_and_noise(spark):
    rng = np.random.default_rng(1)
    vocab = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(900)]
    rows = [(i, " ".join(rng.choice(vocab, 300))) for i in range(120)]
    rows.append((900, " ".join(f"{vocab[i % 3]}{i % 2}" + "q" * (i % 5) for i in range(300))))
    rows.append((901, " ".join("".join(map(chr, rng.integers(33, 2000, 6))) for _ in range(150))))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    limits = C.fit_norms(df)
    got = {r.doc_id: r for r in C.measure(df, limits).collect()}
    assert not got[900].kept and not got[901].kept and not got[901].base_failed
    assert all(got[i].kept for i in range(120))
    assert {r.doc_id for r in C.filter_documents(df).collect()} == set(range(120))


def numpy_limits(texts):
    """The limits of distinct texts from sorted arrays: thin bands take in their
    neighbours, no deviation is below the typical band's."""
    whole, chunks = {}, []
    for raw in {t.encode() for t in texts if t}:
        size = 1000 * len(ZSTD.compress(raw)) // len(raw)
        whole.setdefault(C.band(len(raw)), []).append(size)
        full = range(len(raw) // 2048)
        chunks += [1000 * len(ZSTD.compress(raw[2048 * i:2048 * i + 2048])) // 2048 for i in full]
    pools = {}
    for b in whole:
        reach = 0
        pools[b] = np.array(whole[b])
        while len(pools[b]) < 30 and reach < 4:
            reach += 1
            pools[b] = np.array([x for o, v in whole.items() if abs(o - b) <= reach for x in v])

    def spread(v):
        return np.median(v), 1.4826 * np.median(np.abs(v - np.median(v)))

    shares = [spread(v)[1] / spread(v)[0] for v in pools.values() if len(v) >= 30]
    least = np.median(shares) if shares else 0.0

    def limits(v, least=0.0):
        mid, sigma = spread(v)
        sigma = max(sigma, least * mid)
        return mid - max(3 * sigma, 0.08 * mid), mid + max(6 * sigma, 0.08 * mid)

    return {b: limits(v, least) for b, v in pools.items()}, limits(np.array(chunks)) if chunks else (0, np.inf)


def numpy_kept(text, limits):
    raw = (text or "").encode()
    if brute(text)[-1]:
        return False
    low, high = limits[0].get(C.band(len(raw)), (0, np.inf))
    parts = [raw[i:i + 2048] for i in range(0, len(raw), 2048)]
    ratios = np.array([1000 * len(ZSTD.compress(p)) // 2048 for p in parts if len(p) == 2048])
    bad = np.sum((ratios < limits[1][0]) | (ratios > limits[1][1]))
    return bool(low <= 1000 * len(ZSTD.compress(raw)) // len(raw) <= high and bad <= 0.25 * len(ratios))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_query_equals_numpy(spark, sf):
    """Base measures, limits and verdicts of the whole table."""
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    want = numpy_limits(texts.values())
    got = C.fit_norms(docs.repartition(7))
    assert got == C.fit_norms(docs.coalesce(1))
    assert got.whole.keys() == want[0].keys() and np.allclose(got.chunk, want[1])
    assert all(np.allclose(got.whole[b], want[0][b]) for b in want[0])
    rows = C.op2_compression_bands(spark, f"/root/testdata/{sf}").collect()
    assert len(rows) == len(texts)
    for r in rows:
        assert tuple(r[1:7]) == brute(texts[r.doc_id]) and r.kept == numpy_kept(texts[r.doc_id], want), r


def test_odd_rows(spark, odd_docs, no_docs):
    limits = C.fit_norms(odd_docs)
    rows = C.measure(odd_docs, limits).collect()
    assert len(rows) == odd_docs.count()
    texts = {r.doc_id: r.text for r in odd_docs.collect()}
    for r in rows:
        assert tuple(r[1:7]) == brute(texts[r.doc_id])
        assert not (r.base_failed and r.kept)
    kept = C.filter_documents(odd_docs)
    assert kept.schema == odd_docs.schema
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r.doc_id for r in rows if r.kept)
    assert C.measure(no_docs, C.fit_norms(no_docs)).count() == 0 and C.filter_documents(no_docs).count() == 0


def prose(rng, vocab, n):
    return " ".join(rng.choice(vocab, n))


def test_copies_do_not_become_the_norm(spark):
    """A band that is 70 % copies of one repetitive text: the others stay, and
    the copies, which pass the base rules, go.  A thin band has its
    neighbours' norm."""
    rng = np.random.default_rng(2)
    vocab = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(2, 9))) for _ in range(900)]
    clean = [prose(rng, vocab, 300) for _ in range(90)]
    size = sorted(len(t) for t in clean)[45]
    copy = prose(rng, vocab[:12], 900)[:size]
    noise = " ".join("".join(map(chr, rng.integers(33, 2000, 6))) for _ in range(300))
    rows = [(i, t) for i, t in enumerate(clean)] + [(1000 + i, copy) for i in range(210)] + [(5000, noise)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert not C.base_measures(copy)[-1] and not C.base_measures(noise)[-1]
    assert sum(C.band(len(t)) == C.band(len(copy)) for t in clean) > 20
    assert C.band(len(noise.encode())) not in {C.band(len(t)) for t in clean}
    assert {r.doc_id for r in C.filter_documents(df).collect()} == set(range(90))
    assert C.fit_norms(df) == C.fit_norms(df.dropDuplicates(["text"]).repartition(5))
