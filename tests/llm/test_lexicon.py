import hashlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textrec.llm import lexicon as L

PATH = public_tokenizers.path(L.VOCABULARY)
TOK = Tokenizer.from_file(PATH)
TOK.no_padding()
TOK.no_truncation()
VOC = L.Vocabulary(PATH)


def expected(text):
    ids = TOK.encode(text or "", add_special_tokens=False).ids
    h = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), h(" ".join(map(str, ids))), h(TOK.decode(ids, skip_special_tokens=False))


def digest(df):
    return {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in df.collect()}


def test_query_equals_the_library(spark):
    sf = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert digest(L.op5_transducer_bpe(spark, sf)) == {(r.doc_id, *expected(r.text)) for r in rows}


def test_odd_rows_with_full_and_empty_lexicon(spark, odd_docs, no_docs):
    want = {(r.doc_id, *expected(r.text)) for r in odd_docs.collect()}
    for n in (L.LEXICON_WORDS, 3):
        got = L.digests(odd_docs, PATH, L.build_lexicon(odd_docs, PATH, n))
        assert digest(got) == want and got.count() == odd_docs.count()
    none = L.build_lexicon(no_docs, PATH)
    assert digest(L.digests(odd_docs, PATH, none)) == want
    assert L.digests(no_docs, PATH, none).count() == 0
    out = L.encode_documents(odd_docs, PATH, none)
    assert out.columns == [*odd_docs.columns, "token_ids", "decoded"]
    for r in out.collect():
        assert r.token_ids == TOK.encode(r.text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=8))
def test_any_text_equals_the_library(texts):
    enc = L.Encoder(VOC, None)
    enc.KEEP = 5
    for t, (ids, decoded, n) in zip(texts, enc.encode(texts), strict=True):
        want = TOK.encode(t, add_special_tokens=False).ids
        assert ids == " ".join(map(str, want)) and n == len(want)
        assert decoded == TOK.decode(want, skip_special_tokens=False)


@settings(max_examples=60, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=6), max_size=60), st.sets(st.binary(max_size=6), max_size=30))
def test_automaton_numbers_its_words_only(tmp_path_factory, words, others):
    words = sorted(words)
    path = str(tmp_path_factory.mktemp("lex") / "x.bin")
    L.write_lexicon(path, words, [[i, i + 1] for i in range(len(words))])
    lex = L.Lexicon(path)
    assert lex.numbers(words).tolist() == list(range(len(words)))
    assert all(lex.ids_of(i) == [i, i + 1] for i in range(len(words)))
    probe = sorted(others - set(words))
    assert (lex.numbers(probe) == -1).all() if probe else True


def test_automaton_is_minimal():
    a = L.build_automaton(sorted(b"%s%s" % (x, y) for x in (b"work", b"walk", b"talk") for y in (b"", b"s", b"ed", b"ing")))
    # 1 for the common end, 3 inside "ed" and "ing" (e, i, n), 1 for the shared
    # endings' start, and the prefixes' states with "alk" and "ork" shared
    assert len(a["final"]) == len(np.unique(a["targets"])) + 1
    assert len(a["final"]) < 15
