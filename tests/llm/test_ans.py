import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from textrec.llm import ans
from textrec.session import scratch_path

PATH = public_tokenizers.path(ans.VOCABULARY)


def expected(rows):
    """(doc_id, start, n, crc) by plain Python; nulls first, ties by text."""
    tok, out, at = Tokenizer.from_file(PATH), [], 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        out.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def written(spark, df):
    folder = scratch_path(spark, "t")
    ans.write_tokens(df, folder, PATH)
    return folder


def digest(df):
    return [(r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.orderBy("start").collect()]


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert digest(ans.op1_static_rans(spark, sf)) == expected(rows)


def test_odd_rows(spark, odd_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    folder = written(spark, odd_docs)
    assert digest(ans.document_checksums(ans.read_documents(spark, folder))) == expected(rows)


def test_checksums_of_parts_join():
    coder = ans.Coder(ans.normalise(np.bincount(np.arange(1000) % 37, minlength=50)))
    crc, ids = 0, np.arange(1000, dtype=np.uint32) % 37
    for i in range(0, 1000, 100):
        piece = coder.decode(coder.encode(ids[i:i + 100])).astype("<u4").tobytes()
        crc = ans.crc32_join(crc, zlib.crc32(piece), len(piece)) if i else zlib.crc32(piece)
    assert crc == zlib.crc32(ids.astype("<u4").tobytes())


def test_a_document_over_many_blocks(spark):
    text = " ".join(f"word{i % 977} and {i}" for i in range(200_000))
    df = spark.createDataFrame([(1, "a b"), (2, text), (3, None)], "doc_id bigint, text string")
    parts = ans.read_documents(spark, written(spark, df))
    assert parts.where("continues").count() >= 1
    assert digest(ans.document_checksums(parts)) == expected([(1, "a b"), (2, text), (3, None)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x24f), st.characters()), max_size=30), max_size=6))
def test_any_text_equals_the_library(texts):
    tok = ans.tokenizer(PATH)
    for text, ids in zip(texts, tok.encode(texts), strict=True):
        assert ans.np.frombuffer(ids, tok.kind).tolist() == tok.library.encode(text, add_special_tokens=False).ids


def test_new_pieces_go_straight_to_the_merges():
    from textrec.llm.lexicon import byte_alphabet
    shown, sizes = [], []

    class Model:
        def _resize_cache(self, size):
            sizes.append(size)

        def tokenize(self, piece):
            shown.append(piece)
            return []

    class Library:
        model = Model()

        def get_vocab_size(self, with_added_tokens):
            return 3

    pieces, alphabet = ans.PieceIds(Library(), 2), byte_alphabet()
    assert sizes == [0]  # pieces are kept here, the model's own cache only takes time
    for piece in [*map(chr, ans._PLAIN_LATIN1), " word", " it", "x~!", " é1", " \n", "\t\t", "  ", "ƒ"]:
        assert pieces[piece] == b""
        assert shown.pop() == "".join(alphabet[b] for b in piece.encode())


def test_empty_table(spark, no_docs):
    assert digest(ans.document_checksums(ans.read_documents(spark, written(spark, no_docs)))) == []


@pytest.mark.parametrize("n", [0, 1, 5, ans.LANES, ans.LANES * ans.CHECKPOINT_STEPS * 2 + 77])
def test_coder_round_trip_and_checkpoints(n):
    rng = np.random.default_rng(n)
    ids = np.minimum(rng.zipf(1.3, n), 49_999).astype(np.uint32)
    counts = np.bincount(ids, minlength=50_257)
    coder = ans.Coder(ans.normalise(counts))
    block = coder.encode(ids)
    assert (coder.decode(block) == ids).all()
    for c in range(1, len(block["checkpoints"]) // (8 * (ans.LANES + 1)) + 1):
        assert (coder.decode(block, c) == ids[c * ans.CHECKPOINT_STEPS * ans.LANES:]).all()
    if n > 10_000:  # near the entropy
        p = counts[counts > 0] / n
        assert len(block["words"]) < 1.02 * n * -(p * np.log2(p)).sum() / 8 + 100


def test_damage_is_found(spark, odd_docs):
    folder = written(spark, odd_docs)
    blocks = spark.read.parquet(folder)
    bad = blocks.selectExpr(*[c if c != "words" else "cast(reverse(hex(words)) as binary) as words" for c in blocks.columns])
    bad.write.parquet(folder + "-bad")
    spark.read.parquet(folder + "-table").write.parquet(folder + "-bad-table")
    with pytest.raises(Exception, match="damaged"):
        ans.read_documents(spark, folder + "-bad").collect()
