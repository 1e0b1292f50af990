"""run() against plain Python, stage by stage, and the defined cases."""

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as CP
from tests.llm import test_group_jaccard, test_positional
from textrec.llm import compression, lexicon, pii


def brute(spark, sf):
    docs = [tuple(r) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    limits = compression.fit_norms(spark.read.parquet(f"{sf}/documents.parquet"))
    ratios = compression.Ratios()
    docs = [(i, t) for i, t in docs if not compression.base_measures(t or "")[-1]
            and compression.verdict((t or "").encode(), ratios, limits)[0]]
    component = {r[0]: r[2] for r in test_group_jaccard.expected(docs)}
    docs = [(i, t) for i, t in docs if component[i] == i]
    items = [tuple(r) for r in spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text").collect()]
    hit = {r[0] for r in test_positional.expected(docs, items) if r[2]}
    docs = [(i, t) for i, t in docs if i not in hit]
    docs = [(i, pii.redacted(t, pii.all_spans([t], pii.field())[0][1])) for i, t in docs]
    tok = Tokenizer.from_file(public_tokenizers.path(lexicon.VOCABULARY))
    return {(i, t, tuple(tok.encode(t, add_special_tokens=False).ids)) for i, t in docs}


def test_run_equals_plain_python(spark, sf):
    out = CP.run(spark, sf)
    rows = out.collect()
    assert {(r.doc_id, r.text, tuple(r.token_ids)) for r in rows} == brute(spark, sf)
    assert all(r.n_chars == len(r.text) for r in rows) and 0 < len(rows) < 200


def test_stages_keep_the_columns(spark, sf, odd_docs, no_docs):
    for docs in (odd_docs, no_docs):
        for i, (_, stage) in enumerate(CP.STAGES):
            out = stage(spark, docs, sf)
            out.count()
            if i < len(CP.STAGES) - 1:
                assert out.columns == docs.columns
    assert [k for k, _ in CP.STAGES] == ["quality", "near_duplicates", "decontamination", "personal_data", "tokens"]
