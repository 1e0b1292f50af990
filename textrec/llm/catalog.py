"""The registered queries of this subpackage: each applies an operator, with
its production parameters, to its whole table."""

from __future__ import annotations

from textrec.llm import (ans, compression, group_jaccard, lexical, lexicon, licences, nbsvm, pii, positional, prefix_trie,
                         toxicity, url_markov, warc)

QUERIES = {
    "op1_static_rans": ans.op1_static_rans,
    "op2_compression_bands": compression.op2_compression_bands,
    "op3_paragraph_licences": licences.op3_paragraph_licences,
    "op4_token_groups": group_jaccard.op4_token_groups,
    "op5_transducer_bpe": lexicon.op5_transducer_bpe,
    "op6_positional_index": positional.op6_positional_index,
    "op6_positional_near": positional.op6_positional_near,
    "op7_compression_distance": toxicity.op7_compression_distance,
    "op8_crf_pii": pii.op8_crf_pii,
    "op9_splittable_warc": warc.op9_splittable_warc,
    "op10_nbsvm_quality": nbsvm.op10_nbsvm_quality,
    "op11_prefix_trie": prefix_trie.op11_prefix_trie,
    "op12_shared_search": lexical.op12_shared_search,
    "op13_url_markov": url_markov.op13_url_markov,
}
