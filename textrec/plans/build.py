"""The model build as one lazy plan: clean lines -> split -> corpus -> TF-IDF."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from textrec.functions.stem import stem_map as stem_map_of
from textrec.operators import clean as C
from textrec.operators import model as M
from textrec.operators import score as S
from textrec.operators import split as SP
from textrec.session import materialize
from textrec.sources import fixtures as FX

TEST_FRAC = 0.1
SEED = 42


@dataclass
class Model:
    posts_clean: DataFrame
    verses_clean: DataFrame
    test_posts: DataFrame
    train_posts: DataFrame
    test_verses: DataFrame
    train_verses: DataFrame
    tf: DataFrame
    postings: DataFrame       # sorted by term in ranges of (term, song)
    corpus_ids: DataFrame     # songs in the corpus, kept next to the postings for zero padding
    blocks: DataFrame         # sizes and largest weights of the postings' blocks


def build_model(spark: SparkSession, sf_dir: str, frac: float = TEST_FRAC, seed: int = SEED,
                stem_map: DataFrame | None = None, hashed: bool = False,
                stem: bool = False) -> Model:
    """Clean -> split -> corpus -> TF-IDF with two materialisation points:
    the cleaned lines, and the term counts / postings."""
    pc, vc = C.clean_lines(FX.table(spark, sf_dir, "documents"))   # one scan of the raw text
    pc = materialize(pc, "posts-clean")
    return build_from_lines(pc, vc, frac, seed, stem_map, hashed, stem)


def build_from_lines(pc: DataFrame, vc: DataFrame, frac: float = TEST_FRAC, seed: int = SEED,
                     stem_map: DataFrame | None = None, hashed: bool = False,
                     stem: bool = False) -> Model:
    """The model from cleaned post and lyric lines (e.g. read back from the
    cleaning job's output, the first materialisation point)."""
    tp, rp = SP.split_hash(pc, frac, ("id", "tweet_line"), seed)
    tv, rv = SP.split_hash(vc, frac, ("id", "lyric_line"), seed)
    corpus = M.corpus_terms(rp, rv, stem_map=stem_map)
    if stem and stem_map is None:
        # Stem the corpus vocabulary once (distinct terms), re-add counts
        corpus = M.apply_stems(corpus, stem_map_of(corpus.select("term")))
    tf = materialize(corpus, "corpus-tf")
    post = M.tfidf_hashed(tf) if hashed else M.tfidf(tf)
    key = "h" if hashed else "term"
    # ranges of (term, song): a term held by every song is spread over several
    # tasks, and files are sorted by term, so a text's terms skip row groups
    post = post.repartitionByRange(key, "id").sortWithinPartitions(key, "id")
    postings = materialize(post, "postings")
    corpus_ids = materialize(tf.select("id").distinct(), "corpus-ids")
    blocks = materialize(S.posting_blocks(postings, key), "posting-blocks")
    return Model(pc, vc, tp, rp, tv, rv, tf, postings, corpus_ids, blocks)
