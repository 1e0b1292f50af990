"""Evaluation.

Every held-out line is a query; all are scored in one join against the
postings (J10) instead of one full scoring pass per test row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrec.functions import text as T
from textrec.operators import score as S
from textrec.operators.clean import test_rows

LIST_SIZE = 15   # D4: top-15 list, one-based; LIST_SIZE=10 + HIT_RANK=15 reproduces the code
HIT_RANK = 14    # zero-based rank counted as a hit


def query_key(*cols):
    """A compact 96-bit key for a query row (two independent hashes): with a
    billion test lines a collision, which would merge two queries, stays
    below one in ten billion."""
    return F.struct(F.xxhash64(*cols).alias("h64"), F.hash(*cols).alias("h32"))


def sample_tests(test: DataFrame, n: int | None, id_col: str = "id", line_col: str = "tweet_line") -> DataFrame:
    """The first n test rows in a fixed arbitrary order (content hash)."""
    if n is None:
        return test
    drawn = F.md5(F.concat_ws("|", F.col(id_col).cast("string"), F.col(line_col)))
    return test.orderBy(drawn, id_col, line_col).limit(n)


def target_ranks(test: DataFrame, postings: DataFrame, list_size: int = LIST_SIZE,
                 id_col: str = "id", line_col: str = "tweet_line", term_col: str = "term",
                 corpus_ids: DataFrame | None = None, blocks: DataFrame | None = None, **qopts) -> DataFrame:
    """M7 / G3 for every test row: (id, tweet_line, rank) where rank is the
    zero-based position of the row's own song in the top ``list_size`` for
    that line, or 100000 when it is not in the list."""
    rows = test_rows(test.select(id_col, line_col), line_col)
    q = rows.select(query_key(id_col, line_col).alias("qid"), F.col(id_col).alias("target"), line_col)
    qt = S.query_terms(q.select("qid", F.col(line_col).alias("text")), "qid", "text",
                       hashed=(term_col == "h"), **qopts)
    ids = corpus_ids if corpus_ids is not None else postings.select(id_col).distinct()
    scored = S.top_scores(qt, postings, list_size, blocks, "qid", id_col, term_col)
    best = S.full_top_k(q, scored, ids, list_size, "qid", id_col)
    hits = best.select("qid", F.col(id_col).alias("target"), (F.col("rank") - 1).alias("rank"))
    joined = q.join(hits, ["qid", "target"], "left")
    return joined.select(F.col("target").alias(id_col), line_col,
                         F.coalesce("rank", F.lit(T.MISSING_RANK)).cast("int").alias("rank"))


def accuracy(ranks: DataFrame, hit_rank: int = HIT_RANK) -> DataFrame:
    """(n_tests, n_hits, accuracy) over all ranked test rows."""
    hit = (F.col("rank") <= hit_rank).cast("int")
    return ranks.agg(F.count("*").alias("n_tests"), F.sum(hit).alias("n_hits"),
                     F.round(F.avg(hit.cast("double")), 6).alias("accuracy"))


def accuracy_at(ranks: DataFrame, ks=(10, 15)) -> DataFrame:
    """Hit rates for several list sizes in one pass over the ranks (computed
    with a list of at least max(ks)): (n_tests, hits_at_k, accuracy_at_k ...)."""
    cols = [F.count("*").alias("n_tests")]
    for k in ks:
        hit = (F.col("rank") < k).cast("int")
        cols += [F.sum(hit).alias(f"hits_at_{k}"), F.round(F.avg(hit.cast("double")), 6).alias(f"accuracy_at_{k}")]
    return ranks.agg(*cols)
