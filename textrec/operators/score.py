"""Scoring and recommendation.

A query is scored against every song as the unnormalised dot product of its
raw term counts (IDF is not applied to the query, M4) with the songs' TF-IDF
weights.  Instead of shipping a query vector into a UDF and scoring every
song, query terms are joined to the postings on the term; any number of queries
share one plan, and partial sums are combined map-side before the (query, song)
shuffle.

For the k best songs of many queries not all postings are joined.  The postings
of a term fall into blocks by the power of two of their weight; a table of the
blocks holds their sizes and largest weights.  A few short blocks of a query give
a score that k songs reach at least; blocks whose largest weights can't add up
to it together are left out of the join, and only songs that may still be among
the best have their other postings looked up.  Lists are exact; a term that
nearly every song has is joined where its weight can matter, and else not.

Where queries are many and their terms common, as with all held-out lines, bounds
leave out little and nearly every (query, song) pair has a score.  Then blocks of
queries meet blocks of songs in cells: a cell sums the scores of its pairs in
memory and gives the k best songs of each query, so no pair is ever shuffled."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from textrec.functions import text as T
from textrec.operators import model as M
from textrec.session import materialize, ship_package

RANK_DIGITS = 9   # ranking uses round(score, 9) desc, id asc (D12)
OUT_DIGITS = 6


def query_terms(queries: DataFrame, qid: str = "query_id", text_col: str = "text",
                stop_words=T.STOP_WORDS, min_tokens: int = T.MIN_QUERY_TOKENS,
                mult: int = T.QUERY_REPEAT, stem_map: DataFrame | None = None,
                hashed: bool = False, num_features: int = M.NUM_FEATURES,
                stem: bool = False) -> DataFrame:
    """(query_id, term|h, qtf): raw counts after T7 and the T13 repetition.

    ``stem`` stems the queries' own distinct terms (D6); ``stem_map`` applies
    a given (term, stem) table instead."""
    # explode first and test tokens with code-generated predicates (as the
    # corpus does); the token count of a query, which sets the repetition,
    # is a window sum over that query's distinct terms (bounded by its text)
    words = queries.select(qid, F.explode_outer(T.pieces(text_col)).alias("term"))
    occ = words.where(F.col("term").isNotNull() & T.is_token("term", stop_words))
    cnt = (occ.groupBy(qid, "term").agg(F.count("*").alias("_c"))
              .withColumn("_n", F.sum("_c").over(Window.partitionBy(qid))))
    qtf = cnt.select(qid, "term", (F.col("_c") * T.repeat_factor("_n", min_tokens, mult)).alias("qtf"))
    if stem and stem_map is None:
        from textrec.functions.stem import stem_map as _stem_map
        stem_map = _stem_map(qtf.select("term"))
    if stem_map is not None:
        qtf = (qtf.join(stem_map, "term", "left")
                  .select(qid, F.coalesce("stem", "term").alias("term"), "qtf")
                  .groupBy(qid, "term").agg(F.sum("qtf").alias("qtf")))
    if hashed:
        qtf = (M.hash_terms(qtf, num_features=num_features)
                 .groupBy(qid, "h").agg(F.sum("qtf").alias("qtf")))
    return qtf


def scores(qterms: DataFrame, postings: DataFrame, qid: str = "query_id", id_col: str = "id",
           term_col: str = "term") -> DataFrame:
    """(query_id, id, score) for every song sharing a term with the query."""
    p = postings.where(F.col("w") != 0).select(term_col, id_col, "w")
    return (qterms.join(p, term_col, "inner")
                  .groupBy(qid, id_col).agg(F.sum(F.col("qtf") * F.col("w")).alias("score")))


#: Postings that a query's first look may join.
FIRST_ROWS = 1000
#: Joined rows of all queries together up to which the bounds cost more than they save.
JOIN_ROWS = 100_000_000
#: Joined rows up to which the join is made directly even if it has more rows than the postings.
SMALL_JOIN_ROWS = 5_000_000
#: Postings, and query terms, that a cell holds in memory at most on average.
CELL_ROWS = 4_000_000


def weight_level(w="w"):
    """The block of a posting within its term: the power of two of its weight."""
    return F.floor(F.log2(F.col(w))).cast("int")


def posting_blocks(postings: DataFrame, term_col: str = "term") -> DataFrame:
    """(term, lv, n, hi): size and largest weight of each block of a term."""
    p = postings.where(F.col("w") != 0).select(term_col, weight_level().alias("lv"), "w")
    return p.groupBy(term_col, "lv").agg(F.count("*").alias("n"), F.max("w").alias("hi"))


def query_blocks(qterms: DataFrame, blocks: DataFrame, qid: str = "query_id", term_col: str = "term") -> DataFrame:
    """The blocks of each query's terms, with ``ub``, the most that a posting of
    the block adds to a score, and ``rest``, the most that a song can score that
    has postings in this block and in those of smaller ``ub`` only."""
    qb = qterms.join(blocks, term_col).select(qid, term_col, "qtf", "lv", "n", (F.col("qtf") * F.col("hi")).alias("ub"))
    down = (F.col("ub").desc(), F.col(term_col), F.col("lv").desc())
    below = F.lead("ub", 1, 0.0).over(Window.partitionBy(qid, term_col).orderBy(F.col("lv").desc()))
    step = qb.withColumn("_step", F.col("ub") - below)
    onward = Window.partitionBy(qid).orderBy(*down).rowsBetween(0, Window.unboundedFollowing)
    return step.withColumn("rest", F.sum("_step").over(onward)).drop("_step")


def _join_blocks(chosen: DataFrame, postings: DataFrame, qid: str, id_col: str, term_col: str) -> DataFrame:
    p = postings.where(F.col("w") != 0).select(term_col, id_col, "w", weight_level().alias("lv"))
    return (chosen.select(qid, term_col, "lv", "qtf").join(p, [term_col, "lv"])
                  .groupBy(qid, id_col).agg(F.sum(F.col("qtf") * F.col("w")).alias("score")))


def least_scores(qb: DataFrame, postings: DataFrame, k: int, qid: str = "query_id", id_col: str = "id",
                 term_col: str = "term", first_rows: int = FIRST_ROWS) -> DataFrame:
    """(query, least): a score that at least k songs reach, from the query's
    blocks of the largest weights, ``first_rows`` postings together."""
    so_far = Window.partitionBy(qid).orderBy(F.col("ub").desc(), term_col, "lv").rowsBetween(Window.unboundedPreceding, 0)
    small = qb.where(F.col("n") <= first_rows).withColumn("_sum", F.sum("n").over(so_far))
    part = _join_blocks(small.where(F.col("_sum") <= first_rows), postings, qid, id_col, term_col)
    best = top_k(part, k, qid, id_col)
    return best.groupBy(qid).agg(F.count("*").alias("_n"), F.min("score").alias("least")).where(F.col("_n") == k).drop("_n")


def needed_blocks(qb: DataFrame, least: DataFrame, qid: str = "query_id") -> DataFrame:
    """``qb`` with ``least`` (0 if there is none) and ``needed``: whether songs
    that have no larger block can still reach it."""
    held = qb.join(least, qid, "left").withColumn("least", F.coalesce("least", F.lit(0.0)))
    # a little below, so that neither rounding nor the order of adding loses a tie
    return held.withColumn("least", F.col("least") * (1 - 1e-9) - 1e-6).withColumn("needed", F.col("rest") >= F.col("least"))


def _best_of_cell(queries: pa.Table, postings: pa.Table, k: int) -> pa.Table:
    """(qid, id, score): the k best songs of the cell for each of its queries.

    ``queries`` has qid and the arrays terms and qtfs, ``postings`` term, id, w."""
    term = postings["term"].combine_chunks().dictionary_encode(null_encoding="encode")
    song = postings["id"].combine_chunks().dictionary_encode(null_encoding="encode")
    # songs are numbered in the order of their ids, which decides between equal scores
    by_id = pc.sort_indices(song.dictionary, null_placement="at_start")
    number = np.empty(len(by_id), dtype=np.int64)
    number[by_id.to_numpy()] = np.arange(len(by_id))
    code = term.indices.to_numpy(zero_copy_only=False)
    by_term = np.argsort(code, kind="stable")
    songs = number[song.indices.to_numpy(zero_copy_only=False)[by_term]]
    w = postings["w"].to_numpy()[by_term]
    start = np.concatenate([[0], np.cumsum(np.bincount(code, minlength=len(term.dictionary)))])
    lists = queries["terms"].combine_chunks()
    codes = pc.fill_null(pc.index_in(lists.flatten(), value_set=term.dictionary), -1).to_numpy(zero_copy_only=False)
    qtfs = queries["qtfs"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    rows, found, scores_ = [], [], []
    for i, end in enumerate(ends):
        begin = ends[i - 1] if i else 0
        parts = [(start[c], start[c + 1], f) for c, f in zip(codes[begin:end], qtfs[begin:end]) if c >= 0]
        if not parts:
            continue
        score = np.bincount(np.concatenate([songs[a:b] for a, b, _ in parts]),
                            weights=np.concatenate([w[a:b] * f for a, b, f in parts]), minlength=len(number))
        least = np.partition(score, -k)[-k] if len(score) > k else 0.0
        # ties of the k-th score in the order of the ranking, also those that rounding makes
        near = np.nonzero((score > 0) & (score >= least - 10.0 ** -RANK_DIGITS))[0]
        best = near[np.lexsort((near, -np.round(score[near], RANK_DIGITS)))[:k]]
        rows.append(np.full(len(best), i))
        found.append(best)
        scores_.append(score[best])
    none = [np.empty(0, dtype=np.int64)]
    return pa.table({
        "qid": queries["qid"].combine_chunks().take(pa.array(np.concatenate(rows or none))),
        "id": song.dictionary.take(by_id.take(pa.array(np.concatenate(found or none)))),
        "score": pa.array(np.concatenate(scores_ or none).astype(np.float64))})


def cell_scores(qterms: DataFrame, postings: DataFrame, k: int, n_terms: int, n_postings: int, qid: str = "query_id",
                id_col: str = "id", term_col: str = "term", cell_rows: int = CELL_ROWS) -> DataFrame:
    """(query_id, id, score): the k best songs of each query in each block of
    songs, scored in cells of (block of queries, block of songs).

    Every posting goes to a cell of each block of queries and every query to a
    cell of each block of songs; both are counted beforehand, so that a cell
    fits a task's memory.  Blocks are by hash: a hot song is one of many in its
    block, and a hot term is spread over all of them."""
    spark = qterms.sparkSession
    ship_package(spark)
    q_blocks = max(1, -(-n_terms // cell_rows))
    small = -(-n_postings // max(1, cell_rows // 16))     # so many cells at most, for the cluster's cores
    s_blocks = max(-(-n_postings // cell_rows), min(small, spark.sparkContext.defaultParallelism), 1)
    per_query = (qterms.groupBy(F.col(qid).alias("qid"))
                       .agg(F.sort_array(F.collect_list(F.struct(F.col(term_col).alias("term"), F.col("qtf").cast("double").alias("qtf")))).alias("_t")))
    queries = per_query.select(
        "qid", F.col("_t.term").alias("terms"), F.col("_t.qtf").alias("qtfs"), F.pmod(F.xxhash64("qid"), F.lit(q_blocks)).alias("_qb"),
        F.explode(F.sequence(F.lit(0), F.lit(s_blocks - 1))).alias("_sb"))
    songs = postings.where(F.col("w") != 0).select(
        F.col(term_col).alias("term"), F.col(id_col).alias("id"), "w", F.pmod(F.xxhash64(id_col), F.lit(s_blocks)).alias("_sb"),
        F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))).alias("_qb"))
    cell = (F.col("_qb") * s_blocks + F.col("_sb")).cast("long").alias("_cell")
    schema = StructType([StructField("qid", qterms.schema[qid].dataType), StructField("id", postings.schema[id_col].dataType),
                         StructField("score", DoubleType())])
    best = (queries.select(cell, "qid", "terms", "qtfs").groupBy("_cell")
                   .cogroup(songs.select(cell, "term", "id", "w").groupBy("_cell"))
                   .applyInArrow(lambda q, p: _best_of_cell(q, p, k), schema))
    return best.select(F.col("qid").alias(qid), F.col("id").alias(id_col), "score")


def top_scores(qterms: DataFrame, postings: DataFrame, k: int, blocks: DataFrame | None = None, qid: str = "query_id",
               id_col: str = "id", term_col: str = "term", first_rows: int = FIRST_ROWS,
               join_rows: int = JOIN_ROWS) -> DataFrame:
    """(query_id, id, score) of every song that may be among the k best of a query.

    The block table tells beforehand how many rows the join of all postings
    would have.  While these are at most ``join_rows`` and no more than the
    postings, it is made directly, as a join is broadcast below a size; else
    the scores are summed in cells.  With ``join_rows`` 0 the bounds decide which
    postings are joined.  The rows of the k best are the same in all cases."""
    blocks = blocks if blocks is not None else posting_blocks(postings, term_col)
    qterms = materialize(qterms, "query-terms")
    joined = qterms.join(blocks, term_col).agg(F.sum("n")).first()[0] or 0
    n_postings = blocks.agg(F.sum("n")).first()[0] or 0
    if joined <= min(join_rows, max(n_postings, SMALL_JOIN_ROWS)):
        return scores(qterms, postings, qid, id_col, term_col)
    if join_rows > 0:
        return cell_scores(qterms, postings, k, qterms.count(), n_postings, qid, id_col, term_col)
    qb = materialize(query_blocks(qterms, blocks, qid, term_col), "query-blocks")
    least = least_scores(qb, postings, k, qid, id_col, term_col, first_rows)
    marked = materialize(needed_blocks(qb, least, qid), "query-needed")
    seen = _join_blocks(marked.where("needed"), postings, qid, id_col, term_col)
    left = marked.where("NOT needed")
    bound = marked.groupBy(qid).agg(F.min("least").alias("least"), F.coalesce(
        F.max(F.when(~F.col("needed"), F.col("rest"))), F.lit(0.0)).alias("rest"))
    maybe = materialize(seen.join(bound, qid).where(F.col("score") + F.col("rest") >= F.col("least"))
                            .select(qid, id_col, "score"), "query-songs")
    p = postings.where(F.col("w") != 0).select(term_col, id_col, "w", weight_level().alias("lv"))
    more = (maybe.select(qid, id_col).join(left.select(qid, term_col, "lv", "qtf"), qid)
                 .join(p, [term_col, id_col, "lv"])
                 .groupBy(qid, id_col).agg(F.sum(F.col("qtf") * F.col("w")).alias("_more")))
    return (maybe.join(more, [qid, id_col], "left")
                 .select(qid, id_col, (F.col("score") + F.coalesce("_more", F.lit(0.0))).alias("score")))


def _order(id_col: str):
    return [F.round("score", RANK_DIGITS).desc(), F.col(id_col).asc()]


def top_k(scored: DataFrame, k: int, qid: str = "query_id", id_col: str = "id") -> DataFrame:
    """Best k songs per query; ``row_number() <= k`` is planned as a
    window group limit, so each map task keeps only k rows per query."""
    w = Window.partitionBy(qid).orderBy(*_order(id_col))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def full_top_k(queries: DataFrame, scored: DataFrame, corpus_ids: DataFrame, k: int, qid: str = "query_id",
               id_col: str = "id") -> DataFrame:
    """G2 with whole lists: min(k, songs) rows for every query, also for one
    without a token (D13).

    Songs without a common term score 0.  If more than k songs match, zeros
    never enter a list; otherwise all matches are in the top k.  So the k
    smallest corpus ids with score 0, merged with the matched top k, give
    exactly the full list: 2k rows a query at most."""
    low = corpus_ids.select(id_col).orderBy(id_col).limit(k).select(F.collect_list(id_col)).scalar()
    zero = queries.select(qid).distinct().select(qid, F.explode(low).alias(id_col), F.lit(0.0).alias("score"))
    best = top_k(scored, k, qid, id_col).select(qid, id_col, "score")
    both = best.unionByName(zero).groupBy(qid, id_col).agg(F.max("score").alias("score"))
    return top_k(both, k, qid, id_col)


def recommend(queries: DataFrame, postings: DataFrame, songs: DataFrame, k: int = 15,
              qid: str = "query_id", text_col: str = "text", id_col: str = "id",
              term_col: str = "term", corpus_ids: DataFrame | None = None, blocks: DataFrame | None = None,
              join_rows: int = JOIN_ROWS, **qopts) -> DataFrame:
    """M6 for a batch of queries: (query_id, rank, id, name, score), with
    min(k, songs) rows for each query.  ``corpus_ids`` and ``blocks``, where they
    are stored beside the postings, save a pass over these."""
    qt = query_terms(queries, qid, text_col, hashed=(term_col == "h"), **qopts)
    ids = corpus_ids if corpus_ids is not None else postings.select(id_col).distinct()
    best = full_top_k(queries, top_scores(qt, postings, k, blocks, qid, id_col, term_col, join_rows=join_rows), ids, k, qid, id_col)
    named = best.join(songs.select(id_col, "name"), id_col, "left")
    return named.select(qid, "rank", id_col, "name", F.round("score", OUT_DIGITS).alias("score"))


#: Up to so many distinct terms a text's own terms are given to the scan.
SCAN_TERMS = 1000


def of_terms(postings: DataFrame, qterms: DataFrame, term_col: str = "term") -> DataFrame:
    """The postings of one text's terms, as a filter that reaches the scan: files
    are sorted by term, so other row groups are skipped.  At most a text's own
    terms come to the driver; a text with more than ``SCAN_TERMS`` is left to the
    join."""
    terms = [r[0] for r in qterms.select(term_col).distinct().limit(SCAN_TERMS + 1).collect()]
    if len(terms) > SCAN_TERMS:
        return postings
    tests = [F.col(term_col) == t for t in sorted(terms)] or [F.lit(False)]
    while len(tests) > 1:                                # a balanced tree of ORs
        tests = [tests[i] | tests[i + 1] if i + 1 < len(tests) else tests[i] for i in range(0, len(tests), 2)]
    return postings.where(tests[0])


def recommend_one(text: str, postings: DataFrame, songs: DataFrame, k: int = 15,
                  id_col: str = "id", term_col: str = "term", pad_zero: bool = True,
                  corpus_ids: DataFrame | None = None, **qopts) -> DataFrame:
    """M6 / G1 for one text.

    The query is one literal row (no Python data path); the scan of the postings
    is given its terms.  With
    ``pad_zero`` songs scoring 0 fill the list in id order when fewer than k
    corpus songs match (D13), taken from the k smallest unmatched corpus ids;
    only the 2k candidate rows are ever merged."""
    spark = postings.sparkSession
    q = spark.range(0, 1, 1, 1).select(F.lit(0).alias("query_id"), F.lit(text).alias("text"))
    qt = query_terms(q, hashed=(term_col == "h"), **qopts)
    ids = corpus_ids if corpus_ids is not None else postings.select(id_col).distinct()
    postings = of_terms(postings, qt, term_col)
    sc = scores(qt, postings, "query_id", id_col, term_col).select(id_col, "score")
    best = sc.orderBy(*_order(id_col)).limit(k)
    if pad_zero:
        # If more than k songs match, zeros never enter the list; otherwise all
        # matches are in ``best``.  So the k smallest corpus ids with score 0,
        # merged with ``best`` keeping each id's larger score (at most 2k
        # rows), give exactly the padded list.
        zero = ids.select(id_col).orderBy(id_col).limit(k).withColumn("score", F.lit(0.0))
        best = (best.unionByName(zero).groupBy(id_col).agg(F.max("score").alias("score"))
                    .orderBy(*_order(id_col)).limit(k))
    ranked = best.withColumn("rank", F.row_number().over(Window.orderBy(*_order(id_col))))
    # as in the reference, an id missing from the song table gives no row
    named = ranked.join(songs.select(id_col, "name"), id_col, "inner")
    # at most k rows, in rank order; they are brought together after the join, as
    # a coalesce would have one task read the whole song table
    return (named.select("rank", id_col, "name", F.round("score", OUT_DIGITS).alias("score"))
                 .repartition(1).sortWithinPartitions("rank"))
