"""TF-IDF, scoring and ranking (golden rows and properties)."""

import math
import random

import pytest
from pyspark.sql import functions as F

from textrec.functions import text as T
from textrec.operators import evaluate as E
from textrec.operators import model as M
from textrec.operators import score as S


def tf_frame(spark):
    return spark.createDataFrame([(1, "aaa", 2), (1, "bbb", 1), (2, "aaa", 1), (2, "ccc", 1)],
                                 "id long, term string, tf long")


def test_idf_golden(spark):
    idf = {r.term: r.idf for r in M.fit_idf(tf_frame(spark)).collect()}
    assert idf["aaa"] == 0.0
    assert abs(idf["bbb"] - math.log(1.5)) < 1e-12 and abs(idf["ccc"] - math.log(1.5)) < 1e-12


def test_score_golden(spark):
    post = M.tfidf(tf_frame(spark))
    q = spark.createDataFrame([(0, "bbb")], "query_id int, text string")
    qt = S.query_terms(q, min_tokens=1)
    got = {r.id: r.score for r in S.scores(qt, post).collect()}
    assert abs(got[1] - 0.405465) < 1e-6 and 2 not in got


def test_recommend_one_pads_with_zero_scores(spark):
    post = M.tfidf(tf_frame(spark))
    songs = spark.createDataFrame([(1, "one"), (2, "two")], "id long, name string")
    rows = S.recommend_one("zzz", post, songs, k=5).collect()
    assert [(r.rank, r.id, r.score) for r in rows] == [(1, 1, 0.0), (2, 2, 0.0)]
    rows = S.recommend_one("bbb ccc ccc", post, songs, k=1).collect()
    assert [r.id for r in rows] == [2]


def test_repetition_does_not_change_ranking(spark):
    post = M.tfidf(tf_frame(spark))
    q = spark.createDataFrame([(0, "bbb ccc ccc"), (1, "bbb ccc ccc bbb ccc ccc")], "query_id int, text string")
    top = S.top_k(S.scores(S.query_terms(q, min_tokens=1), post), 2)
    ranks = {(r.query_id, r.id): r.rank for r in top.collect()}
    assert ranks[(0, 1)] == ranks[(1, 1)] and ranks[(0, 2)] == ranks[(1, 2)]


def test_hashed_equals_exact_where_no_collision(spark, sf):
    from textrec.plans.build import build_model
    m = build_model(spark, sf)
    vocab = M.hash_terms(m.tf.select("term").distinct())
    single = vocab.groupBy("h").count().where("count = 1").select("h")
    assert 0 < single.count() < vocab.count()          # some buckets collide, most do not
    exact = (m.postings.join(vocab, "term").join(single, "h", "left_semi")
             .select("id", "h", "tf", F.round("w", 9).alias("w")))
    hashed = (M.tfidf_hashed(m.tf).join(single, "h", "left_semi")
              .select("id", "h", "tf", F.round("w", 9).alias("w")))
    assert exact.count() > 0
    assert exact.exceptAll(hashed).count() == 0 and hashed.exceptAll(exact).count() == 0


def test_target_rank_missing_is_sentinel(spark):
    post = M.tfidf(tf_frame(spark))
    test = spark.createDataFrame([(2, "bbb bbb"), (1, "bbb")], "id long, tweet_line string")
    ranks = {r.id: r.rank for r in E.target_ranks(test, post, list_size=1).collect()}
    assert ranks == {2: 100000, 1: 0}
    acc = E.accuracy(E.target_ranks(test, post, list_size=1)).collect()[0]
    assert acc.n_tests == 2 and acc.n_hits == 1


def test_topk_rows_per_query(spark, sf):
    from textrec.plans import catalog
    recs = catalog.q_recommend_benchmark(spark, sf)
    per = recs.groupBy("item_id").count().collect()
    songs = catalog.build_model(spark, sf).corpus_ids.count()
    assert len(per) == spark.read.parquet(f"{sf}/benchmark.parquet").count()
    assert all(r["count"] == min(catalog.TOP_K, songs) for r in per)


def test_a_query_without_tokens_gets_a_full_list(spark):
    post = M.tfidf(tf_frame(spark))
    ids = sorted(r.id for r in post.select("id").distinct().collect())
    songs = post.select("id").distinct().withColumn("name", F.lit("x"))
    queries = spark.createDataFrame([(0, ""), (1, "zzz"), (2, None), (3, "bbb")], "query_id int, text string")
    for k in (1, 2, 50):
        rows = S.recommend(queries, post, songs, k).collect()
        for q in range(4):
            mine = sorted((r.rank, r.id) for r in rows if r.query_id == q)
            assert [rank for rank, _ in mine] == list(range(1, min(k, len(ids)) + 1))
            if q < 3:
                assert [i for _, i in mine] == ids[:k]


def test_sample_tests_is_stable(spark, sf):
    from textrec.plans.build import build_model
    test = build_model(spark, sf).test_posts
    a = [tuple(r) for r in E.sample_tests(test, 5).collect()]
    b = [tuple(r) for r in E.sample_tests(test, 5).collect()]
    assert len(a) == min(5, test.count()) and sorted(a) == sorted(b)


def test_hashed_recommend_close_to_exact(spark, sf):
    from textrec.plans import catalog
    exact = {(r.item_id, r.id) for r in catalog.q_recommend_benchmark(spark, sf).collect()}
    hashed = {(r.item_id, r.id) for r in catalog.q_recommend_hashed(spark, sf).collect()}
    assert len(exact & hashed) >= 0.9 * len(exact)


def test_one_text_reads_the_row_groups_of_its_terms(spark, sf):
    """The scan is given the text's own terms; the list is that of the whole join."""
    from textrec.plans.build import build_model
    from textrec.sources import fixtures as FX
    m = build_model(spark, sf)
    songs = FX.songs(spark, sf)
    text = " ".join(r.term for r in m.tf.groupBy("term").count().orderBy("count", "term").limit(3).collect())
    one = S.recommend_one(text, m.postings, songs, 15, corpus_ids=m.corpus_ids)
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [" in plan and "EqualTo(term," in plan
    batch = S.recommend(spark.createDataFrame([(0, text)], "query_id int, text string"), m.postings, songs, 15,
                        corpus_ids=m.corpus_ids, blocks=m.blocks)
    assert [tuple(r) for r in one.collect()] == [tuple(r)[1:] for r in batch.orderBy("rank").collect()]
    long = " ".join(r.term for r in m.tf.select("term").distinct().limit(S.SCAN_TERMS + 5).collect())
    assert S.recommend_one(long, m.postings, songs, 15, corpus_ids=m.corpus_ids).count() == min(15, m.corpus_ids.count())


@pytest.fixture(scope="module")
def random_postings(spark):
    rnd = random.Random(8)
    rows = []
    for t in range(40):
        share = 0.9 if t < 3 else rnd.choice([0.02, 0.1, 0.4])
        for song in range(400):
            if rnd.random() < share:
                tf = rnd.choice([1, 1, 1, 2, 3, 8, 40])
                rows.append((song, f"t{t}", float(tf) * (0.1 if t < 3 else rnd.choice([1.5, 2.25]))))
    queries = [(q, f"t{rnd.randrange(40)}" if rnd.random() < 0.7 else f"t{rnd.randrange(3)}", rnd.choice([1, 1, 5]))
               for q in range(60) for _ in range(rnd.randint(1, 8))] + [(100, "t0", 1), (101, "unknown", 1), (102, "t1", 25)]
    terms = spark.createDataFrame(queries, "query_id int, term string, c int").groupBy("query_id", "term").agg(F.sum("c").alias("qtf"))
    return spark.createDataFrame(rows, "id int, term string, w double"), terms


@pytest.mark.parametrize("k, first_rows", [(1, 1000), (5, 1000), (5, 20), (15, 100), (500, 1000)])
def test_bounded_lists_equal_the_whole_join(random_postings, k, first_rows):
    postings, terms = random_postings
    want = S.top_k(S.scores(terms, postings), k)
    got = S.top_k(S.top_scores(terms, postings, k, first_rows=first_rows, join_rows=0), k)
    key = lambda df: sorted((r.query_id, r["rank"], r.id, round(r.score, 9)) for r in df.collect())
    assert key(got) == key(want)


def test_a_term_of_nearly_every_song_is_not_joined(spark):
    """Joined rows follow the rare terms: ten times the songs add none."""
    def joined(n_songs):
        hot = [(s, "hot", 0.1) for s in range(n_songs) if s % 10]
        rare = [(s, f"rare{s % 20}", 5.0 + s % 7) for s in range(400)]
        postings = spark.createDataFrame(hot + rare, "id int, term string, w double")
        terms = spark.createDataFrame([(q, t, 1) for q in range(20) for t in ("hot", f"rare{q}")], "query_id int, term string, qtf long")
        qb = S.query_blocks(terms, S.posting_blocks(postings))
        marked = S.needed_blocks(qb, S.least_scores(qb, postings, 10))
        want = S.top_k(S.scores(terms, postings), 10)
        got = S.top_k(S.top_scores(terms, postings, 10, join_rows=0), 10)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
        return marked.where("needed").agg(F.sum("n")).first()[0]
    assert joined(500) == joined(5000) <= 400


@pytest.mark.parametrize("k, cell_rows", [(1, 10**6), (5, 1500), (15, 40), (500, 300)])
def test_lists_from_cells_equal_the_whole_join(random_postings, k, cell_rows):
    """However the queries and the songs fall into cells; ties go by id."""
    postings, terms = random_postings
    key = lambda df: sorted((r.query_id, r["rank"], r.id, round(r.score, 9)) for r in df.collect())
    want = key(S.top_k(S.scores(terms, postings), k))
    args = (k, terms.count(), postings.count())
    assert key(S.top_k(S.cell_scores(terms, postings, *args, cell_rows=cell_rows), k)) == want
    named = postings.select(F.concat(F.lit("s"), "id").alias("id"), "term", "w")
    keyed = terms.select(F.struct(F.col("query_id").alias("a"), F.lit(None).cast("int").alias("b")).alias("query_id"), "term", "qtf")
    assert key(S.top_k(S.cell_scores(keyed, named, *args, cell_rows=cell_rows), k)) == key(S.top_k(S.scores(keyed, named), k))


def test_many_queries_are_scored_without_a_shuffle_of_pairs(random_postings, monkeypatch):
    """More joined rows than postings: cells give k rows a query and block, the join is not made."""
    postings, terms = random_postings
    monkeypatch.setattr(S, "SMALL_JOIN_ROWS", 0)
    many = terms.crossJoin(terms.sparkSession.range(8)).select(
        (F.col("query_id") * 8 + F.col("id")).alias("query_id"), "term", "qtf")
    got = S.top_scores(many, postings, 5)
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    key = lambda df: sorted((r.query_id, r["rank"], r.id, round(r.score, 9)) for r in df.collect())
    assert key(S.top_k(got, 5)) == key(S.top_k(S.scores(many, postings), 5))


def test_one_text_does_not_read_the_song_table_in_one_task(spark):
    """Songs are joined in their own partitions; only the k rows come together."""
    postings = spark.createDataFrame([(i, "sun", 1.0 + i % 7) for i in range(100)], "id long, term string, w double")
    songs = spark.range(0, 100, 1, 6).select("id", F.concat(F.lit("n"), "id").alias("name"))
    df = S.recommend_one("sun sun", postings, songs, 15)
    assert "Repartition 1, false" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert [(r["rank"], r.id, r.name) for r in df.collect()][:3] == [(1, 6, "n6"), (2, 13, "n13"), (3, 20, "n20")]


def test_lines_of_other_songs_are_not_split_into_terms(spark):
    """The semi-join with the corpus songs stands below the split, which is one pass over a line."""
    posts = spark.createDataFrame([(1, "sun!!moon 7 star"), (2, "rain, rain")], "id long, tweet_line string")
    verses = spark.createDataFrame([(1, "moon"), (3, "storm")], "id long, lyric_line string")
    df = M.corpus_terms(posts, verses)
    assert sorted(map(tuple, df.collect())) == [(1, "moon", 2), (1, "star", 1), (1, "sun", 1)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert 0 <= plan.index("Generate explode") < plan.index("LeftSemi") and "regexp_replace" not in plan


def test_words_in_one_pass_equal_the_steps(spark):
    rows = [(s,) for s in ("", " ", "!a  b!", "A.B\tc\n7d\\e", "é😀 x", "--", None)]
    df = spark.createDataFrame(rows, "s string")
    steps = F.array_remove(T.split_spaces(T.normalize("s")), "")
    assert df.where(~T.words("s").eqNullSafe(steps)).count() == 0
    assert df.select(T.words("s").alias("w")).collect()[3].w == ["a", "b", "c", "d\\e"]


def test_a_song_name_splits_its_first_words_only(spark, sf):
    from textrec.sources import fixtures as FX
    assert "split(text#" in (plan := FX.songs(spark, sf)._jdf.queryExecution().optimizedPlan().toString()) and ",  , 4)" in plan
