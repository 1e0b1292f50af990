"""Plan checks: no Python in the hot path, pushdown, bounded top-k."""

from textrec.operators import score as S
from textrec.plans import catalog
from textrec.session import scratch_path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_in_the_hot_path(spark, sf):
    for name in ("recommend_batch", "target_rank", "posts_clean", "attach_posts", "select_posts", "tfidf_hashed",
                 "recommend_stemmed", "stem_vocab", "lyric_lines", "document_lines"):
        p = plan(catalog.QUERIES[name](spark, sf))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_top_k_is_window_group_limit(spark, sf):
    df = catalog.q_recommend_batch(spark, sf)
    df._jdf.queryExecution().executedPlan()
    opt = df._jdf.queryExecution().optimizedPlan().toString()
    assert "WindowGroupLimit" in opt


def test_postings_scan_pushes_filter(spark, sf):
    m = catalog.build_model(spark, sf)
    root = scratch_path(spark, "test-plan")
    m.postings.write.parquet(root)
    post = spark.read.parquet(root)
    songs = spark.createDataFrame([(0, "x")], "id long, name string")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    p = plan(S.recommend_one(catalog.SMOKE_TEXT, post, songs))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "Not(EqualTo(w,0.0))" in p and "EqualTo(term,beautiful)" in p
    assert "ReadSchema: struct<term:string,id:bigint,w:double>" in p


def test_select_posts_cap_is_window_group_limit(spark, sf):
    df = catalog.q_select_posts(spark, sf)
    assert "WindowGroupLimit" in df._jdf.queryExecution().optimizedPlan().toString()


def test_no_exchange_by_kind_or_folder_alone(spark, sf):
    """Neither the two kinds of line nor a term's postings are one task's work."""
    import re

    import textrec.operators.clean as C
    import textrec.plans.build as B
    from textrec.sources import fixtures as FX
    seen = []
    import textrec.session as session
    keep = session.materialize

    def spy(df, name, *args, **kwargs):
        seen.append((name, plan(df)))
        return keep(df, name, *args, **kwargs)

    session.materialize, B.materialize = spy, spy
    try:
        B.build_model(spark, sf)
        C.clean_lines(FX.table(spark, sf, "documents"))
    finally:
        session.materialize, B.materialize = keep, keep
    assert {"lines-kept", "postings"} <= {n for n, _ in seen}
    for _, p in seen:
        assert not re.search(r"hashpartitioning\((kind|tb)#\d+L?, \d+\)", p)
    postings = dict(seen)["postings"]
    assert re.search(r"rangepartitioning\(term#\d+ ASC NULLS FIRST, id#", postings)
