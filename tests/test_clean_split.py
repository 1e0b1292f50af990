"""Cleaning filters, split properties and skew-safe positions."""

import pandas as pd
from pyspark.sql import functions as F

from textrec.operators import clean as C
from textrec.operators import split as SP
from textrec.operators.positions import positional_slice, with_group_position
from textrec.sources import fixtures as FX


def test_clean_posts_thresholds(spark):
    ten = " ".join(f"w{i}" for i in range(10))        # 10 words -> dropped (F8)
    rows = [(1, f"{ten} extra{j}") for j in range(11)]  # 11 posts of 11 words
    rows += [(1, f"{ten} extra0")]                      # duplicate (A3)
    rows += [(1, f"my camp song {ten}")]                # marker (F9)
    rows += [(2, ten), (2, f"{ten} one")]               # song 2 has 1 post left (F10)
    df = spark.createDataFrame(rows, "id long, tweet_line string")
    out = C.clean_posts(df)
    assert out.count() == 11
    assert {r.id for r in out.select("id").distinct().collect()} == {1}


def test_clean_verses(spark):
    df = spark.createDataFrame([(1, "la la la"), (1, "la lo"), (1, "la lo")], "id long, lyric_line string")
    assert [r.lyric_line for r in C.clean_verses(df).collect()] == ["la lo"]


def test_test_rows(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a b"), (1, None), (1, "  ")], "id long, tweet_line string")
    assert [r.tweet_line for r in C.test_rows(df).collect()] == ["a b"]


def test_split_hash_disjoint_and_complete(spark, sf):
    pc = FX.posts(spark, sf).dropDuplicates()
    test, train = SP.split_hash(pc, 0.1)
    n, a, b = pc.count(), test.count(), train.count()
    assert a + b == n
    assert test.join(train, ["id", "tweet_line"]).count() == 0
    assert 0.05 * n < a < 0.15 * n


def test_split_exact_counts(spark, sf):
    pc = FX.posts(spark, sf).dropDuplicates()
    lab = SP.split_exact(pc, 0.1)
    per = lab.groupBy("id").agg(F.count("*").alias("n"),
                                F.sum((F.col("part") == "test").cast("int")).alias("t")).toPandas()
    import math
    assert (per.t == per.n.map(lambda n: math.ceil(round(0.1 * n, 9)))).all()
    assert ((per.n < 2) | ((per.t >= 1) & (per.t < per.n))).all()


def test_split_exact_uses_decimal_fraction(spark):
    rows = [(1, f"line {i}") for i in range(30)]
    lab = SP.split_exact(spark.createDataFrame(rows, "id long, tweet_line string"), 0.1)
    assert lab.where("part = 'test'").count() == 3


def test_group_position_matches_brute_force_with_hot_group(spark):
    # one group holds most rows: it must be spread over partitions and still numbered 0..n-1
    rows = [(0, i) for i in range(3000)] + [(g, i) for g in range(1, 40) for i in range(g)]
    df = spark.createDataFrame(rows, "g int, v int").repartition(7)
    got = with_group_position(df, ["g"], ["v"], name="pos", count_name="n", num_partitions=8).toPandas()
    exp = pd.DataFrame(rows, columns=["g", "v"])
    exp["pos"] = exp.groupby("g")["v"].rank(method="first").astype(int) - 1
    m = got.merge(exp, on=["g", "v"], suffixes=("", "_exp"))
    assert len(m) == len(rows)
    assert (m.pos == m.pos_exp).all()
    assert (m.n == m.groupby("g")["v"].transform("count")).all()


def test_positional_slice_day_plan_golden(spark):
    df = spark.createDataFrame([(i,) for i in range(70)], "k int")
    got = sorted(r.k for r in positional_slice(df, ["k"], 20, 30).collect())
    assert got == list(range(20, 30))


def test_one_scan_cleaning_equals_separate_cleanings(spark, sf):
    posts, verses = C.clean_lines(FX.table(spark, sf, "documents"))
    exp_p = C.clean_posts(FX.posts(spark, sf)).select("id", "tweet_line", "word_count")
    exp_v = C.clean_verses(FX.verses(spark, sf)).select("id", "lyric_line")
    assert posts.exceptAll(exp_p).count() == 0 and exp_p.exceptAll(posts).count() == 0
    assert verses.exceptAll(exp_v).count() == 0 and exp_v.exceptAll(verses).count() == 0
