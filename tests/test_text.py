"""Golden rows for the text functions (FIXTURES.md section 4)."""

from pyspark.sql import functions as F

from textrec.functions import text as T


def one(spark, expr, value, schema="s string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).collect()[0]["r"]


def test_stop_words_fixed_list():
    assert len(T.STOP_WORDS) == 179
    assert len(set(T.STOP_WORDS)) == 179


def test_strip_emoji(spark):
    assert one(spark, T.strip_emoji("s"), "hi 😀 été 中文") == "hi  été "


def test_strip_symbols_keeps_backslash(spark):
    assert one(spark, T.strip_symbols("s"), "a\\b]c[d-e^f&g&&h~1_x") == "a\\b c d e f g  h   x"


def test_tokens(spark):
    assert one(spark, T.tokens("s"), "Don't STOP 24/7 & go_home!") == ["stop", "home"]


def test_words(spark):
    assert one(spark, T.words("s"), "a  b-1") == ["a", "b"]


def test_word_counts(spark):
    assert one(spark, T.word_count("s"), "la la la") == 3
    assert one(spark, T.distinct_word_count("s"), "la la la") == 1
    assert one(spark, T.distinct_word_count("s"), "la lo") == 2


def test_remove_words(spark):
    df = spark.createDataFrame([("xabbz", ["ab", "b"])], "t string, w array<string>")
    assert df.select(T.remove_words("t", "w").alias("r")).collect()[0]["r"] == "xz"


def test_repeat_factor(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (3,), (14,), (15,), (40,)], "n int")
    got = [r.f for r in df.select(T.repeat_factor("n").alias("f")).collect()]
    assert got == [1, 25, 25, 5, 5, 1, 1]
    arr = spark.createDataFrame([(["a", "b"],)], "t array<string>")
    assert len(arr.select(T.repeat_tokens("t").alias("r")).collect()[0]["r"]) == 50


def test_search_string(spark):
    df = spark.createDataFrame([("S", "SZA"), ("S", "The Weeknd"), ("S", "Metro Boomin,The Weeknd")],
                               "song string, artist string")
    got = [r.q for r in df.select(T.search_string("song", "artist").alias("q")).collect()]
    assert got == ['("S" AND "SZA")', '("S" AND "The Weeknd")',
                   '("S" AND "Metro") OR ("S" AND "The Weeknd")']


def test_trim_title(spark):
    rows = [("Flowers (feat. X)",), ("Jay-Z",), ("(Intro) x - y",), ("A-b",), ("-x",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r.t for r in df.select(T.trim_title("s").alias("t")).collect()]
    assert got == ["Flowers", "Ja", "(Intro) x", "", "-x"]


def test_ad_markers(spark):
    df = spark.createDataFrame([("my camp song",), ("plain words",)], "s string")
    got = [r.m for r in df.select(T.has_ad_marker("s").alias("m")).collect()]
    assert got == [True, False]


def test_space_count(spark):
    df = spark.createDataFrame([("a b c",), ("a b c d",)], "s string")
    got = [r.n > 2 for r in df.select(T.space_count("s").alias("n")).collect()]
    assert got == [False, True]


def test_song_from_path(spark):
    assert one(spark, T.song_from_path("s"), "2023-03-21/Flowers.csv") == "Flowers"


def test_join_names(spark):
    df = spark.createDataFrame([([("A",), ("B C",)],)], "a array<struct<name:string>>")
    assert df.select(T.join_names("a").alias("r")).collect()[0]["r"] == "A,B C"
