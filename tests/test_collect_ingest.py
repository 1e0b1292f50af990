"""Collection and consolidation golden rows (FIXTURES.md section 4)."""

import datetime as dt

from pyspark.sql import functions as F

from textrec.operators import collect as CO
from textrec.operators import ingest as IN


def test_day_plan_golden(spark):
    d0 = dt.date(2024, 2, 23)
    rows = [(i, f"s{i}", "a", d0) for i in range(70)] + [(100, "new", "b", d0 + dt.timedelta(days=2))]
    songs = spark.createDataFrame(rows, "id long, name string, artist string, add_date date")
    new = songs.where(F.col("add_date") == F.lit("2024-02-25").cast("date"))
    plan = CO.day_plan(songs, new, "2024-02-25").collect()
    sliced = sorted(int(r.name[1:]) for r in plan if r.source == "slice")
    assert sliced == list(range(20, 30))
    assert [r.name for r in plan if r.source == "new"] == ["new"]


def test_intake_first_passing_name_wins(spark):
    tracks = spark.createDataFrame(
        [(0, 0, 0, "X", "1", 50, "a"), (0, 1, 0, "X", "2", 70, "b"), (0, 2, 0, "Y", "3", 90, "c"),
         (1, 0, 0, "Z", "4", 80, "d")],
        "playlist_pos long, item_pos long, _apos int, name string, id string, popularity int, artist string")
    audio = spark.createDataFrame([(str(i), *[0.0] * 11, "t", 1, 4) for i in range(1, 5)],
                                  "id string, " + ", ".join(f"f{i} double" for i in range(11))
                                  + ", type string, duration_ms int, time_signature int")
    audio = audio.toDF("id", *CO.FEATURES)
    known = spark.createDataFrame([("Z",)], "name string")
    out = {r.name: r.id for r in CO.intake(tracks, audio, known, "2024-02-24").collect()}
    assert out == {"X": "2", "Y": "3"}


def posts(spark, rows):
    return spark.createDataFrame(rows, "song string, seq long, tweet_id string, retweeted int")


def test_attach_first_song_only(spark):
    songs = spark.createDataFrame([(1, "A"), (2, "B")], "id long, name string")
    p = posts(spark, [("A", 1, "t1", 0), ("B", 2, "t1", 0), ("B", 3, "t2", 0)])
    got = {(r.tweet_id, r.song) for r in IN.attach_posts(p, songs).collect()}
    assert got == {("t1", "A"), ("t2", "B")}


def test_attach_unknown_song_does_not_block(spark):
    songs = spark.createDataFrame([(2, "B")], "id long, name string")
    p = posts(spark, [("A", 1, "t1", 0), ("B", 2, "t1", 0)])
    got = [(r.tweet_id, r.song) for r in IN.attach_posts(p, songs).collect()]
    assert got == [("t1", "B")]
    rej = [r.song for r in IN.rejected_posts(p, songs).collect()]
    assert rej == ["A"]


def test_attach_twice_equals_once(spark):
    songs = spark.createDataFrame([(1, "A")], "id long, name string")
    p = posts(spark, [("A", 1, "t1", 0), ("A", 2, "t2", 0)])
    first = IN.attach_posts(p, songs)
    again = IN.attach_posts(p, songs, existing_ids=first.select("tweet_id"))
    assert first.count() == 2 and again.count() == 0


def test_insert_if_absent(spark):
    batch = spark.createDataFrame([("1", "y", 2), ("1", "x", 1), ("2", "z", 0)], "id string, name string, row int")
    target = spark.createDataFrame([("2",)], "id string")
    got = [(r._id, r.name) for r in IN.insert_if_absent(batch, target, "id", ["row"]).collect()]
    assert got == [("1", "x")]
    assert IN.insert_if_absent(batch, target).count() == 1


def test_select_posts_cap_before_retweet_filter(spark):
    rows = [("s", i, str(i), f"2024-01-0{i + 1} 00:00:00", 0 if i % 2 else 3, "en") for i in range(5)]
    df = spark.createDataFrame(rows, "song string, seq long, tweet_id string, created string, retweeted int, lang string")
    df = df.withColumn("created", F.col("created").cast("timestamp"))
    got = sorted(r.tweet_id for r in CO.select_posts(df, "2024-01-20", cap=2).collect())
    assert got == ["3"]   # newest two are 4 (retweeted) and 3


def test_fix_names(spark):
    songs = spark.createDataFrame([(1, "NO voy a llorar :')"), (2, "fine")], "id long, name string")
    got = {r.id: r.name for r in IN.fix_names(songs, IN.name_fixes(songs)).collect()}
    assert got == {1: "NO voy a llorar", 2: "fine"}


def test_run_date_defaults_to_today(spark):
    import datetime as _dt
    got = spark.range(1).select(CO.run_day().alias("d")).collect()[0].d
    assert abs((got - _dt.date.today()).days) <= 1
    assert spark.range(1).select(CO.run_day("2024-02-24").alias("d")).collect()[0].d == _dt.date(2024, 2, 24)
