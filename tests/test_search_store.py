"""Search strings against plain Python, the store's commits, landed layout."""

import random
import re

import pytest
from pyspark.sql import functions as F

from textrec import schemas as SC
from textrec.functions import text as T
from textrec.operators import collect as CO
from textrec.operators import ingest as IN
from textrec.operators.search import search
from textrec.plans import catalog, daily
from textrec.session import scratch_path
from textrec.sources import fixtures as FX
from textrec.sources import readers as RD
from textrec.sources import sinks as SK
from textrec.sources.store import BUCKET, Conflict, Store, bucket_of


def words(text):
    return re.findall(r"[^\W_]+", text.lower())


def has(post, phrase):
    return any(post[i:i + len(phrase)] == phrase for i in range(len(post) - len(phrase) + 1))


def matches(content, query):
    post = words(content or "")
    for clause in query[2:-2].split('") OR ("'):
        phrases = [p for p in map(words, clause.split('" AND "')) if p]
        if phrases and all(has(post, p) for p in phrases):
            return True
    return False


def test_search_equals_plain_python(spark):
    rnd = random.Random(7)
    vocabulary = ["the", "the", "the", "moon", "sun", "river", "Weeknd", "22", "élan", "o'clock"]
    some = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(rnd.randint(1, n)))
    posts = [(i, rnd.choice(["{}!", "({})", "{} — x", '"{}"']).format(some(9))) for i in range(300)] + [(300, None), (301, "")]
    songs = [(i, some(2), ",".join(some(2) for _ in range(rnd.randint(1, 3)))) for i in range(40)]
    songs += [(40, "???", "moon"), (41, "...", "!!"), (42, "The", "The"), (43, "never heard", "nobody")]
    plan = spark.createDataFrame(songs, "song int, name string, artist string")
    asked = plan.select("song", T.search_string(F.col("name"), F.col("artist")).alias("query"))
    queries = {r.song: r["query"] for r in asked.collect()}
    got = {(r.song, r.seq) for r in search(spark.createDataFrame(posts, "seq long, content string"), asked, "seq").collect()}
    assert got == {(s, i) for s, q in queries.items() for i, c in posts if matches(c, q)}
    assert {s for s, _ in got} >= {40, 42} and not {41, 43} & {s for s, _ in got}
    assert search(spark.createDataFrame([], "seq long, content string"), asked, "seq").count() == 0


def test_commit_shows_all_or_nothing(spark):
    root = scratch_path(spark, "store")
    a, b = spark.range(10).withColumn("k", F.col("id").cast("string")), spark.range(3)
    store, other = Store(spark, root), Store(spark, root)
    assert store.read("a", a.schema).count() == 0
    assert store.commit(append={"a": a, "b": b}, cluster={"a": "k"}) == 1
    with pytest.raises(Conflict):
        other.commit(append={"a": a})
    bad = b.select(F.raise_error(F.lit("stop")).alias("id"))
    with pytest.raises(Exception, match="stop"):
        store.commit(append={"a": a, "b": bad})
    again = Store(spark, root)
    assert again.version == 1 and again.read("a", a.schema).count() == 10 and again.read("b", b.schema).count() == 3
    again.commit(append={"a": a}, replace={"b": b.limit(1)}, cluster={"a": "k"})
    last = Store(spark, root)
    assert (last.read("a", a.schema).count(), last.read("b", b.schema).count(), last.buckets) == (20, 1, store.buckets)


def test_probe_reads_touched_folders_only(spark):
    store = Store(spark, scratch_path(spark, "store"), buckets=32)
    rows = spark.range(500).select(F.col("id").cast("string").alias("tweet_id"), F.lit("x").alias("more"))
    store.commit(append={"posts": rows}, cluster={"posts": "tweet_id"})
    batch = spark.createDataFrame([("3",), ("77",), ("none",)], "tweet_id string")
    found = store.probe("posts", rows.schema, batch, "tweet_id")
    touched = sorted({r.b for r in batch.select(bucket_of(F.col("tweet_id"), 32).alias("b")).collect()})
    plan = found._jdf.queryExecution().executedPlan().toString()
    numbers = re.search(r"PartitionFilters: \[(?:isnotnull\(bucket#\d+\), )?bucket#\d+ IN \(([\d,]+)\)", plan).group(1)
    assert sorted(map(int, numbers.split(","))) == touched and len(touched) <= 3
    assert "ReadSchema: struct<tweet_id:string,more:string>" in plan and BUCKET not in found.columns
    assert found.join(batch, "tweet_id").count() == 2 and 2 <= found.count() < 200


def test_batch_into_a_store_repeats_and_fails_cleanly(spark, monkeypatch):
    root = scratch_path(spark, "ingest")
    post = lambda song, seq, tweet: (song, seq, tweet, None, 0, f"text\nof {tweet}", ["h"], [("u",)], "1", "n", None, 1, True, None, None, "en")
    store = Store(spark, root + "/store", buckets=4)
    store.commit(append={"songs": spark.createDataFrame([("1", "A", "x")], SC.STORED_SONGS),
                         "posts": spark.createDataFrame([(*post("A", 1, "t1"), "1")], SC.STORED_POSTS)}, cluster={"posts": "tweet_id"})
    SK.write_csv(spark.createDataFrame([("1", "A", "x"), ("2", "B", "y")], SC.STORED_SONGS_CSV), root + "/songs")
    SK.write_csv(spark.createDataFrame([post("A", 1, "t1"), post("A", 2, "t2"), post("B", 3, "t2"), post("B", 4, "t3"),
                                        post("C", 5, "t4")], SC.POSTS), root + "/posts")

    def stored():
        now = Store(spark, root + "/store")
        return now.version, sorted((r.tweet_id, r.song_id, r.content) for r in now.read("posts", SC.STORED_POSTS).collect()), \
            sorted(r._id for r in now.read("songs", SC.STORED_SONGS).collect())

    before = stored()
    with monkeypatch.context() as m:
        m.setattr(Store, "_swap", lambda self, manifest: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError, match="lost"):
            daily.ingest_batch(spark, Store(spark, root + "/store"), root + "/songs", root + "/posts")
    assert stored() == before
    daily.ingest_batch(spark, Store(spark, root + "/store"), root + "/songs", root + "/posts")
    after = stored()
    assert after[1:] == ([("t1", "1", "text\nof t1"), ("t2", "1", "text\nof t2"), ("t3", "2", "text\nof t3")], ["1", "2"])
    daily.ingest_batch(spark, Store(spark, root + "/store"), root + "/songs", root + "/posts")
    assert stored()[1:] == after[1:]


def test_landed_files_follow_bytes_not_songs(spark):
    root = scratch_path(spark, "landed")
    rows = [(f"song {i % 97} é/%", i, f"t{i}", None, 0, f'line one\n"line" two {i}', [], [], "1", "n", None, 1, True, None, None, "en")
            for i in range(1000)]
    df = spark.createDataFrame(rows, SC.POSTS).repartition(7)
    SK.write_landed(df, root, "2024-02-24")
    SK.write_landed(df.limit(10), root, "2024-02-25")
    index = RD.landed_songs(spark, root, "2024-02-24")
    assert index.select("file").distinct().count() <= 8 and index.select("song").distinct().count() == 97
    back = daily.read_posts(spark, root, "2024-02-24")
    assert sorted((r.seq, r.song, r.content) for r in back.collect()) == sorted((r[1], r[0], r[5]) for r in rows)
    assert {str(r.date) for r in back.select("date").distinct().collect()} == {"2024-02-24"}
    one = daily.read_posts(spark, root, "2024-02-24", [rows[5][0]])
    assert sorted(r.seq for r in one.collect()) == [i for i in range(1000) if i % 97 == 5]
    assert one.select("file").distinct().count() <= index.where(F.col("song") == rows[5][0]).count()
    assert daily.read_posts(spark, root, songs=["nobody"]).count() == 0
    assert daily.read_posts(spark, root).count() == 1010


def test_first_per_key_is_a_hash_aggregate(spark, sf):
    for df in (catalog.q_attach_posts(spark, sf), catalog.q_song_intake(spark, sf), catalog.q_insert_if_absent(spark, sf)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_first_per_key_order(spark):
    rows = [("a", 2, 10**18, "late"), ("a", 2, 3, "first"), ("a", 2, 3, "first"), ("a", 11, 0, "no"), ("b", None, 5, "null first"), ("b", 0, 6, "no")]
    df = spark.createDataFrame(rows, "k string, x long, y long, v string")
    assert sorted((r.k, r.v) for r in CO.first_per_key(df, "k", ["x", "y"]).collect()) == [("a", "first"), ("b", "null first")]


def test_daily_job_uses_the_string(spark, sf):
    root = scratch_path(spark, "daily")
    store = Store(spark, root + "/store")
    tracks = catalog._tracks(spark, sf)
    got = daily.daily_job(spark, store, tracks, FX.audio_features(spark, sf), FX.landed_statuses(spark, sf),
                          catalog.RUN_DATE, "2025-01-01", root + "/landed", None).collect()
    queries = {r.name: r["query"] for r in CO.search_plan(store.read("whole", SC.SONGS)).collect()}
    assert got and all(matches(r.content, queries[r.song]) for r in got)
    assert not any("nobody" in r.content for r in got)
