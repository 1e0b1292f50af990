"""W1 over two file drops equals batch K4 over both; a re-run adds nothing."""

import re

from pyspark.sql import functions as F

from textrec import schemas as SC
from textrec.operators import collect as CO
from textrec.operators import ingest as IN
from textrec.session import scratch_path
from textrec.sources import fixtures as FX
from textrec.sources import sinks as SK
from textrec.sources.store import Store
from textrec.streaming import intake as WS


def test_stream_equals_batch(spark, sf):
    flat = CO.flatten_status(FX.raw_statuses(spark, sf))
    songs = FX.attach_songs(spark, sf)
    # posts already stored: the first 100 events (the fixture's 1000 would cover all of sf0.001)
    early = flat.where(F.col("seq") < 100)
    root = scratch_path(spark, "test-stream")
    landing, ckpt = root + "/landing", root + "/_ckpt"
    store = Store(spark, root + "/store", buckets=8)
    store.commit(append={"posts": SC.conform(early.withColumn("song_id", F.lit(None)), SC.STORED_POSTS)}, cluster={"posts": "tweet_id"})
    posts = lambda: Store(spark, store.root).read("posts", SC.STORED_POSTS).where("song_id IS NOT NULL")
    SK.write_json(flat.where(F.col("seq") % 4 < 2), landing)
    WS.run_intake(spark, landing, store.root, ckpt, songs, SC.POSTS)
    n1 = posts().count()
    SK.write_json(flat.where(F.col("seq") % 4 >= 2), landing, mode="append")
    WS.run_intake(spark, landing, store.root, ckpt, songs, SC.POSTS)
    version = Store(spark, store.root).version
    WS.run_intake(spark, landing, store.root, ckpt, songs, SC.POSTS)   # nothing new
    assert Store(spark, store.root).version == version
    got = posts().select("tweet_id", "song", "seq")
    exp = IN.attach_posts(flat, songs, early.select("tweet_id")).select("tweet_id", "song", "seq")
    assert 0 < n1 < got.count()
    assert got.count() == exp.count()
    assert got.exceptAll(exp).count() == 0


def test_a_batch_reads_the_folders_of_its_own_ids(spark, sf):
    flat = CO.flatten_status(FX.raw_statuses(spark, sf))
    songs = FX.attach_songs(spark, sf)
    store = Store(spark, scratch_path(spark, "test-probe"), buckets=64)
    first, new = WS.new_posts(store, flat.where(F.col("seq") % 2 == 0), songs)
    store.commit(append={"posts": new}, cluster={"posts": "tweet_id"})
    drop = flat.where(F.col("seq").isin(101, 103))
    first, new = WS.new_posts(store, drop, songs)
    plan = new._jdf.queryExecution().executedPlan().toString()
    found = re.search(r"PartitionFilters: \[(?:isnotnull\(bucket#\d+\), )?\(?bucket#\d+ (?:IN \(([\d,]+)\)|= (\d+))", plan)
    assert found and len((found[1] or found[2]).split(",")) <= 2
    assert new.count() == 0
