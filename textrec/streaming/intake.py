"""Incremental post intake with Structured Streaming.

New landed post files are picked up by a file stream; each micro-batch runs
the batch attach step (K4) against the store's posts and commits what is new.
Dedupe looks at all history (a watermark would change results), so state lives in
the store, clustered by ``tweet_id``: a micro-batch reads the folders of its own
ids only.  The commit keeps the stream's last batch, and a replayed micro-batch
finds itself there.  ``trigger(availableNow=True)`` processes everything landed
so far and stops, which is what a daily scheduler needs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from textrec import schemas as SC
from textrec.operators import ingest as IN
from textrec.schemas import TS_OPTIONS
from textrec.session import discard, materialize
from textrec.sources.store import Store


def new_posts(store: Store, batch: DataFrame, songs: DataFrame, seq_col: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(the batch's first posts, those of them that aren't stored)."""
    first = materialize(SC.conform(IN.attach_posts(batch, songs, seq_col=seq_col), SC.STORED_POSTS), "batch-posts")
    stored = store.probe("posts", SC.STORED_POSTS, first, "tweet_id")
    return first, first.join(stored.select("tweet_id"), "tweet_id", "left_anti").select(*SC.STORED_POSTS.names)


def attach_writer(songs: DataFrame, store_root: str, seq_col: str = "seq"):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId") or "stream"
        store = Store(spark, store_root)
        if store.manifest.get("marks", {}).get(stream, -1) >= batch_id:
            return
        first, new = new_posts(store, batch, songs, seq_col)
        store.commit(append={"posts": new}, cluster={"posts": "tweet_id"}, mark={stream: batch_id})
        discard(first)
    return write


def run_intake(spark: SparkSession, landing: str, store_root: str, checkpoint: str, songs: DataFrame,
               schema: StructType, fmt: str = "json", max_files_per_trigger: int | None = None) -> None:
    """Process every file landed so far, then stop."""
    reader = spark.readStream.schema(schema).format(fmt).options(**TS_OPTIONS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.load(landing)
    q = (stream.writeStream
               .foreachBatch(attach_writer(songs, store_root))
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True)
               .start())
    q.awaitTermination()
