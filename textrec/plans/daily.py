"""End-to-end jobs a scheduler calls."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textrec import schemas as SC
from textrec.operators import collect as CO
from textrec.operators import ingest as IN
from textrec.operators import score as S
from textrec.operators.search import search
from textrec.session import discard, materialize
from textrec.sources import readers as RD
from textrec.sources import sinks as SK
from textrec.sources.split_csv import read_csv_split
from textrec.sources.store import Store


def intake_snapshot(store: Store, tracks: DataFrame, audio: DataFrame, run_date) -> DataFrame:
    """M13 + K7 + K8: today's new songs are appended to the song list (table
    ``whole``) and written on their own (table ``new_<date>``) in one commit; a
    missing list starts empty.

    A run may be repeated, also after a failure before the commit: songs of the
    same day don't count as known, the day's table is written anew, and only
    what the list lacks is appended."""
    whole = store.read("whole", SC.SONGS)
    known = whole.where(~F.col("add_date").eqNullSafe(CO.run_day(run_date)))
    new = CO.intake(tracks, audio, known.select("name"), run_date)
    new = materialize(SC.conform(new, SC.SONGS), "new-songs")
    missing = new.join(whole.select("id"), "id", "left_anti").select(*whole.columns)
    store.commit(append={"whole": missing}, replace={f"new_{run_date}": new})
    discard(new)
    return store.read("whole", SC.SONGS)


def daily_job(spark: SparkSession, store: Store, tracks: DataFrame, audio: DataFrame, statuses: DataFrame, run_date,
              end_date, out_root: str, cap: int | None = CO.SEARCH_CAP) -> DataFrame:
    """today's intake, the plan from the song list it left, the search of each
    planned song over the landed posts (M15) and the day's posts written (K9).

    A song that is planned twice (in the slice and as a new one) is searched
    once, as its second result would replace an equal one."""
    whole = intake_snapshot(store, tracks, audio, run_date)
    new = store.read(f"new_{run_date}", SC.SONGS)
    plan = CO.search_plan(CO.day_plan(whole, new, run_date))
    asked = plan.select(F.col("name").alias("song"), "query").distinct()
    posts = CO.flatten_status(statuses)
    chosen = CO.select_posts(search(posts, asked, "seq").drop("query"), end_date, "en", cap)
    SK.write_landed(chosen.select(*SC.POSTS.names), out_root, run_date)
    return read_posts(spark, out_root, run_date)


def read_posts(spark: SparkSession, root: str, date=None, songs: list[str] | None = None) -> DataFrame:
    """Landed posts with their lists, as ``daily_job`` wrote them."""
    return SK.arrays_from_json(RD.read_landed(spark, root, SC.POSTS_CSV, date, songs), SC.POSTS)


def ingest_batch(spark: SparkSession, store: Store, songs_csv: str, posts_csv: str) -> int:
    """The landed song list, then the landed posts, into the store.

    New songs (K1) and posts of all known songs (K4), earlier ones included, are
    staged and become visible in one commit; a run that fails before it has
    changed nothing, and one that is repeated adds nothing.  Of the stored posts
    only the folders of the batch's own ids are read (J6)."""
    songs = RD.read_csv(spark, songs_csv, SC.STORED_SONGS_CSV)
    stored = store.read("songs", SC.STORED_SONGS)
    new_songs = materialize(IN.insert_if_absent(songs, stored.select(F.col("_id").alias("id")))
                            .select(*SC.STORED_SONGS.names), "batch-songs")
    posts = SK.arrays_from_json(read_csv_split(spark, posts_csv, SC.POSTS_CSV, escape="\\", glob="*.csv"), SC.POSTS)
    known = stored.unionByName(new_songs)
    first = materialize(SC.conform(IN.attach_posts(posts, known, id_col="_id"), SC.STORED_POSTS), "batch-posts")
    old = store.probe("posts", SC.STORED_POSTS, first, "tweet_id")
    new_posts = first.join(old.select("tweet_id"), "tweet_id", "left_anti").select(*SC.STORED_POSTS.names)
    version = store.commit(append={"songs": new_songs, "posts": new_posts}, cluster={"posts": "tweet_id"})
    discard(new_songs, first)
    return version


def recommend_from(spark: SparkSession, model_path: str, queries: DataFrame, k: int = 15) -> DataFrame:
    """M9: load a saved model (S7), that is ``postings``, ``songs``, ``corpus_ids``
    and ``blocks`` below its folder, and recommend for the queries."""
    postings, songs, ids, blocks = (RD.read_parquet(spark, f"{model_path}/{t}")
                                    for t in ("postings", "songs", "corpus_ids", "blocks"))
    return S.recommend(queries, postings, songs, k, corpus_ids=ids, blocks=blocks)
