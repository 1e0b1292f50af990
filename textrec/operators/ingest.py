"""Consolidation into the song and post tables.

The document store of the reference becomes two normalised tables, ``songs``
keyed by ``_id`` and ``posts`` keyed by ``tweet_id``; per-row lookups become
anti-joins, so a batch is idempotent: running it twice adds nothing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrec.operators.collect import first_per_key
from textrec.operators.positions import with_group_position


def insert_if_absent(batch: DataFrame, target_keys: DataFrame, key: str = "id",
                     order_cols=None, out_key: str = "_id") -> DataFrame:
    """K1 + K2 + J5: the first row per key of the batch whose key is not in
    the target; the key is renamed to ``_id`` on the way out.

    Without an ingest order (whole numbers) the hash of all columns decides, so
    the choice among rows sharing a key is the same on every run."""
    new = batch.join(target_keys.select(key), key, "left_anti")
    if order_cols is None:
        drawn = F.xxhash64(*new.columns).bitwiseAND(F.lit((1 << 63) - 1))
        first = first_per_key(new.withColumn("_drawn", drawn), key, ["_drawn"]).drop("_drawn")
    else:
        first = first_per_key(new, key, order_cols)
    return first.withColumnRenamed(key, out_key)


def song_per_name(songs: DataFrame, id_col: str = "id") -> DataFrame:
    """The song a name refers to (the first, i.e. smallest id, per name)."""
    return songs.groupBy("name").agg(F.min(id_col).alias("song_id"))


def attach_posts(posts: DataFrame, songs: DataFrame, existing_ids: DataFrame | None = None,
                 dedupe: bool = True, song_col: str = "song", seq_col: str = "seq",
                 id_col: str = "id") -> DataFrame:
    """K4 (dedupe=True) / K5 (dedupe=False).

    In this order: inner join to the song with that name (K6 drops unknown
    names), first occurrence per ``tweet_id`` in file order, then anti-join to
    the stored posts.  A post whose song is unknown stores nothing, so it
    cannot block a later copy under a known song.

    Files are read by song name, and rows in the order of ``seq_col``; names are
    numbered once for each song, so the order of a row is two whole numbers."""
    target = song_per_name(songs, id_col)
    if not dedupe:
        return posts.join(target, posts[song_col] == target["name"], "inner").drop("name")
    numbered = with_group_position(target, [], ["name"], name="_file")
    joined = posts.join(numbered, posts[song_col] == numbered["name"], "inner").drop("name")
    first = first_per_key(joined, "tweet_id", ["_file", seq_col]).drop("_file")
    if existing_ids is not None:
        first = first.join(existing_ids.select("tweet_id"), "tweet_id", "left_anti")
    return first


def rejected_posts(posts: DataFrame, songs: DataFrame, song_col: str = "song") -> DataFrame:
    """K6: posts whose song name is not in the store (no upsert)."""
    return posts.join(songs.select(F.col("name").alias(song_col)).distinct(), song_col, "left_anti")


def fix_names(songs: DataFrame, fixes: DataFrame, id_col: str = "id") -> DataFrame:
    """Apply a (name, new_name) correction table.  As with any update by
    name it reaches the first song of that name (J7) only; of several
    corrections of a name the smallest counts."""
    one = fixes.groupBy("name").agg(F.min("new_name").alias("new_name"))
    named = song_per_name(songs, id_col).join(one, "name").select(F.col("song_id").alias(id_col), "name", "new_name")
    return (songs.join(named, [id_col, "name"], "left")
                 .withColumn("name", F.coalesce("new_name", "name")).drop("new_name").select(*songs.columns))


def name_fixes(songs: DataFrame) -> DataFrame:
    """A correction table derived from the data: trailing symbols removed."""
    new = F.regexp_replace("name", r"[^\p{L}\p{N}]+$", "")
    return (songs.select("name", new.alias("new_name"))
                 .where((F.col("new_name") != F.col("name")) & (F.length("new_name") > 0)).distinct())
