"""Collection: new-song intake, the day plan, search strings and the choice
of posts per search (S10-S12, F1-F4, A8-A10, G4, G5, U1, U2, T14-T21, M12-M15).

The remote services of the reference are replaced by landed records: playlist
items, audio features and search results are tables, and every per-item loop
becomes a join or an aggregate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textrec.functions import text as T
from textrec.operators.positions import positional_slice

FEATURES = ("danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness",
            "instrumentalness", "liveness", "valence", "tempo", "type", "duration_ms", "time_signature")
MIN_POPULARITY = 60
EPOCH = 7
SEARCH_CAP = 5000


def flatten_playlists(playlists: DataFrame, col: str = "playlist") -> DataFrame:
    """S10 + T14: one row per track item with its position in the batch."""
    items = (playlists.select("*", F.posexplode_outer(f"{col}.tracks.items").alias("_apos", "_item"))
                      .where(F.col("_item").isNotNull()))
    return items.select(
        "playlist_pos", "item_pos", "_apos",
        F.col("_item.track.name").alias("name"),
        F.col("_item.track.id").alias("id"),
        F.col("_item.track.popularity").alias("popularity"),
        T.join_names("_item.track.artists").alias("artist"))


#: Digits of a packed order (Spark's widest decimal).
ORDER_DIGITS = 38


def order_number(cols) -> Column:
    """Non-negative whole numbers as one decimal that sorts like them, each with
    an equal share of the digits (19, 19 and 12 for one, two and three); null
    comes first."""
    share = min(19, ORDER_DIGITS // len(cols))
    text = F.concat(*[F.lpad(F.coalesce(F.col(c).cast("bigint"), F.lit(0)).cast("string"), share, "0") for c in cols])
    return text.cast(f"decimal({ORDER_DIGITS},0)")


def first_per_key(df: DataFrame, key, order_cols) -> DataFrame:
    """A10 / K1 / K4: the first row per key in the given order of whole numbers.

    The least order of each key is a hash aggregate over one fixed-width number
    (combined map-side, so a hot key is never gathered in one task); whole rows
    only meet it in a semi-join.  Rows alike in key and order have to be copies
    of each other, of which one stays."""
    keys = [key] if isinstance(key, str) else list(key)
    rows = df.withColumn("_order", order_number(list(order_cols)))
    least = rows.groupBy(*keys).agg(F.min("_order").alias("_order"))
    return rows.join(least, [*keys, "_order"], "left_semi").drop("_order").distinct()


def run_day(run_date=None):
    """The run date as a date column; today (``current_date()``) when not given."""
    if run_date is None:
        return F.current_date()
    return run_date if hasattr(run_date, "_jc") else F.lit(str(run_date)).cast("date")


def intake(tracks: DataFrame, audio: DataFrame, known_names: DataFrame, run_date=None,
           min_popularity: int = MIN_POPULARITY, features=FEATURES) -> DataFrame:
    """F1 -> F2/J4 -> A10 -> S11; the rows appended to the song list today."""
    passing = tracks.where(F.col("popularity").cast("int") >= min_popularity)
    new = passing.join(known_names.select("name"), "name", "left_anti")
    first = first_per_key(new.select("name", "id", "artist", "popularity", "playlist_pos", "item_pos", "_apos"),
                          "name", ["playlist_pos", "item_pos", "_apos"])
    run = run_day(run_date)
    with_feat = first.join(audio.select("id", *features), "id", "left")
    return with_feat.select("name", "id", "artist", "popularity", F.dayofyear(run).alias("add_day"),
                            run.alias("add_date"), *features)


def day_plan(songs: DataFrame, new_songs: DataFrame | None, run_date=None, epoch: int = EPOCH,
             order_cols=("add_date", "id")) -> DataFrame:
    """The slice of the song list for this day plus today's new songs.

    first day (A8), day offset in real dates (T24, D9), step = rows of the
    first day // epoch (A9); rows [i*step, (i+1)*step) of the list in its
    ingest order (G4); new songs are appended with duplicates kept (U2)."""
    first_day = songs.select(F.min("add_date")).scalar()
    n_first = songs.where(F.col("add_date") == songs.select(F.min("add_date")).scalar()).select(F.count("*")).scalar()
    run = run_day(run_date)
    i = F.datediff(run, first_day)
    step = F.floor(n_first / F.lit(epoch))
    sliced = positional_slice(songs, list(order_cols), i * step, (i + 1) * step, name="pos")
    plan = sliced.select("name", "artist", F.lit("slice").alias("source"))
    if new_songs is not None:
        plan = plan.unionByName(new_songs.select("name", "artist", F.lit("new").alias("source")))
    return plan


def search_plan(plan: DataFrame, stop_words=T.STOP_WORDS) -> DataFrame:
    """M15 head: T16 title trim, then T15 search string."""
    q = T.trim_title("name")
    return plan.select("*", q.alias("song_q"), T.search_string(q, F.col("artist"), stop_words).alias("query"))


def flatten_status(raw: DataFrame, col: str = "status") -> DataFrame:
    """S12 + T17-T19: a search result object to the 13 post fields."""
    s = col
    coords = F.col(f"{s}.coordinates.coordinates")
    return raw.select(
        *[c for c in raw.columns if c != col],
        F.col(f"{s}.id").cast("string").alias("tweet_id"),
        F.col(f"{s}.created_at").alias("created"),
        F.col(f"{s}.retweet_count").alias("retweeted"),
        F.col(f"{s}.full_text").alias("content"),
        F.transform(f"{s}.entities.hashtags", lambda h: h["text"]).alias("hashtags"),
        F.col(f"{s}.entities.urls").alias("urls"),
        F.col(f"{s}.user.id").cast("string").alias("user_id"),
        F.col(f"{s}.user.screen_name").alias("username"),
        F.col(f"{s}.user.location").alias("location"),
        F.col(f"{s}.user.followers_count").alias("num_followers"),
        F.col(f"{s}.user.geo_enabled").alias("geo_enabled"),
        F.try_element_at(coords, F.lit(1)).alias("long"),
        F.try_element_at(coords, F.lit(2)).alias("lat"),
        F.col(f"{s}.lang").alias("lang"),
    )


def select_posts(posts: DataFrame, end_date, lang: str = "en", cap: int | None = SEARCH_CAP,
                 song_col: str = "song", order_cols=("created", "seq")) -> DataFrame:
    """F4 (language, created before end date) -> G5 (newest ``cap`` per
    search; planned as a window group limit, so each map task keeps at most
    ``cap`` rows per song before the shuffle; None takes all) -> F3 (not
    retweeted, D17)."""
    from pyspark.sql import Window
    # the end date takes the column's own type, so no session time zone enters
    end = F.lit(str(end_date)).cast(posts.schema["created"].dataType)
    cand = posts.where((F.col("lang") == lang) & (F.col("created") < end))
    if cap is None:
        return cand.where(F.col("retweeted") == 0)
    w = Window.partitionBy(song_col).orderBy(*[F.col(c).desc() for c in order_cols])
    capped = cand.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap).drop("_rn")
    return capped.where(F.col("retweeted") == 0)
