"""Views over the driver tables that stand in for the reference's inputs
(FIXTURES.md section 3).  Every view is a lazy projection of a parquet scan,
so filters and column pruning still reach the files."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textrec import schemas as SC

FIRST_DAY = _dt.date(2024, 2, 23)
KNOWN_EVERY = 400          # intake: p_partkey % 400 = 0 are already known
ATTACH_SKIP_EVERY = 10     # attach targets: songs with user_id % 10 != 0
EXISTING_POSTS_BELOW = 1000  # existing posts: event_id < 1000
ITEMS_PER_PLAYLIST = 50


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Song list: one row per document."""
    d = table(spark, sf_dir, "documents")
    add_date = F.date_add(F.lit(FIRST_DAY), F.when(F.col("doc_id") % 10 == 9, 1).otherwise(0))
    return d.select(
        F.col("doc_id").alias("id"),
        F.array_join(F.slice(F.split("text", " ", 4), 1, 3), " ").alias("name"),    # the rest of the text stays unsplit
        F.concat_ws(",", "lang", "source").alias("artist"),
        (F.col("doc_id") % 100).cast("int").alias("popularity"),
        add_date.alias("add_date"),
        F.col("n_chars"),
    )


def _lines(spark: SparkSession, sf_dir: str, parity: int, col: str) -> DataFrame:
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return (d.select(F.col("doc_id").alias("id"), F.posexplode_outer(F.split("text", "\n")).alias("pos", col))
             .where(F.col("pos") % 2 == parity)
             .select("id", col))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of each document (id, tweet_line)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    return d.select(F.col("doc_id").alias("id"), F.explode(F.split("text", "\n")).alias("tweet_line"))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Post lines (id, tweet_line): even-numbered lines of each document."""
    return _lines(spark, sf_dir, 0, "tweet_line")


def verses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lyric lines (id, lyric_line): odd-numbered lines of each document."""
    return _lines(spark, sf_dir, 1, "lyric_line")


def playlist_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed playlist records: one JSON-shaped row per track item, with the
    nested ``track`` struct the playlist endpoint returns."""
    p = table(spark, sf_dir, "part")
    track = F.struct(
        F.col("p_name").alias("name"),
        F.col("p_partkey").cast("string").alias("id"),
        (F.col("p_size") * 2).alias("popularity"),
        F.array(F.struct(F.col("p_brand").alias("name")),
                F.struct(F.concat(F.lit("The "), F.col("p_type")).alias("name")),
                F.struct(F.concat_ws(" ", "p_type", "p_name").alias("name"))).alias("artists"),
    )
    return p.select(
        (F.col("p_partkey") / ITEMS_PER_PLAYLIST).cast("long").alias("playlist_pos"),
        (F.col("p_partkey") % ITEMS_PER_PLAYLIST).alias("item_pos"),
        F.struct(F.struct(F.array(F.struct(track.alias("track"))).alias("items")).alias("tracks")).alias("playlist"),
    )


def audio_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed audio-feature records keyed by track id."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size").cast("double")
    price = F.col("p_retailprice")
    return p.select(
        F.col("p_partkey").cast("string").alias("id"),
        (size / 50).alias("danceability"),
        ((F.col("p_partkey") % 7) / 7.0).alias("energy"),
        (F.col("p_partkey") % 12).cast("double").alias("key"),
        (-price / 100).alias("loudness"),
        (F.col("p_partkey") % 2).cast("double").alias("mode"),
        (size / 100).alias("speechiness"),
        ((F.col("p_partkey") % 11) / 11.0).alias("acousticness"),
        ((F.col("p_partkey") % 13) / 13.0).alias("instrumentalness"),
        ((F.col("p_partkey") % 17) / 17.0).alias("liveness"),
        ((F.col("p_partkey") % 19) / 19.0).alias("valence"),
        (price / 10).alias("tempo"),
        F.lit("audio_features").alias("type"),
        (F.col("p_size") * 6000).alias("duration_ms"),
        F.lit(4).alias("time_signature"),
    )


def known_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The song list before today's intake (name, id)."""
    p = table(spark, sf_dir, "part")
    return p.where(F.col("p_partkey") % KNOWN_EVERY == 0).select(
        F.col("p_name").alias("name"), F.col("p_partkey").cast("string").alias("id"))


def raw_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed search results: one nested status object per row, tagged with
    the song whose search returned it."""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    coords = F.when(k % 2 == 0, F.struct(F.array(F.col("value"), k.cast("double")).alias("coordinates")))
    status = F.struct(
        (F.col("event_id") / 2).cast("long").alias("id"),
        F.col("ts").alias("created_at"),
        (k % 3).alias("retweet_count"),
        F.concat_ws(" ", F.col("event_type"), F.col("props")).alias("full_text"),
        F.struct(
            F.array(F.struct(F.col("event_type").alias("text"))).alias("hashtags"),
            F.array(F.struct(F.concat(F.lit("https://t.example/"), F.col("event_id").cast("string")).alias("url"))).alias("urls"),
        ).alias("entities"),
        F.struct(
            F.col("user_id").alias("id"),
            F.concat(F.lit("user"), F.col("user_id").cast("string")).alias("screen_name"),
            F.lit(None).cast("string").alias("location"),
            F.col("value").cast("int").alias("followers_count"),
            (F.col("value") > 50).alias("geo_enabled"),
        ).alias("user"),
        coords.alias("coordinates"),
        F.when(F.col("event_type") == "error", "fr").otherwise("en").alias("lang"),
    )
    return e.select(
        F.concat(F.lit("song"), F.col("user_id").cast("string")).alias("song"),
        F.col("event_id").alias("seq"),
        status.alias("status"),
    )


def landed_statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed posts that no search has chosen yet (seq, status): each of five
    posts about a track names its title and one of its artists, in whole, by the
    first word, or not at all."""
    e, p = table(spark, sf_dir, "events"), table(spark, sf_dir, "part")
    number = F.floor(F.col("event_id") / 5) + 1
    k = F.get_json_object("props", "$.k").cast("int")
    who = (F.when(k % 4 == 0, F.col("p_brand")).when(k % 4 == 1, F.concat(F.lit("the "), "p_type"))
            .when(k % 4 == 2, F.element_at(F.split("p_type", " "), 1)).otherwise("nobody"))
    text = F.concat_ws(" ", "event_type", F.lit("heard:"), "p_name", F.lit("\n- by"), who, F.lit("!"))
    about = e.join(p, number == F.col("p_partkey")).select("event_id", text.alias("full_text"))
    tagged = raw_statuses(spark, sf_dir).select("seq", "status")
    return (tagged.join(about, tagged["seq"] == about["event_id"])
                  .select("seq", F.col("status").withField("full_text", F.col("full_text")).alias("status")))


def stored_tracks(tracks: DataFrame) -> DataFrame:
    """The song list before the run: every third of the passing tracks, first
    track of a name, added on the first day."""
    kept = tracks.where((F.col("popularity") >= 60) & (F.col("id").cast("long") % 3 == 0))
    first = kept.groupBy("name").agg(F.min(F.col("id").cast("long")).cast("string").alias("id"))
    rows = kept.join(first, ["name", "id"], "left_semi").withColumns({
        "add_date": F.lit(FIRST_DAY), "add_day": F.dayofyear(F.lit(FIRST_DAY))})
    have = set(rows.columns)
    return rows.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                         for f in SC.SONGS.fields])


def attach_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Songs in the store that posts can be attached to (id, name)."""
    e = table(spark, sf_dir, "events")
    return (e.where(F.col("user_id") % ATTACH_SKIP_EVERY != 0)
             .select(F.col("user_id").alias("id"),
                     F.concat(F.lit("song"), F.col("user_id").cast("string")).alias("name"))
             .distinct())


def existing_post_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """tweet_ids already stored before this batch."""
    e = table(spark, sf_dir, "events")
    return (e.where(F.col("event_id") < EXISTING_POSTS_BELOW)
             .select((F.col("event_id") / 2).cast("long").cast("string").alias("tweet_id")).distinct())


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), "url", "html")


def song_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Song documents in the shape of ``schemas.SONG_DOCUMENTS``: the lines of a
    document are its posts, every thirteenth without content; a seventh of the
    songs has no list at all, an eleventh of the others an empty one."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    number = F.col("doc_id")
    post = F.transform(F.split("text", "\n"), lambda line, i: F.struct(
        F.concat_ws("-", number.cast("string"), i.cast("string")).alias("tweet_id"),
        F.make_timestamp_ntz(F.lit(2024), F.lit(1), F.lit(1), i % 24, F.lit(0), F.lit(0)).alias("created"),
        (i % 3).cast("int").alias("retweeted"),
        F.when(i % 13 != 12, line).alias("content"),
        F.array(F.col("lang")).alias("hashtags"),
        F.concat(F.lit("user"), (i % 5).cast("string")).alias("username")))
    tweets = F.when(number % 7 == 0, None).when(number % 11 == 0, F.slice(post, 1, 0)).otherwise(post)
    return d.select(
        number.cast("string").alias("_id"),
        F.array_join(F.slice(F.split("text", " "), 1, 3), " ").alias("name"),
        F.concat_ws(",", "lang", "source").alias("artist"),
        (number % 100).cast("string").alias("popularity"),
        *[(F.col("n_chars") % (i + 2)).cast("string").alias(c) for i, c in enumerate(SC.FEATURE_COLS[:11])],
        tweets.alias("tweets"))


def lyric_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Track pages (id, html): the article of each page becomes a block under a
    second-level heading, written in five ways (plain, in a nested tag, another
    text, in a block of its own, in two pieces), with a line before and one
    after the block."""
    p = pages(spark, sf_dir)
    head = (F.when(F.col("id") % 5 == 0, "<h2>Lyrics</h2>").when(F.col("id") % 5 == 1, "<h2><b>Lyrics</b></h2>")
             .when(F.col("id") % 5 == 2, "<h2>About this</h2>").when(F.col("id") % 5 == 3, "<div><h2>Lyrics</h2></div>")
             .otherwise("<h2>Ly<i>rics</i></h2>"))
    block = F.concat(F.lit('<div class="page"><p>a line before the heading</p>'), head)
    opened = F.replace("html", F.lit("<article>"), block)
    closed = F.replace(opened, F.lit("</article>"), F.lit("</div><p>a line after the block</p>"))
    return p.select("id", closed.alias("html"))


def search_songs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The song list the daily searches are planned from (one row per user of
    ``events``, named like the songs that tag the landed search results)."""
    e = table(spark, sf_dir, "events")
    u = e.select("user_id").distinct()
    add_date = F.date_add(F.lit(FIRST_DAY), F.when(F.col("user_id") % 10 == 9, 1).otherwise(0))
    return u.select(
        F.col("user_id").alias("id"),
        F.concat(F.lit("song"), F.col("user_id").cast("string")).alias("name"),
        F.concat(F.lit("Artist "), (F.col("user_id") % 7).cast("string")).alias("artist"),
        add_date.alias("add_date"))
