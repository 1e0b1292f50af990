"""Cleaning of post and lyric lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrec.functions import text as T

MIN_WORDS = 10     # F8: keep posts with more than 10 words
MIN_POSTS = 10     # F10: keep songs with more than 10 posts left (D3)

#: The feature columns that are cast to float.
FLOAT_COLUMNS = ("popularity", "danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness",
                 "instrumentalness", "liveness", "valence", "tempo")


def clean_posts(posts: DataFrame, id_col: str = "id", line_col: str = "tweet_line",
                min_words: int = MIN_WORDS, min_posts: int = MIN_POSTS,
                markers=T.AD_MARKERS, materialize: bool = False) -> DataFrame:
    """A3 -> F5 -> F8 -> F9 -> F10.

    The per-song threshold is a partial aggregate plus a semi-join, so a song
    that holds a third of all posts is counted map-side and its rows are never
    gathered in one task (AQE splits the skewed side of the semi-join).  With
    ``materialize`` the filtered lines are written once, so the text is not
    tokenised a second time for the semi-join."""
    deduped = posts.select(id_col, line_col).where(F.col(line_col).isNotNull()).dropDuplicates([id_col, line_col])
    kept = (deduped.withColumn("word_count", T.word_count(line_col))
                   .where(F.col("word_count") > min_words)
                   .where(~T.has_ad_marker(line_col, markers)))
    if materialize:
        from textrec.session import materialize as _mat
        kept = _mat(kept, "posts-kept")
    enough = kept.groupBy(id_col).count().where(F.col("count") > min_posts).select(id_col)
    return kept.join(enough, id_col, "left_semi")


def songs_min_posts(clean: DataFrame, id_col: str = "id") -> DataFrame:
    """A1 as a report: posts per song that survived cleaning."""
    return clean.groupBy(id_col).agg(F.count("*").alias("n_posts"))


def clean_verses(verses: DataFrame, id_col: str = "id", line_col: str = "lyric_line",
                 min_distinct: int = 1) -> DataFrame:
    """A3 -> F11: drop duplicate lines and lines with one distinct word."""
    deduped = verses.select(id_col, line_col).where(F.col(line_col).isNotNull()).dropDuplicates([id_col, line_col])
    return deduped.where(T.distinct_word_count(line_col) > min_distinct)


def clean_report(posts: DataFrame, verses: DataFrame, id_col: str = "id", post_col: str = "tweet_line",
                 verse_col: str = "lyric_line", min_words: int = MIN_WORDS, min_posts: int = MIN_POSTS,
                 min_distinct: int = 1, markers=T.AD_MARKERS) -> DataFrame:
    """A5 + A7: one row per kind of line with (frame, before, after, pct_removed).

    Raw lines are counted while they are deduplicated, kept lines while they are
    counted for each song (A1 -> F10), so both counts of a kind come out of one
    read and two partial aggregates."""
    lines = (posts.select(F.lit("posts").alias("frame"), id_col, F.col(post_col).alias("line"))
                  .unionByName(verses.select(F.lit("verses").alias("frame"), id_col, F.col(verse_col).alias("line"))))
    distinct = lines.groupBy("frame", id_col, "line").agg(F.count("*").alias("n"))
    post = (F.col("frame") == "posts") & (T.word_count("line") > min_words) & ~T.has_ad_marker("line", markers)
    verse = (F.col("frame") == "verses") & (T.distinct_word_count("line") > min_distinct)
    kept = F.col("line").isNotNull() & (post | verse)
    songs = distinct.groupBy("frame", id_col).agg(F.sum("n").alias("n"), F.sum(kept.cast("bigint")).alias("kept"))
    after = F.sum(F.when((F.col("frame") == "verses") | (F.col("kept") > min_posts), F.col("kept")).otherwise(0))
    report = songs.groupBy("frame").agg(F.sum("n").alias("before"), after.alias("after"))
    # a kind without lines has a row as well
    both = posts.sparkSession.range(2).select(F.when(F.col("id") == 0, "posts").otherwise("verses").alias("frame"))
    full = both.join(report, "frame", "left").na.fill(0, ["before", "after"])
    return full.withColumn("pct_removed", F.round(F.try_divide((F.col("before") - F.col("after")) * 100.0, F.col("before")), 4))


def test_rows(lines: DataFrame, line_col: str = "tweet_line") -> DataFrame:
    """skip test rows that are empty or one non-space character long."""
    c = F.col(line_col)
    return lines.where(c.isNotNull() & (F.length(F.replace(c, F.lit(" "), F.lit(""))) > 1))


def prepare_lines(songs: DataFrame, posts: DataFrame, id_col: str = "id",
                  content_col: str = "content", ignore_case: bool = False) -> DataFrame:
    """(id, tweet_line) from the stored songs and their posts.

    F5 (content present) -> T1 (emoji) -> T2 (symbols, no lower-casing) -> T11
    (remove the song's own title and artist tokens, all of them, in order).
    The song side is one row per id; AQE splits a hot song on the post side."""
    own = songs.select(
        id_col,
        F.concat(T.tokens("name"), T.tokens("artist")).alias("_own"))
    p = posts.where(F.col(content_col).isNotNull()).select(id_col, content_col)
    cleaned = T.strip_symbols(T.strip_emoji(content_col))
    if ignore_case:
        cleaned = F.lower(cleaned)
    joined = p.join(own, id_col, "inner")
    return joined.select(id_col, T.remove_words(cleaned, "_own").alias("tweet_line"))


def document_lines(documents: DataFrame, id_col: str = "_id", list_col: str = "tweets",
                   content: str = "content") -> DataFrame:
    """M10 from nested documents: S6 (list not empty) -> S9 (explode) -> F5 ->
    T1 -> T2 -> T11, giving (id, tweet_line).  Only the content of the list's
    elements is asked for, so a columnar scan reads no other field of them."""
    contents = F.col(f"{list_col}.{content}")
    rows = documents.where(F.size(contents) > 0).select(
        F.col(id_col).alias("id"), F.concat(T.tokens("name"), T.tokens("artist")).alias("_own"),
        F.explode(contents).alias("_content"))
    cleaned = T.strip_symbols(T.strip_emoji("_content"))
    return rows.where(F.col("_content").isNotNull()).select("id", T.remove_words(cleaned, "_own").alias("tweet_line"))


def document_features(documents: DataFrame, id_col: str = "_id", list_col: str = "tweets", key: str = "tweet_id",
                      cols=FLOAT_COLUMNS) -> DataFrame:
    """F6 + P2 + P4: the features of songs that have posts, without the list."""
    has = documents.where(F.size(f"{list_col}.{key}") > 0).drop(list_col)
    return features(has.withColumnRenamed(id_col, "id"), cols)


def documents_without_posts(documents: DataFrame, id_col: str = "_id", list_col: str = "tweets",
                            key: str = "tweet_id") -> DataFrame:
    """songs without posts, kept aside: (id, name, missing), where missing
    tells a document that lacks the list from one whose list is empty."""
    size = F.size(f"{list_col}.{key}")
    listed = F.col(f"{list_col}.{key}").isNotNull()
    return documents.where(~listed | (size == 0)).select(F.col(id_col).alias("id"), "name", (~listed).alias("missing"))


def document_total(documents: DataFrame, list_col: str = "tweets", key: str = "tweet_id") -> DataFrame:
    """One row (n_songs, n_posts), songs that have the list and the sum of its sizes."""
    ids = F.col(f"{list_col}.{key}")
    return documents.where(ids.isNotNull()).agg(F.count("*").alias("n_songs"),
                                                F.coalesce(F.sum(F.size(ids)), F.lit(0)).alias("n_posts"))


def features(songs: DataFrame, cols=FLOAT_COLUMNS) -> DataFrame:
    """Cast the listed feature columns to float, in one projection; a
    missing column is an error."""
    return songs.withColumns({c: F.col(c).cast("float") for c in cols})


def songs_without_posts(songs: DataFrame, posts: DataFrame, id_col: str = "id") -> DataFrame:
    """F6 + F7: songs that have no post, kept aside (anti-join, no driver list)."""
    return songs.join(posts.select(id_col).distinct(), id_col, "left_anti")


def songs_with_posts(songs: DataFrame, posts: DataFrame, id_col: str = "id") -> DataFrame:
    """Features only for songs that have posts (semi-join)."""
    return songs.join(posts.select(id_col).distinct(), id_col, "left_semi")


def clean_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS, min_posts: int = MIN_POSTS, min_distinct: int = 1,
                markers=T.AD_MARKERS, observation=None):
    """Both cleanings from one scan of the documents: lines are split once,
    even lines are posts and odd lines lyrics; each kind is deduplicated and
    filtered by its own rule, and only the kept lines are written (the raw
    text, the largest table, is read once) by the tasks that deduplicated them,
    spread by the hash of the line.  Returns (posts_clean,
    verses_clean) equal to ``clean_posts`` / ``clean_verses`` on the views."""
    from textrec.session import materialize
    raw = (docs.select(F.col(id_col).alias("id"), F.posexplode_outer(F.split(text_col, "\n")).alias("pos", "line"))
               .where(F.col("pos").isNotNull() & F.col("line").isNotNull())
               .select((F.col("pos") % 2).cast("int").alias("kind"), "id", "line"))
    if observation is not None:
        # A5: raw line counts, observed during the same scan (no extra job)
        raw = raw.observe(observation, F.sum((F.col("kind") == 0).cast("long")).alias("posts_in"),
                          F.sum((F.col("kind") == 1).cast("long")).alias("verses_in"))
    lines = raw.dropDuplicates(["kind", "id", "line"])
    w = T.words("line")
    keep_post = (F.col("kind") == 0) & (F.size(w) > min_words) & ~T.has_ad_marker("line", markers)
    keep_verse = (F.col("kind") == 1) & (F.size(F.array_distinct(w)) > min_distinct)
    kept = materialize(
        lines.where(keep_post | keep_verse)
             .withColumn("word_count", F.when(F.col("kind") == 0, F.size(w))),
        "lines-kept", partition_by=("kind",))
    posts = kept.where(F.col("kind") == 0).select("id", F.col("line").alias("tweet_line"), "word_count")
    # written first, so that the join knows its size and need not shuffle the text
    enough = materialize(posts.groupBy("id").count().where(F.col("count") > min_posts).select("id"), "songs-enough")
    posts = posts.join(enough, "id", "left_semi")
    verses = kept.where(F.col("kind") == 1).select("id", F.col("line").alias("lyric_line"))
    return posts, verses
