"""Explicit schemas (section 1.2): nothing is inferred from files."""

from pyspark.sql.types import (ArrayType, BooleanType, DateType, DoubleType, IntegerType, LongType,
                               StringType, StructField, StructType, TimestampNTZType, TimestampType)

FEATURE_COLS = ("danceability", "energy", "key", "loudness", "mode", "speechiness", "acousticness",
                "instrumentalness", "liveness", "valence", "tempo", "type", "duration_ms", "time_signature")

SONGS = StructType([
    StructField("name", StringType()), StructField("id", StringType()), StructField("artist", StringType()),
    StructField("popularity", IntegerType()), StructField("add_day", IntegerType()),
    StructField("add_date", DateType()),
    *[StructField(c, DoubleType()) for c in FEATURE_COLS[:11]],
    StructField("type", StringType()), StructField("duration_ms", IntegerType()),
    StructField("time_signature", IntegerType()),
])

URL = StructType([StructField("url", StringType())])

POSTS = StructType([
    StructField("song", StringType()), StructField("seq", LongType()),
    StructField("tweet_id", StringType()), StructField("created", TimestampNTZType()),
    StructField("retweeted", IntegerType()), StructField("content", StringType()),
    StructField("hashtags", ArrayType(StringType())), StructField("urls", ArrayType(URL)),
    StructField("user_id", StringType()), StructField("username", StringType()),
    StructField("location", StringType()), StructField("num_followers", IntegerType()),
    StructField("geo_enabled", BooleanType()), StructField("long", DoubleType()),
    StructField("lat", DoubleType()), StructField("lang", StringType()),
])

# CSV cannot hold arrays: they travel as JSON strings.
POSTS_CSV = StructType([
    StructField(f.name, StringType()) if isinstance(f.dataType, ArrayType) else f for f in POSTS.fields
])


# The store of songs and posts; a post has the key of its song.
STORED_SONGS = StructType([StructField("_id", StringType()), StructField("name", StringType()),
                           StructField("artist", StringType())])
STORED_SONGS_CSV = StructType([StructField("id", StringType()), *STORED_SONGS.fields[1:]])
STORED_POSTS = StructType([*POSTS.fields, StructField("song_id", StringType())])


def conform(df, schema: StructType):
    """The columns of ``schema``, in its order and types."""
    from pyspark.sql import functions as F
    return df.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields])


# Text formats that keep microseconds (CSV and JSON round trips).
TS_OPTIONS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
              "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


# A song document as the document store exports it: the posts are a list inside,
# which may be empty or absent; numbers are strings, as they came from CSV.
SONG_DOCUMENTS = StructType([
    StructField("_id", StringType()), StructField("name", StringType()), StructField("artist", StringType()),
    *[StructField(c, StringType()) for c in ("popularity", *FEATURE_COLS[:11])],
    StructField("tweets", ArrayType(StructType([POSTS[c] for c in (
        "tweet_id", "created", "retweeted", "content", "hashtags", "username")]))),
])
