"""Scans: CSV with header and explicit schema, multi-line CSV, landed post
files laid out by date, Parquet, and lyric lines out of HTML pages
(S1-S5, S7, S13, F12, F15, F16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from textrec.functions import html as H
from textrec.functions import text as T
from textrec.schemas import SONG_DOCUMENTS, TS_OPTIONS
from textrec.sources.split_csv import read_csv_split


def read_csv(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = False,
             glob: str | None = None, escape: str | None = None) -> DataFrame:
    """CSV with a header and an explicit schema (nothing inferred).
    ``escape='"'`` reads files whose writer doubles quotes (pandas)."""
    r = spark.read.schema(schema).option("header", True).options(**TS_OPTIONS)
    if multiline:
        r = r.option("multiLine", True)
    if escape:
        r = r.option("escape", escape)
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.csv(path)


def read_landed_posts(spark: SparkSession, root: str, schema: StructType | str, date=None) -> DataFrame:
    """S4 + S5 + F15: one scan of a folder tree ``<root>/date=<d>/song=<s>/*.csv``.

    The date filter is on a partition column, so Catalyst prunes folders; the
    song name comes from the file path (S5)."""
    df = read_csv(spark, root, schema, multiline=True, glob="*.csv")
    if date is not None:
        df = df.where(F.col("date") == F.lit(date).cast("date"))
    path = F.col("_metadata.file_path")
    song = _unescape(_unescape(F.regexp_extract(path, r"/song=([^/]+)/[^/]*$", 1)))
    return df.withColumn("song_from_path", song)


def read_landed(spark: SparkSession, root: str, schema: StructType, date=None, songs: list[str] | None = None,
                song_col: str = "song") -> DataFrame:
    """S4 + S5 + F15 for what ``write_landed`` wrote: posts with their ``file`` and
    ``date``.  A date reads one folder; given songs read only the files that the
    table of songs names."""
    path: str | list[str] = f"{root}/posts" + (f"/date={date}" if date is not None else "")
    if songs is not None:
        index = spark.read.parquet(f"{root}/songs").where(F.col(song_col).isin(songs))
        if date is not None:
            index = index.where(F.col("date") == F.lit(str(date)).cast("date"))
        path = sorted(r.f for r in index.select(_unescape(F.col("file")).alias("f")).distinct().collect())
    if path == []:
        rows = spark.createDataFrame([], StructType([StructField("file", StringType()), *schema.fields]))
    else:
        rows = read_csv_split(spark, path, schema, glob="*.csv", with_file=True)
    rows = rows.withColumn("date", F.regexp_extract("file", r"/date=([^/]+)/[^/]*$", 1).cast("date"))
    return rows if songs is None else rows.where(F.col(song_col).isin(songs))


def landed_songs(spark: SparkSession, root: str, date=None) -> DataFrame:
    """(file, song, date), which files hold a song's posts."""
    index = spark.read.parquet(f"{root}/songs")
    return index if date is None else index.where(F.col("date") == F.lit(str(date)).cast("date"))


def _unescape(c):
    """Decode %XX escapes once; a literal '+' stays a '+'.  The file path is a
    URI (one level) of a partition folder name (a second level)."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def song_from_blob(df: DataFrame, col: str = "blob") -> DataFrame:
    """S5 for the reference's own blob names ``YYYY-MM-DD/<song>.csv``."""
    return df.withColumn("song", T.song_from_path(col))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S7."""
    return spark.read.parquet(path)


def read_documents(spark: SparkSession, path: str, schema: StructType = SONG_DOCUMENTS, fmt: str = "parquet") -> DataFrame:
    """Song documents with their posts as a nested list.  From Parquet only
    the asked fields of the list are read."""
    return spark.read.schema(schema).options(**TS_OPTIONS).format(fmt).load(path)


def html_lines(pages: DataFrame, id_col: str = "id", html_col: str = "html", heading_tag: str = "h2",
               heading_text: str | Column | None = "Lyrics", container: str | None = "div", line_tag: str = "p",
               min_spaces: int = 2) -> DataFrame:
    """S13 + F16 + F12: lyric lines out of landed HTML pages.

    A page takes part when its first ``heading_tag`` has the string
    ``heading_text`` (None: any); its lines are the strings of the ``line_tag``
    elements inside the ``container`` that encloses the heading most closely
    (None: the whole page), kept when they hold more than ``min_spaces``
    spaces.  Strings are those of ``functions.html``.  A heading without such a
    container gives no lines."""
    found = pages.select(id_col, H.fold_block(F.col(html_col), heading_tag, container or "", line_tag).alias("_f"))
    ok = F.col("_f.head_at").isNotNull()
    if heading_text is not None:
        ok = ok & F.col("_f.head").eqNullSafe(heading_text)
    inside = F.lit(True) if container is None else (F.col("_l.at") > F.col("_f.box")) & (F.col("_l.at") < F.col("_f.box_end"))
    lines = found.where(ok).select(id_col, "_f", F.explode("_f.lines").alias("_l")).where(inside)
    return (lines.select(id_col, F.col("_l.s").alias("lyric_line"))
                 .where(F.col("lyric_line").isNotNull() & (T.space_count("lyric_line") > min_spaces)))
