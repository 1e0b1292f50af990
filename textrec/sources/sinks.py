"""Sinks (K3, K7-K10): CSV and Parquet writers, append, first-run table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from textrec.schemas import TS_OPTIONS
from textrec.sources.split_csv import read_csv_split


#: The CSV writer trims values unless told not to.
KEEP_SPACES = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def arrays_to_json(df: DataFrame) -> DataFrame:
    """CSV has no arrays: encode array columns as JSON strings."""
    return df.withColumns({f.name: F.to_json(f.name) for f in df.schema.fields
                           if isinstance(f.dataType, ArrayType)})


def arrays_from_json(df: DataFrame, schema: StructType) -> DataFrame:
    return df.withColumns({f.name: F.from_json(f.name, f.dataType) for f in schema.fields
                           if isinstance(f.dataType, ArrayType) and f.name in df.columns})


def write_csv(df: DataFrame, path: str, partition_by=(), mode: str = "errorifexists",
              spread_by=()) -> None:
    """K3 / K9: CSV with a header.  With ``partition_by`` one folder per value;
    ``spread_by`` range-partitions first, so a large partition value is
    written by many tasks and small ones share a task (no file per task and
    value explosion, no single task for a hot value)."""
    out = arrays_to_json(df)
    if spread_by:
        out = out.repartitionByRange(*partition_by, *spread_by)
    w = out.write.mode(mode).option("header", True).options(**TS_OPTIONS)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def write_landed(df: DataFrame, root: str, date, song_col: str = "song", order_cols=("tweet_id",)) -> None:
    """K9: the posts of one day, clustered by ranges of the song's hash.  How many
    files there are follows from the bytes, not from the number of songs; a song
    with many posts spreads over several.  ``songs/`` beside them tells which
    files hold a song."""
    path, index = f"{root}/posts/date={date}", f"{root}/songs/date={date}"
    out = arrays_to_json(df).withColumn("_h", F.xxhash64(song_col))
    order = ["_h", song_col, *order_cols]
    (out.repartitionByRange(*order).sortWithinPartitions(*order).drop("_h")
        .write.option("header", True).option("escape", '"').options(**TS_OPTIONS, **KEEP_SPACES).csv(path))
    written = read_csv_split(df.sparkSession, path, out.drop("_h").schema, glob="*.csv", with_file=True)
    written.select("file", song_col).distinct().write.parquet(index)


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", partition_by=()) -> None:
    """Save a frame as Parquet; by default an existing path is an error."""
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Only a missing path counts as absent; any other failure is raised."""
    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def ensure_table(spark: SparkSession, path: str, schema: StructType) -> None:
    """K8 (D8): create an empty table only when the path is absent."""
    if not table_exists(spark, path):
        spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)


def append(df: DataFrame, path: str, partition_by=()) -> None:
    """Append rows to a table."""
    write_parquet(df, path, "append", partition_by)


def write_json(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Landed JSON records (microsecond timestamps kept)."""
    df.write.mode(mode).options(**TS_OPTIONS).json(path)
