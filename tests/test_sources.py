"""Sources and sinks: CSV written by pandas, first-run table, landed folders."""

import pandas as pd
from pyspark.sql import functions as F

from textrec import schemas as SC
from textrec.session import scratch_path
from textrec.sources import readers as RD
from textrec.sources import sinks as SK


def local(path):
    return path[len("file:"):] if path.startswith("file:") else path


def test_read_pandas_csv_with_quotes_and_line_breaks(spark):
    root = scratch_path(spark, "test-pandas-csv")
    import os
    os.makedirs(local(root))
    pdf = pd.DataFrame({"name": ['He said "hi"', "two\nlines"], "id": ["1", "2"]})
    pdf.to_csv(local(root) + "/whole.csv", index=False)
    df = RD.read_csv(spark, root, "name string, id string", multiline=True, escape='"')
    assert sorted((r.id, r.name) for r in df.collect()) == [("1", 'He said "hi"'), ("2", "two\nlines")]


def test_ensure_table_only_when_absent(spark):
    path = scratch_path(spark, "test-first-run")
    SK.ensure_table(spark, path, SC.SONGS)
    assert spark.read.parquet(path).count() == 0
    row = spark.createDataFrame([("a", "1")], "name string, id string").select(
        *[F.col(f.name).cast(f.dataType) if f.name in ("name", "id") else F.lit(None).cast(f.dataType).alias(f.name)
          for f in SC.SONGS.fields])
    SK.append(row, path)
    SK.ensure_table(spark, path, SC.SONGS)   # present: untouched
    assert spark.read.parquet(path).count() == 1


def test_landed_folders_prune_by_date_and_name_song(spark):
    root = scratch_path(spark, "test-landed")
    rows = [("song a", 1, "t1", "2024-01-20"), ("song/b", 2, "t2", "2024-01-20"), ("song a", 3, "t3", "2024-01-21"),
            ("c+d %e é", 4, "t4", "2024-01-20")]
    df = spark.createDataFrame(rows, "song string, seq long, tweet_id string, date string") \
        .withColumn("date", F.col("date").cast("date"))
    SK.write_csv(df, root, partition_by=("date", "song"), spread_by=("tweet_id",))
    back = RD.read_landed_posts(spark, root, "seq long, tweet_id string, date date, song string", date="2024-01-20")
    got = sorted((r.tweet_id, r.song, r.song_from_path) for r in back.collect())
    assert got == [("t1", "song a", "song a"), ("t2", "song/b", "song/b"), ("t4", "c+d %e é", "c+d %e é")]
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_cluster_conf_sizes_partitions():
    from textrec.session import cluster_conf
    conf = cluster_conf(100 * (1 << 40), executors=1000, cores_per_executor=4)   # 100 TB
    assert int(conf["spark.sql.shuffle.partitions"]) == 100 * (1 << 40) // (256 << 20)
    small = cluster_conf(1 << 30, executors=10, cores_per_executor=4)
    assert int(small["spark.sql.shuffle.partitions"]) == 80          # two waves of 40 cores
    assert conf["spark.sql.adaptive.skewJoin.skewedPartitionFactor"] == "5"
