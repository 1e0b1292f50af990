"""Jobs that may be run again."""

import pytest
from pyspark.sql import functions as F

from textrec import schemas as SC
from textrec.plans import catalog, daily
from textrec.session import discard, materialize, scratch_path
from textrec.sources import fixtures as FX
from textrec.sources import sinks as SK
from textrec.sources.store import Store


def test_intake_can_be_repeated(spark, sf):
    root = scratch_path(spark, "again")
    run = lambda day: daily.intake_snapshot(
        Store(spark, root), catalog._tracks(spark, sf), FX.audio_features(spark, sf), day)
    new = lambda day: Store(spark, root).read(f"new_{day}", SC.SONGS)
    first = {r.id for r in run(catalog.RUN_DATE).select("id").collect()}
    again = run(catalog.RUN_DATE)
    assert {r.id for r in again.select("id").collect()} == first and again.count() == len(first) > 0
    assert new(catalog.RUN_DATE).count() == len(first)
    assert run("2024-03-01").count() == len(first)
    assert new("2024-03-01").count() == 0


def test_a_failure_is_not_an_absent_table(spark):
    path = scratch_path(spark, "bad")
    assert not SK.table_exists(spark, path)
    spark.range(3).select(F.col("id").cast("string").alias("value")).write.text(path)
    with pytest.raises(Exception):  # noqa: B017
        SK.ensure_table(spark, path, SC.SONGS)


def test_discard_removes_what_materialize_wrote(spark):
    df = materialize(spark.range(5), "gone")
    path = df._scratch
    assert SK.table_exists(spark, path)
    discard(df, spark.range(1))
    assert not SK.table_exists(spark, path) and df._scratch is None
