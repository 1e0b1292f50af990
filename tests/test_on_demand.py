"""Helpers that registered queries do not call: T22 and S5 for blob names."""

from textrec.functions import text as T
from textrec.sources import readers as RD


def test_concat_space_skips_nulls(spark):
    df = spark.createDataFrame([("a b", None, "c")], "x string, y string, z string")
    assert df.select(T.concat_space("x", "y", "z").alias("r")).collect()[0].r == "a b c"


def test_song_from_blob_names(spark):
    df = spark.createDataFrame([("2023-03-21/Flowers.csv",), ("2023-03-21/NO voy a llorar :').csv",)], "blob string")
    assert [r.song for r in RD.song_from_blob(df).collect()] == ["Flowers", "NO voy a llorar :')"]
