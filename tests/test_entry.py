"""Driver contract: entry() runs; every query matches its oracle SQL."""

import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare


def test_entry(spark):
    df = entry.entry(spark)
    rows = df.collect()
    from textrec.plans.build import build_model
    n_songs = build_model(spark, entry.SMOKE_DIR).corpus_ids.count()
    assert len(rows) == min(15, n_songs) > 0
    assert [r.rank for r in rows] == list(range(1, len(rows) + 1))
    assert df.columns == ["rank", "id", "name", "score"]


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_matches_oracle(spark, sf, name):
    res = compare(spark, sf, [name], verbose=True)[name]
    assert res[0] in ("OK", "rows-only"), res
