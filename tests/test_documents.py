"""Song documents with a nested list of posts: absent, empty and null cases, pruned scans."""

from textrec import schemas as SC
from textrec.operators import clean as C
from textrec.operators import ingest as IN
from textrec.plans import catalog
from textrec.session import scratch_path
from textrec.sources import readers as RD

EXPORT = [
    '{"_id": "a", "name": "Sun song", "artist": "The Band", "popularity": "61", "energy": "0.5", "tweets": ['
    '{"tweet_id": "1", "content": "sun over band 😀 hills!"}, {"tweet_id": "2", "content": null}, {"tweet_id": "3"},'
    ' {"tweet_id": "4", "content": "Song stays"}]}',
    '{"_id": "b", "name": "Empty", "artist": "X", "popularity": "70", "tweets": []}',
    '{"_id": "c", "name": "Absent", "artist": "X", "popularity": "80"}',
    '{"_id": "d", "name": "Null", "artist": "X", "tweets": null}',
]


def documents(spark):
    root = scratch_path(spark, "documents")
    spark.createDataFrame([(line,) for line in EXPORT], "value string").write.text(root)
    return RD.read_documents(spark, root, fmt="json")


def test_lines_features_and_songs_without_posts(spark):
    docs = documents(spark)
    assert sorted(r.tweet_line for r in C.document_lines(docs).collect()) == [" over   hills ", "Song stays"]
    rows = C.document_features(docs).collect()
    assert [(r.id, r.popularity, r.energy, r.tempo) for r in rows] == [("a", 61.0, 0.5, None)]
    assert "tweets" not in rows[0].asDict()
    assert sorted((r.id, r.missing) for r in C.documents_without_posts(docs).collect()) == [("b", False), ("c", True), ("d", True)]
    assert tuple(C.document_total(docs).first()) == (2, 4)
    assert tuple(C.document_total(docs.limit(0)).first()) == (0, 0)


def test_only_the_asked_fields_of_the_list_are_read(spark, sf):
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "tweets:array<struct<content:string>>" in plan(catalog.q_document_lines(spark, sf))
    assert "tweets:array<struct<tweet_id:string>>" in plan(catalog.q_documents_without_posts(spark, sf))
    assert "ReadSchema: struct<tweets:array<struct<tweet_id:string>>>" in plan(catalog.q_document_total(spark, sf))


def test_schema_of_the_fixture(spark, sf):
    from textrec.sources import fixtures as FX
    assert [(f.name, f.dataType) for f in FX.song_documents(spark, sf).schema.fields if f.name != "tweets"] == \
        [(f.name, f.dataType) for f in SC.SONG_DOCUMENTS.fields if f.name != "tweets"]


def test_rename_reaches_the_first_song_of_a_name_only(spark):
    songs = spark.createDataFrame([(3, "A!"), (1, "A!"), (2, "B")], "id long, name string")
    got = {r.id: r.name for r in IN.fix_names(songs, IN.name_fixes(songs)).collect()}
    assert got == {1: "A", 2: "B", 3: "A!"}


def test_report_counts_raw_and_kept_lines(spark):
    long = "a line of more than ten words that is kept, number"
    posts = [(1, f"{long} {c} {c} x") for c in "abcdefghijkl"] + [(1, f"{long} a a x")] * 3 + [(1, None), (2, f"{long} z z x")]
    verses = [(1, "la la la"), (1, "la lo"), (1, "la lo"), (2, None)]
    report = {r.frame: (r.before, r.after, r.pct_removed) for r in C.clean_report(
        spark.createDataFrame(posts, "id long, tweet_line string"),
        spark.createDataFrame(verses, "id long, lyric_line string")).collect()}
    assert report == {"posts": (17, 12, 29.4118), "verses": (4, 1, 75.0)}
    empty = C.clean_report(spark.createDataFrame([], "id long, tweet_line string"),
                           spark.createDataFrame([], "id long, lyric_line string"))
    assert {(r.frame, r.before, r.after, r.pct_removed) for r in empty.collect()} == {("posts", 0, 0, None), ("verses", 0, 0, None)}


def test_report_reads_the_lines_once(spark, sf):
    plan = catalog.q_clean_report(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") <= 2      # one scan for each kind of line


def test_songs_without_posts_are_those_without_a_cleaned_post(spark, tmp_path):
    """Lists of posts that cleaning empties count as none; every song is looked at."""
    words = "one two three four five six seven eight nine ten eleven"
    good = "\n".join(f"{words} post{i}\nverse line" for i in range(11))
    few = "\n".join(f"{words} post{i}\nverse line" for i in range(10))
    short = "\n".join(f"short post{i}\nverse line" for i in range(30))
    rows = [(7, good), (1, few), (2, short), (3, None), (11, good), (11, good)]
    spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'en' lang", "'web' source", "1 n_chars") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    df = catalog.q_songs_without_posts(spark, str(tmp_path))
    assert df.columns == ["id", "name"]
    assert sorted(r.id for r in df.collect()) == [1, 2, 3]
