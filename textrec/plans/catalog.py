"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame over
the whole driver tables.  Column names equal those of the SQL in
``textrec.plans.oracle``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textrec.functions import text as T
from textrec.operators import clean as C
from textrec.operators import evaluate as E
from textrec.operators import model as M
from textrec.operators import score as S
from textrec.operators import split as SP
from textrec.plans.build import build_model
from textrec import schemas as SC
from textrec.functions import stem as ST
from textrec.operators import collect as CO
from textrec.operators import ingest as IN
from textrec.plans import daily as DJ
from textrec.session import materialize, scratch_path
from textrec.sources import fixtures as FX
from textrec.sources import readers as RD
from textrec.sources import sinks as SK
from textrec.sources.split_csv import read_csv_split
from textrec.sources.store import Store
from textrec.streaming import intake as WS

# The two smoke sentences of the reference (fixed values).
SMOKE_TEXT = "beautiful summer, wanna make a ride into mountains and find fountains"
SMOKE_TEXT_2 = "tough days doing internship and homework, need help!"
TOP_K = 15


# --- text functions -------------------------------------------------------

def q_tokens_len_stop(spark: SparkSession, sf: str) -> DataFrame:
    p = FX.lines(spark, sf)
    t = T.tokens("tweet_line")
    return p.select("id", "tweet_line", F.size(t).alias("n_tokens"), F.array_join(t, " ").alias("tokens"))


def q_word_count(spark, sf):
    return FX.lines(spark, sf).select("id", "tweet_line", T.word_count("tweet_line").alias("word_count"))


def q_distinct_word_count(spark, sf):
    return FX.lines(spark, sf).select(
        "id", "tweet_line", T.distinct_word_count("tweet_line").alias("distinct_word_count"))


def q_strip_emoji(spark, sf):
    d = FX.table(spark, sf, "documents")
    return d.select("doc_id", T.strip_emoji("text").alias("text_out"))


def q_strip_symbols(spark, sf):
    d = FX.table(spark, sf, "documents")
    return d.select("doc_id", T.strip_symbols("text").alias("text_out"))


def q_remove_own_words(spark, sf):
    own = FX.songs(spark, sf).select("id", F.concat(T.tokens("name"), T.tokens("artist")).alias("own"))
    p = FX.lines(spark, sf).join(own, "id", "inner")
    return p.select("id", "tweet_line", T.remove_words("tweet_line", "own").alias("line_out"))


# --- cleaning ---------------------------------------------------------------

def q_posts_clean(spark, sf):
    return C.clean_posts(FX.posts(spark, sf))


def q_posts_clean_one_scan(spark, sf):
    """posts_clean computed by the one-scan cleaning that the build uses."""
    return C.clean_lines(FX.table(spark, sf, "documents"))[0]


def q_verses_clean_one_scan(spark, sf):
    return C.clean_lines(FX.table(spark, sf, "documents"))[1]


def q_songs_min_posts(spark, sf):
    return C.songs_min_posts(C.clean_posts(FX.posts(spark, sf)))


def q_verses_clean(spark, sf):
    return C.clean_verses(FX.verses(spark, sf))


def q_clean_report(spark, sf):
    return C.clean_report(FX.posts(spark, sf), FX.verses(spark, sf))


def _documents(spark, sf):
    root = scratch_path(spark, "song-documents")
    SK.write_parquet(FX.song_documents(spark, sf), root)
    return RD.read_documents(spark, root)


def q_songs_without_posts(spark, sf):
    """Songs that keep no post after cleaning."""
    posts = C.clean_lines(FX.table(spark, sf, "documents"))[0]
    return C.songs_without_posts(FX.songs(spark, sf), posts).select("id", "name")


def q_documents_without_posts(spark, sf):
    return C.documents_without_posts(_documents(spark, sf))


def q_document_lines(spark, sf):
    return C.document_lines(_documents(spark, sf))


def q_document_features(spark, sf):
    return C.document_features(_documents(spark, sf)).select("id", "name", *C.FLOAT_COLUMNS)


def q_document_total(spark, sf):
    return C.document_total(_documents(spark, sf))


def q_post_total(spark, sf):
    per_song = FX.lines(spark, sf).groupBy("id").agg(F.count("*").alias("n"))
    return per_song.agg(F.count("*").alias("n_songs"), F.sum("n").alias("n_posts"))


def q_prepare_lines(spark, sf):
    songs = FX.songs(spark, sf)
    posts = FX.lines(spark, sf).withColumnRenamed("tweet_line", "content")
    return C.prepare_lines(songs, posts)


def q_features_cast(spark, sf):
    """The 12 casts on tracks with their audio features."""
    songs = _tracks(spark, sf).select("id", "name", "popularity").join(FX.audio_features(spark, sf), "id")
    return C.features(songs).select("id", "name", *C.FLOAT_COLUMNS)


# --- split ------------------------------------------------------------------

def q_split_hash(spark, sf):
    pc = C.clean_posts(FX.posts(spark, sf))
    return SP.label_split_hash(pc, 0.1, ("id", "tweet_line"), 42).select("id", "tweet_line", "part")


def q_split_exact(spark, sf):
    pc = C.clean_posts(FX.posts(spark, sf))
    return SP.split_exact(pc, 0.1, "id", "tweet_line", 42).select("id", "tweet_line", "part")


def q_split_sample_by(spark, sf):
    pc = C.clean_posts(FX.posts(spark, sf))
    return SP.split_sample_by(pc, 0.1, 42).select("id", "tweet_line", "part")


# --- model, scoring, evaluation ---------------------------------------------

def q_corpus_terms(spark, sf):
    return build_model(spark, sf).tf.select("id", "term", "tf")


def q_doc_freq_idf(spark, sf):
    tf = build_model(spark, sf).tf
    return M.fit_idf(tf).select("term", "df", F.round("idf", 6).alias("idf"))


def q_tfidf_exact(spark, sf):
    post = build_model(spark, sf).postings
    return post.select("id", "term", "tf", F.round("w", 6).alias("w"))


def q_tfidf_hashed(spark, sf):
    post = build_model(spark, sf, hashed=True).postings
    return post.select("id", "h", "tf", F.round("w", 6).alias("w"))


def q_recommend_one(spark, sf):
    m = build_model(spark, sf)
    return S.recommend_one(SMOKE_TEXT, m.postings, FX.songs(spark, sf), TOP_K, corpus_ids=m.corpus_ids)


def q_recommend_hashed(spark, sf):
    """The reference's own model: HashingTF buckets (100,000) + IDF; every
    benchmark passage is a query, hashed the same way."""
    m = build_model(spark, sf, hashed=True)
    bench = FX.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    recs = S.recommend(bench, m.postings, FX.songs(spark, sf), TOP_K, term_col="h", corpus_ids=m.corpus_ids, blocks=m.blocks)
    return recs.select(F.col("query_id").alias("item_id"), "rank", "id", "name", "score")


def q_recommend_benchmark(spark, sf):
    """Every benchmark passage is a query against the whole corpus."""
    m = build_model(spark, sf)
    bench = FX.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    recs = S.recommend(bench, m.postings, FX.songs(spark, sf), TOP_K, corpus_ids=m.corpus_ids, blocks=m.blocks)
    return recs.select(F.col("query_id").alias("item_id"), "rank", "id", "name", "score")


def q_recommend_bounded(spark, sf):
    """recommend_benchmark by the bounds of posting blocks, whatever its size."""
    m = build_model(spark, sf)
    bench = FX.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    recs = S.recommend(bench, m.postings, FX.songs(spark, sf), TOP_K, corpus_ids=m.corpus_ids, blocks=m.blocks, join_rows=0)
    return recs.select(F.col("query_id").alias("item_id"), "rank", "id", "name", "score")


def q_recommend_batch(spark, sf):
    m = build_model(spark, sf)
    tests = C.test_rows(m.test_posts)
    queries = tests.select(E.query_key("id", "tweet_line").alias("query_id"),
                           F.col("id").alias("query_song"), F.col("tweet_line").alias("text"))
    recs = S.recommend(queries.select("query_id", "text"), m.postings, FX.songs(spark, sf), TOP_K,
                       corpus_ids=m.corpus_ids, blocks=m.blocks)
    return (queries.join(recs, "query_id", "inner")
                   .select("query_song", F.col("text").alias("query_line"), "rank", "id", "name", "score"))


def q_target_rank(spark, sf):
    m = build_model(spark, sf)
    return E.target_ranks(m.test_posts, m.postings, E.LIST_SIZE, corpus_ids=m.corpus_ids, blocks=m.blocks)


def q_topk_accuracy(spark, sf):
    m = build_model(spark, sf)
    return E.accuracy(E.target_ranks(m.test_posts, m.postings, E.LIST_SIZE, corpus_ids=m.corpus_ids, blocks=m.blocks), E.HIT_RANK)


# The reference's code ranks within a top-10 list and counts rank <= 15 (zero-based) as a hit.
CODE_LIST_SIZE, CODE_HIT_RANK = 10, 15


def q_topk_accuracy_code(spark, sf):
    m = build_model(spark, sf)
    return E.accuracy(E.target_ranks(m.test_posts, m.postings, CODE_LIST_SIZE, corpus_ids=m.corpus_ids, blocks=m.blocks), CODE_HIT_RANK)


def q_accuracy_at_10_15(spark, sf):
    """Top-10 and top-15 hit rates over all held-out posts in one pass."""
    m = build_model(spark, sf)
    return E.accuracy_at(E.target_ranks(m.test_posts, m.postings, 15, corpus_ids=m.corpus_ids, blocks=m.blocks), (10, 15))


SAMPLE_TESTS = 50


def q_sample_tests(spark, sf):
    """The first 50 held-out rows, which is the feature."""
    return E.sample_tests(C.test_rows(build_model(spark, sf).test_posts), SAMPLE_TESTS).select("id", "tweet_line")


def q_topk_accuracy_hashed(spark, sf):
    """The reference's configuration end to end: hashed TF-IDF, top-10 list."""
    m = build_model(spark, sf, hashed=True)
    return E.accuracy(E.target_ranks(m.test_posts, m.postings, CODE_LIST_SIZE, term_col="h", corpus_ids=m.corpus_ids, blocks=m.blocks), CODE_HIT_RANK)


QUERIES = {
    "tokens_len_stop": q_tokens_len_stop,
    "word_count": q_word_count,
    "distinct_word_count": q_distinct_word_count,
    "strip_emoji": q_strip_emoji,
    "strip_symbols": q_strip_symbols,
    "remove_own_words": q_remove_own_words,
    "posts_clean": q_posts_clean,
    "posts_clean_one_scan": q_posts_clean_one_scan,
    "verses_clean_one_scan": q_verses_clean_one_scan,
    "songs_min_posts": q_songs_min_posts,
    "verses_clean": q_verses_clean,
    "clean_report": q_clean_report,
    "songs_without_posts": q_songs_without_posts,
    "documents_without_posts": q_documents_without_posts,
    "document_lines": q_document_lines,
    "document_features": q_document_features,
    "document_total": q_document_total,
    "post_total": q_post_total,
    "prepare_lines": q_prepare_lines,
    "features_cast": q_features_cast,
    "split_hash": q_split_hash,
    "split_exact": q_split_exact,
    "split_sample_by": q_split_sample_by,
    "corpus_terms": q_corpus_terms,
    "doc_freq_idf": q_doc_freq_idf,
    "tfidf_exact": q_tfidf_exact,
    "tfidf_hashed": q_tfidf_hashed,
    "recommend_one": q_recommend_one,
    "recommend_benchmark": q_recommend_benchmark,
    "recommend_bounded": q_recommend_bounded,
    "recommend_hashed": q_recommend_hashed,
    "recommend_batch": q_recommend_batch,
    "target_rank": q_target_rank,
    "topk_accuracy": q_topk_accuracy,
    "topk_accuracy_code": q_topk_accuracy_code,
    "accuracy_at_10_15": q_accuracy_at_10_15,
    "topk_accuracy_hashed": q_topk_accuracy_hashed,
    "sample_tests": q_sample_tests,
}


# --- collection and consolidation -------------------------------------------


RUN_DATE = "2024-02-24"      # the day the intake and the day plan run for
END_DATE = "2024-01-20"      # search results must be older than this
POSTS_PER_SEARCH = 20        # G5, the newest posts of each search; only in select_posts, whose feature it is


def _tracks(spark, sf):
    return CO.flatten_playlists(FX.playlist_items(spark, sf))


def _posts_flat(spark, sf):
    return CO.flatten_status(FX.raw_statuses(spark, sf))


def q_song_intake(spark, sf):
    out = CO.intake(_tracks(spark, sf), FX.audio_features(spark, sf), FX.known_songs(spark, sf), RUN_DATE)
    return out


def q_insert_if_absent(spark, sf):
    batch = _tracks(spark, sf).select("id", "name", "artist", "popularity", "playlist_pos", "item_pos", "_apos")
    new = IN.insert_if_absent(batch, FX.known_songs(spark, sf), "id", ["playlist_pos", "item_pos", "_apos"])
    return new.select("_id", "name", "artist", "popularity")


def q_day_plan(spark, sf):
    songs = FX.songs(spark, sf)
    new = songs.where(F.col("add_date") == F.lit(RUN_DATE).cast("date"))
    return CO.day_plan(songs, new, RUN_DATE)


def q_search_string(spark, sf):
    t = _tracks(spark, sf).select("id", "name", "artist")
    return CO.search_plan(t).select("id", "name", "artist", "song_q", "query")


def q_title_trim(spark, sf):
    d = FX.table(spark, sf, "documents")
    return d.select("doc_id", T.trim_title("text").alias("title_q"))


def _post_out(df):
    return df.select("song", "tweet_id", F.col("created").cast("string").alias("created"), "retweeted", "content",
                     F.array_join("hashtags", ",").alias("hashtags"), F.size("urls").alias("n_urls"),
                     "user_id", "username", "num_followers", "geo_enabled", "long", "lat")


def q_select_posts(spark, sf):
    return _post_out(CO.select_posts(_posts_flat(spark, sf), END_DATE, "en", POSTS_PER_SEARCH))


def q_attach_posts(spark, sf):
    out = IN.attach_posts(_posts_flat(spark, sf), FX.attach_songs(spark, sf), FX.existing_post_ids(spark, sf))
    return out.select("song_id", "song", "tweet_id", F.col("created").cast("string").alias("created"), "seq")


def q_attach_posts_all(spark, sf):
    out = IN.attach_posts(_posts_flat(spark, sf), FX.attach_songs(spark, sf), dedupe=False)
    return out.select("song_id", "song", "tweet_id", F.col("created").cast("string").alias("created"), "seq")


def q_rejected_posts(spark, sf):
    return IN.rejected_posts(_posts_flat(spark, sf), FX.attach_songs(spark, sf)).select("song", "tweet_id", "seq")


def q_fix_names(spark, sf):
    songs = FX.songs(spark, sf)
    return IN.fix_names(songs, IN.name_fixes(songs)).select("id", "name")


def q_blob_names(spark, sf):
    """Song names out of blob names ``<day>/<name>.csv``."""
    t = _tracks(spark, sf)
    blob = F.concat(F.lit(RUN_DATE + "/"), F.col("name"), F.when(F.col("popularity") % 4 == 0, ".csv").otherwise(".csv.csv"))
    return RD.song_from_blob(t.select("id", blob.alias("blob")))


def q_html_lines(spark, sf):
    """Any first-level heading, lines of the article around it."""
    return RD.html_lines(FX.pages(spark, sf), heading_tag="h1", heading_text=None, container="article")


def q_lyric_lines(spark, sf):
    """The first second-level heading has to be ``Lyrics``; lines of its div."""
    return RD.html_lines(FX.lyric_pages(spark, sf))


QUERIES.update({
    "song_intake": q_song_intake,
    "insert_if_absent": q_insert_if_absent,
    "day_plan": q_day_plan,
    "search_string": q_search_string,
    "title_trim": q_title_trim,
    "select_posts": q_select_posts,
    "attach_posts": q_attach_posts,
    "attach_posts_all": q_attach_posts_all,
    "rejected_posts": q_rejected_posts,
    "fix_names": q_fix_names,
    "blob_names": q_blob_names,
    "html_lines": q_html_lines,
    "lyric_lines": q_lyric_lines,
})


# --- stemming, written tables, streaming ------------------------------------



def q_stem_vocab(spark, sf):
    return ST.stem_map(M.line_terms(FX.lines(spark, sf), "tweet_line"))


def q_lemma_stem_vocab(spark, sf):
    """The lemma step before the stem; the vocabulary is its own dictionary of
    base forms."""
    terms = M.line_terms(FX.lines(spark, sf), "tweet_line").select("term").distinct()
    lemmas = materialize(ST.lemma_map(terms, terms.withColumnRenamed("term", "word")), "lemmas")
    with_lemma = terms.join(lemmas.withColumnRenamed("word", "term"), "term", "left").select(
        "term", F.coalesce("lemma", "term").alias("lemma"))
    return with_lemma.join(ST.stem_map(terms, lemmas=lemmas), "term").select("term", "lemma", "stem")


def q_recommend_stemmed(spark, sf):
    """Corpus and queries stemmed (T12, D6 stem_query=True); each side stems
    its own distinct terms."""
    m = build_model(spark, sf, stem=True)
    bench = FX.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    recs = S.recommend(bench, m.postings, FX.songs(spark, sf), TOP_K, stem=True, corpus_ids=m.corpus_ids, blocks=m.blocks)
    return recs.select(F.col("query_id").alias("item_id"), "rank", "id", "name", "score")


def q_csv_round_trip(spark, sf):
    root = scratch_path(spark, "posts-csv")
    chosen = CO.select_posts(_posts_flat(spark, sf), END_DATE, "en", None) \
        .withColumn("date", F.lit(RUN_DATE).cast("date"))
    SK.write_csv(chosen, root, partition_by=("date",))
    from pyspark.sql.types import DateType, StructField, StructType
    schema = StructType(list(SC.POSTS_CSV.fields) + [StructField("date", DateType())])
    back = SK.arrays_from_json(RD.read_csv(spark, root, schema, multiline=True), SC.POSTS)
    return _post_out(back)


def q_csv_line_breaks(spark, sf):
    """Whole documents, line breaks and quotes included, through CSV files
    that are read in ranges."""
    root = scratch_path(spark, "documents-csv")
    d = FX.table(spark, sf, "documents").select("doc_id", "text", "source")
    d.write.option("header", True).option("escape", '"').options(**SK.KEEP_SPACES).csv(root)
    return read_csv_split(spark, root, d.schema, glob="*.csv").select("doc_id", "text", "source")


def q_path_to_song(spark, sf):
    """Landed posts with the song that the table of files gives for them."""
    root = scratch_path(spark, "landed")
    chosen = CO.select_posts(_posts_flat(spark, sf), END_DATE, "en", None)
    SK.write_landed(chosen.select(*SC.POSTS.names), root, RUN_DATE)
    back = RD.read_landed(spark, root, SC.POSTS_CSV, RUN_DATE)
    songs = RD.landed_songs(spark, root, RUN_DATE).select("file", F.col("song").alias("song_from_path"))
    found = back.join(songs, (back["file"] == songs["file"]) & (back["song"] == F.col("song_from_path")))
    return found.select("song", "song_from_path", "tweet_id", back["date"].cast("string").alias("date"))


def q_intake_snapshot(spark, sf):
    store = Store(spark, scratch_path(spark, "songs"))
    return DJ.intake_snapshot(store, _tracks(spark, sf), FX.audio_features(spark, sf), RUN_DATE)


def q_daily_job(spark, sf):
    """Intake into a list with earlier songs, plan, search by string, landed posts."""
    root = scratch_path(spark, "daily")
    store = Store(spark, root + "/store")
    store.commit(replace={"whole": FX.stored_tracks(_tracks(spark, sf))})
    out = DJ.daily_job(spark, store, _tracks(spark, sf), FX.audio_features(spark, sf), FX.landed_statuses(spark, sf),
                       RUN_DATE, END_DATE, root + "/landed", None)
    return out.select("song", "tweet_id", F.col("created").cast("string").alias("created"), "retweeted", "content")


STORED_EVERY = 3             # ingest: songs with user_id % 3 = 0 are in the store already


def q_ingest_batch(spark, sf):
    """A batch into a store that has songs and posts already; all stored posts."""
    root = scratch_path(spark, "ingest")
    store = Store(spark, root + "/store", buckets=16)
    songs = FX.attach_songs(spark, sf).select(
        F.col("id").cast("string").alias("id"), "name", F.lit("artist").alias("artist"))
    early = songs.where(F.col("id").cast("long") % STORED_EVERY == 0)
    posts = _posts_flat(spark, sf)
    first = IN.attach_posts(posts.where(F.col("seq") < FX.EXISTING_POSTS_BELOW), early)
    store.commit(append={"songs": early.withColumnRenamed("id", "_id"), "posts": first.select(*SC.STORED_POSTS.names)},
                 cluster={"posts": "tweet_id"})
    SK.write_csv(songs, root + "/songs")
    SK.write_csv(posts, root + "/posts")
    DJ.ingest_batch(spark, store, root + "/songs", root + "/posts")
    return store.read("posts", SC.STORED_POSTS).select(
        F.col("song_id").cast("long").alias("song_id"), "song", "tweet_id",
        F.col("created").cast("string").alias("created"), "seq")


def q_stream_intake(spark, sf):
    root = scratch_path(spark, "stream")
    landing, ckpt = root + "/landing", root + "/_checkpoint"
    store = Store(spark, root + "/store", buckets=16)
    flat = _posts_flat(spark, sf)
    songs = FX.attach_songs(spark, sf)
    stored = flat.where(F.col("seq") < FX.EXISTING_POSTS_BELOW).withColumn("song_id", F.lit(None).cast("string"))
    store.commit(append={"posts": stored.select(*SC.STORED_POSTS.names)}, cluster={"posts": "tweet_id"})
    # two drops; the copies of a tweet (events 2k and 2k+1) cross them, so the
    # second drop has to find the stored ones
    SK.write_json(flat.where(F.col("seq") % 2 == 0), landing)
    WS.run_intake(spark, landing, store.root, ckpt, songs, SC.POSTS)
    SK.write_json(flat.where(F.col("seq") % 2 == 1), landing, mode="append")
    WS.run_intake(spark, landing, store.root, ckpt, songs, SC.POSTS)
    out = Store(spark, store.root).read("posts", SC.STORED_POSTS).where(F.col("song_id").isNotNull())
    return out.select(F.col("song_id").cast("long").alias("song_id"), "song", "tweet_id",
                      F.col("created").cast("string").alias("created"), "seq")


def q_recommend_from(spark, sf):
    root = scratch_path(spark, "model")
    m = build_model(spark, sf)
    SK.write_parquet(m.postings, root + "/postings")
    SK.write_parquet(FX.songs(spark, sf), root + "/songs")
    SK.write_parquet(m.corpus_ids, root + "/corpus_ids")
    SK.write_parquet(m.blocks, root + "/blocks")
    bench = FX.table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    recs = DJ.recommend_from(spark, root, bench, TOP_K)
    return recs.select(F.col("query_id").alias("item_id"), "rank", "id", "name", "score")


QUERIES.update({
    "stem_vocab": q_stem_vocab,
    "lemma_stem_vocab": q_lemma_stem_vocab,
    "recommend_stemmed": q_recommend_stemmed,
    "csv_round_trip": q_csv_round_trip,
    "csv_line_breaks": q_csv_line_breaks,
    "path_to_song": q_path_to_song,
    "intake_snapshot": q_intake_snapshot,
    "daily_job": q_daily_job,
    "ingest_batch": q_ingest_batch,
    "stream_intake": q_stream_intake,
    "recommend_from": q_recommend_from,
})
