"""DuckDB SQL equal to each registered query, over the raw driver tables.

The text rules are written once in ``textrec.functions.text``; the SQL below
spells the same rules with DuckDB built-ins (RE2 regexes with the 'g' flag,
list lambdas)."""

from __future__ import annotations

from textrec.functions import text as T
from textrec.operators.clean import FLOAT_COLUMNS
from textrec.operators import evaluate as E
from textrec.plans import catalog as CAT
from textrec.plans import oracle_html
from textrec.plans import oracle_terms as OT


def rnd(x: str, d: int = 6) -> str:
    """round(x, d) as the nearest double to the decimal result, like Spark's round."""
    return f"CAST(CAST(round({x}, {d}) AS DECIMAL(38,{d})) AS DOUBLE)"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


STOP = "[" + ", ".join(lit(w) for w in T.STOP_WORDS) + "]"
R_SCORE = rnd("score")
R_IDF = rnd("idf")
R_W = rnd("w")
R_PCT = rnd("(before - after) * 100.0 / before", 4)
R_ACC = rnd(f"avg(CASE WHEN rank <= {E.HIT_RANK} THEN 1.0 ELSE 0.0 END)")
PUNCT = lit(T.PUNCT_DIGITS)
EMOJI = lit(T.EMOJI_PATTERN)


def norm(x: str) -> str:
    return f"regexp_replace(lower({x}), {PUNCT}, ' ', 'g')"


def tokens(x: str) -> str:
    return f"list_filter(string_split({norm(x)}, ' '), lambda w: length(w) >= 3 AND NOT list_contains({STOP}, w))"


def words(x: str) -> str:
    return f"list_filter(string_split({norm(x)}, ' '), lambda w: length(w) > 0)"


def ad_marker(x: str) -> str:
    return "(" + " OR ".join(f"contains({x}, {lit(m)})" for m in T.AD_MARKERS) + ")"


def factor(n: str, min_tokens: int = T.MIN_QUERY_TOKENS, mult: int = T.QUERY_REPEAT) -> str:
    parts = [f"WHEN {n} <= 0 THEN 1", f"WHEN {n} >= {min_tokens} THEN 1"]
    f = mult
    while f < min_tokens:
        parts.append(f"WHEN {n} * {f} >= {min_tokens} THEN {f}")
        f *= mult
    return "CASE " + " ".join(parts) + f" ELSE {f} END"


def hash_bucket(id_col: str, line_col: str, seed: int = 42) -> str:
    return (f"(('0x' || substr(md5(concat_ws('|', CAST({id_col} AS VARCHAR), {line_col}, '{seed}')), 1, 8))"
            f"::BIGINT)")


SONGS = """songs AS (
  SELECT doc_id AS id, array_to_string(string_split(text, ' ')[1:3], ' ') AS name,
         concat_ws(',', lang, source) AS artist, CAST(doc_id % 100 AS INTEGER) AS popularity,
         CAST(DATE '2024-02-23' + CASE WHEN doc_id % 10 = 9 THEN 1 ELSE 0 END AS DATE) AS add_date, n_chars
  FROM documents)"""

DOCS = f"""docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, array_to_string(string_split(text, ' ')[1:3], ' ') AS name,
         concat_ws(',', lang, source) AS artist, CAST(doc_id % 100 AS VARCHAR) AS popularity,
         {", ".join(f"CAST(n_chars % {i + 2} AS VARCHAR) AS {c}" for i, c in enumerate(FLOAT_COLUMNS[1:]))},
         CASE WHEN doc_id % 7 = 0 THEN NULL WHEN doc_id % 11 = 0 THEN [] ELSE
           list_transform(string_split(text, chr(10)), lambda x, i: {{'content': CASE WHEN (i - 1) % 13 <> 12 THEN x END}}) END AS tweets
  FROM documents)"""

LINES = """lines AS (
  SELECT doc_id AS id, s[1] AS line, s[2] AS pos
  FROM (SELECT doc_id, unnest(list_zip(string_split(text, chr(10)),
                                      range(0, len(string_split(text, chr(10)))))) AS s FROM documents)),
all_lines AS (SELECT id, line AS tweet_line FROM lines),
posts AS (SELECT id, line AS tweet_line FROM lines WHERE pos % 2 = 0),
verses AS (SELECT id, line AS lyric_line FROM lines WHERE pos % 2 = 1)"""

CLEAN = f"""pc_dedup AS (SELECT DISTINCT id, tweet_line FROM posts WHERE tweet_line IS NOT NULL),
pc_kept AS (
  SELECT id, tweet_line, CAST(len({words('tweet_line')}) AS INTEGER) AS word_count FROM pc_dedup
  WHERE len({words('tweet_line')}) > 10 AND NOT {ad_marker('tweet_line')}),
posts_clean AS (SELECT * FROM pc_kept WHERE id IN (SELECT id FROM pc_kept GROUP BY id HAVING count(*) > 10)),
vc_dedup AS (SELECT DISTINCT id, lyric_line FROM verses WHERE lyric_line IS NOT NULL),
verses_clean AS (SELECT id, lyric_line FROM vc_dedup WHERE len(list_distinct({words('lyric_line')})) > 1)"""

MODEL = f"""test_p AS (SELECT id, tweet_line FROM posts_clean WHERE {hash_bucket('id', 'tweet_line')} < 429496730),
train_p AS (SELECT id, tweet_line FROM posts_clean WHERE {hash_bucket('id', 'tweet_line')} >= 429496730),
train_v AS (SELECT id, lyric_line FROM verses_clean WHERE {hash_bucket('id', 'lyric_line')} >= 429496730),
both_ids AS (SELECT DISTINCT id FROM train_p INTERSECT SELECT DISTINCT id FROM train_v),
occ AS (SELECT id, unnest({tokens('line')}) AS term
        FROM (SELECT id, tweet_line AS line FROM train_p UNION ALL SELECT id, lyric_line AS line FROM train_v)),
tf AS (SELECT id, term, count(*) AS tf FROM occ WHERE id IN (SELECT id FROM both_ids) GROUP BY id, term),
idf AS (SELECT term, count(*) AS df,
               ln(((SELECT count(DISTINCT id) FROM tf) + 1.0) / (count(*) + 1.0)) AS idf
        FROM tf GROUP BY term),
postings AS (SELECT tf.id, tf.term, tf.tf, idf.idf, tf.tf * idf.idf AS w FROM tf JOIN idf USING (term))"""

TESTQ = f"""tq AS (SELECT id AS query_song, tweet_line AS query_line FROM test_p
       WHERE tweet_line IS NOT NULL AND length(replace(tweet_line, ' ', '')) > 1),
qocc AS (SELECT query_song, query_line, unnest({tokens('query_line')}) AS term FROM tq),
qn AS (SELECT query_song, query_line, count(*) AS n FROM qocc GROUP BY query_song, query_line),
qtf AS (SELECT o.query_song, o.query_line, o.term, count(*) * max({factor('qn.n')}) AS qtf
        FROM qocc o JOIN qn USING (query_song, query_line) GROUP BY o.query_song, o.query_line, o.term),
sc AS (SELECT q.query_song, q.query_line, p.id, sum(q.qtf * p.w) AS score
       FROM qtf q JOIN postings p USING (term) WHERE p.w <> 0 GROUP BY q.query_song, q.query_line, p.id),
allsc AS (SELECT tq.query_song, tq.query_line, c.id, coalesce(sc.score, 0.0) AS score
  FROM tq CROSS JOIN (SELECT DISTINCT id FROM postings) c
  LEFT JOIN sc ON sc.query_song = tq.query_song AND sc.query_line = tq.query_line AND sc.id = c.id),
best AS (SELECT *, row_number() OVER (PARTITION BY query_song, query_line
                                      ORDER BY round(score, 9) DESC, id ASC) AS rank
         FROM allsc QUALIFY rank <= {{k}})"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def _q(body: str, *ctes: str) -> str:
    return with_(*ctes) + body


def _one_query(text: str, k: int) -> str:
    return _q(f"""SELECT CAST(rank AS INTEGER) AS rank, best.id, songs.name, {R_SCORE} AS score
FROM best LEFT JOIN songs USING (id)""",
              SONGS, LINES, CLEAN, MODEL,
              f"qocc AS (SELECT unnest({tokens(lit(text))}) AS term)",
              "qn AS (SELECT count(*) AS n FROM qocc)",
              f"qtf AS (SELECT term, count(*) * (SELECT {factor('n')} FROM qn) AS qtf FROM qocc GROUP BY term)",
              "sc AS (SELECT p.id, sum(q.qtf * p.w) AS score FROM qtf q JOIN postings p USING (term) "
              "WHERE p.w <> 0 GROUP BY p.id)",
              "allsc AS (SELECT c.id, coalesce(sc.score, 0.0) AS score FROM (SELECT DISTINCT id FROM postings) c "
              "LEFT JOIN sc USING (id))",
              f"best AS (SELECT id, score, row_number() OVER (ORDER BY round(score, 9) DESC, id ASC) AS rank "
              f"FROM allsc QUALIFY rank <= {k})")


SQL = {
    "tokens_len_stop": _q(f"""SELECT id, tweet_line, CAST(len({tokens('tweet_line')}) AS INTEGER) AS n_tokens,
       array_to_string({tokens('tweet_line')}, ' ') AS tokens FROM all_lines""", LINES),
    "word_count": _q(f"SELECT id, tweet_line, CAST(len({words('tweet_line')}) AS INTEGER) AS word_count FROM all_lines",
                     LINES),
    "distinct_word_count": _q(f"""SELECT id, tweet_line,
       CAST(len(list_distinct({words('tweet_line')})) AS INTEGER) AS distinct_word_count FROM all_lines""", LINES),
    "strip_emoji": f"SELECT doc_id, regexp_replace(text, {EMOJI}, '', 'g') AS text_out FROM documents",
    "strip_symbols": f"SELECT doc_id, regexp_replace(text, {PUNCT}, ' ', 'g') AS text_out FROM documents",
    "remove_own_words": _q(f"""SELECT p.id, p.tweet_line,
       list_reduce(list_concat({tokens('s.name')}, {tokens('s.artist')}),
                   lambda acc, w: replace(acc, w, ''), p.tweet_line) AS line_out
FROM all_lines p JOIN songs s USING (id)""", SONGS, LINES),
    "posts_clean": _q("SELECT id, tweet_line, word_count FROM posts_clean", LINES, CLEAN),
    "songs_min_posts": _q("SELECT id, count(*) AS n_posts FROM posts_clean GROUP BY id", LINES, CLEAN),
    "verses_clean": _q("SELECT id, lyric_line FROM verses_clean", LINES, CLEAN),
    "clean_report": _q("""SELECT frame, before, after, {R_PCT} AS pct_removed FROM (
  SELECT 'posts' AS frame, (SELECT count(*) FROM posts) AS before, (SELECT count(*) FROM posts_clean) AS after
  UNION ALL
  SELECT 'verses', (SELECT count(*) FROM verses), (SELECT count(*) FROM verses_clean))""", LINES, CLEAN),
    "songs_without_posts": _q("SELECT id, name FROM songs WHERE id NOT IN (SELECT id FROM posts_clean)",
                              SONGS, LINES, CLEAN),
    "documents_without_posts": _q("""SELECT id, name, tweets IS NULL AS missing FROM docs
WHERE coalesce(len(tweets), 0) = 0""", DOCS),
    "document_lines": _q(f"""SELECT id,
       list_reduce(list_concat({tokens('name')}, {tokens('artist')}), lambda acc, w: replace(acc, w, ''),
                   regexp_replace(regexp_replace(t.content, {EMOJI}, '', 'g'), {PUNCT}, ' ', 'g')) AS tweet_line
FROM (SELECT id, name, artist, unnest(tweets) AS t FROM docs) WHERE t.content IS NOT NULL""", DOCS),
    "document_features": _q("SELECT id, name, " + ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in FLOAT_COLUMNS)
                            + " FROM docs WHERE len(tweets) > 0", DOCS),
    "document_total": _q("SELECT count(*) AS n_songs, CAST(sum(len(tweets)) AS BIGINT) AS n_posts FROM docs "
                         "WHERE tweets IS NOT NULL", DOCS),
    "post_total": _q("""SELECT count(*) AS n_songs, CAST(sum(n) AS BIGINT) AS n_posts
FROM (SELECT id, count(*) AS n FROM all_lines GROUP BY id)""", LINES),
    "prepare_lines": _q(f"""SELECT p.id,
       list_reduce(list_concat({tokens('s.name')}, {tokens('s.artist')}),
                   lambda acc, w: replace(acc, w, ''),
                   regexp_replace(regexp_replace(p.tweet_line, {EMOJI}, '', 'g'), {PUNCT}, ' ', 'g')) AS tweet_line
FROM all_lines p JOIN songs s USING (id) WHERE p.tweet_line IS NOT NULL""", SONGS, LINES),
    "split_hash": _q(f"""SELECT id, tweet_line,
       CASE WHEN {hash_bucket('id', 'tweet_line')} < 429496730 THEN 'test' ELSE 'train' END AS part
FROM posts_clean""", LINES, CLEAN),
    "split_exact": _q("""SELECT id, tweet_line,
       CASE WHEN row_number() OVER (PARTITION BY id ORDER BY
                   substr(md5(concat_ws('|', CAST(id AS VARCHAR), tweet_line, '42')), 1, 16), tweet_line) - 1
                 < ceil(round(0.1 * count(*) OVER (PARTITION BY id), 9)) THEN 'test' ELSE 'train' END AS part
FROM posts_clean""", LINES, CLEAN),
    "corpus_terms": _q("SELECT id, term, tf FROM tf", LINES, CLEAN, MODEL),
    "doc_freq_idf": _q("SELECT term, df, {R_IDF} AS idf FROM idf", LINES, CLEAN, MODEL),
    "tfidf_exact": _q("SELECT id, term, tf, {R_W} AS w FROM postings", LINES, CLEAN, MODEL),
    "recommend_one": _one_query(CAT.SMOKE_TEXT, CAT.TOP_K),
    "recommend_benchmark": _q(f"""SELECT best.item_id, CAST(rank AS INTEGER) AS rank, best.id, songs.name,
       {R_SCORE} AS score FROM best LEFT JOIN songs USING (id)""",
                              SONGS, LINES, CLEAN, MODEL,
                              f"qocc AS (SELECT item_id, unnest({tokens('text')}) AS term FROM benchmark)",
                              "qn AS (SELECT item_id, count(*) AS n FROM qocc GROUP BY item_id)",
                              f"qtf AS (SELECT o.item_id, o.term, count(*) * max({factor('qn.n')}) AS qtf "
                              "FROM qocc o JOIN qn USING (item_id) GROUP BY o.item_id, o.term)",
                              "sc AS (SELECT q.item_id, p.id, sum(q.qtf * p.w) AS score FROM qtf q "
                              "JOIN postings p USING (term) WHERE p.w <> 0 GROUP BY q.item_id, p.id)",
                              "allsc AS (SELECT b.item_id, c.id, coalesce(sc.score, 0.0) AS score FROM benchmark b "
                              "CROSS JOIN (SELECT DISTINCT id FROM postings) c "
                              "LEFT JOIN sc ON sc.item_id = b.item_id AND sc.id = c.id)",
                              f"best AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) "
                              f"DESC, id ASC) AS rank FROM allsc QUALIFY rank <= {CAT.TOP_K})"),
    "recommend_batch": _q("""SELECT best.query_song, best.query_line, CAST(rank AS INTEGER) AS rank, best.id, songs.name,
       {R_SCORE} AS score FROM best LEFT JOIN songs USING (id)""",
                          SONGS, LINES, CLEAN, MODEL, TESTQ.replace("{k}", str(CAT.TOP_K))),
    "target_rank": _q(f"""SELECT tq.query_song AS id, tq.query_line AS tweet_line,
       CAST(coalesce(b.rank - 1, {T.MISSING_RANK}) AS INTEGER) AS rank
FROM tq LEFT JOIN best b ON b.query_song = tq.query_song AND b.query_line = tq.query_line AND b.id = tq.query_song""",
                      LINES, CLEAN, MODEL, TESTQ.replace("{k}", str(E.LIST_SIZE))),
    "topk_accuracy": _q(f"""SELECT count(*) AS n_tests, CAST(sum(CASE WHEN rank <= {E.HIT_RANK} THEN 1 ELSE 0 END) AS BIGINT) AS n_hits,
       {R_ACC} AS accuracy
FROM (SELECT tq.query_song, CAST(coalesce(b.rank - 1, {T.MISSING_RANK}) AS INTEGER) AS rank
      FROM tq LEFT JOIN best b ON b.query_song = tq.query_song AND b.query_line = tq.query_line
                               AND b.id = tq.query_song)""",
                        LINES, CLEAN, MODEL, TESTQ.replace("{k}", str(E.LIST_SIZE))),
}


# --- collection and consolidation -------------------------------------------

RUN = f"DATE '{CAT.RUN_DATE}'"

TRACKS = """tracks AS (
  SELECT p_partkey, p_name AS name, CAST(p_partkey AS VARCHAR) AS id, p_size * 2 AS popularity,
         concat_ws(',', p_brand, 'The ' || p_type, concat_ws(' ', p_type, p_name)) AS artist FROM part),
known AS (SELECT p_name AS name, CAST(p_partkey AS VARCHAR) AS id FROM part WHERE p_partkey % 400 = 0)"""

AUDIO = """audio AS (
  SELECT CAST(p_partkey AS VARCHAR) AS id, CAST(p_size AS DOUBLE) / 50 AS danceability,
         CAST(p_partkey % 7 AS DOUBLE) / 7.0 AS energy, CAST(p_partkey % 12 AS DOUBLE) AS key,
         -p_retailprice / 100 AS loudness, CAST(p_partkey % 2 AS DOUBLE) AS mode,
         CAST(p_size AS DOUBLE) / 100 AS speechiness, CAST(p_partkey % 11 AS DOUBLE) / 11.0 AS acousticness,
         CAST(p_partkey % 13 AS DOUBLE) / 13.0 AS instrumentalness, CAST(p_partkey % 17 AS DOUBLE) / 17.0 AS liveness,
         CAST(p_partkey % 19 AS DOUBLE) / 19.0 AS valence, p_retailprice / 10 AS tempo,
         'audio_features' AS type, p_size * 6000 AS duration_ms, 4 AS time_signature FROM part)"""

FLAT = """flat AS (
  SELECT 'song' || CAST(user_id AS VARCHAR) AS song, event_id AS seq, CAST(event_id // 2 AS VARCHAR) AS tweet_id,
         ts AS created, CAST(json_extract_string(props, '$.k') AS INTEGER) % 3 AS retweeted,
         concat_ws(' ', event_type, props) AS content, event_type AS hashtags, 1 AS n_urls,
         CAST(user_id AS VARCHAR) AS user_id, 'user' || CAST(user_id AS VARCHAR) AS username,
         CAST(trunc(value) AS INTEGER) AS num_followers, value > 50 AS geo_enabled,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0 THEN value END AS long,
         CASE WHEN CAST(json_extract_string(props, '$.k') AS INTEGER) % 2 = 0
              THEN CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS lat,
         CASE WHEN event_type = 'error' THEN 'fr' ELSE 'en' END AS lang
  FROM events),
songs_a AS (SELECT DISTINCT user_id AS id, 'song' || CAST(user_id AS VARCHAR) AS name FROM events WHERE user_id % 10 <> 0),
sp AS (SELECT name, min(id) AS song_id FROM songs_a GROUP BY name),
joined AS (SELECT f.*, sp.song_id FROM flat f JOIN sp ON f.song = sp.name)"""


def trim_title_sql(x: str) -> str:
    s2 = f"substr({x}, 2)"
    p = f"least(nullif(strpos({s2}, '-'), 0), nullif(strpos({s2}, '('), 0))"
    return f"CASE WHEN {p} IS NULL THEN {x} ELSE substr({x}, 1, {p} - 1) END"


def search_string_sql(song: str, artist: str) -> str:
    first = "string_split(a, ' ')[1]"
    who = (f"CASE WHEN len(string_split(a, ' ')) > 1 AND NOT list_contains({STOP}, lower({first})) "
           f"THEN {first} ELSE a END")
    return (f"array_to_string(list_transform(string_split({artist}, ','), "
            f"lambda a: '(\"' || {song} || '\" AND \"' || {who} || '\")'), ' OR ')")


POST_OUT = """SELECT song, tweet_id, CAST(created AS VARCHAR) AS created, retweeted, content, hashtags, n_urls,
       user_id, username, num_followers, geo_enabled, long, lat"""

SQL.update({
    "features_cast": _q("SELECT id, tracks.name, "
                        + ", ".join(f"CAST({c} AS FLOAT) AS {c}" for c in FLOAT_COLUMNS)
                        + " FROM tracks JOIN audio USING (id)", TRACKS, AUDIO),
    "split_sample_by": _q(f"""SELECT id, tweet_line,
       CASE WHEN {hash_bucket('id', 'tweet_line', 'sample42')} < 429496730 THEN 'test' ELSE 'train' END AS part
FROM posts_clean""", LINES, CLEAN),
    "song_intake": _q(f"""SELECT f.name, f.id, f.artist, f.popularity, CAST(dayofyear({RUN}) AS INTEGER) AS add_day,
       {RUN} AS add_date, a.danceability, a.energy, a.key, a.loudness, a.mode, a.speechiness, a.acousticness,
       a.instrumentalness, a.liveness, a.valence, a.tempo, a.type, a.duration_ms, a.time_signature
FROM (SELECT * FROM tracks WHERE popularity >= 60 AND name NOT IN (SELECT name FROM known)
      QUALIFY row_number() OVER (PARTITION BY name ORDER BY p_partkey) = 1) f
LEFT JOIN audio a USING (id)""", TRACKS, AUDIO),
    "insert_if_absent": _q("""SELECT id AS _id, name, artist, popularity FROM tracks
WHERE id NOT IN (SELECT id FROM known)""", TRACKS),
    "day_plan": _q(f"""SELECT name, artist, 'slice' AS source FROM (
  SELECT name, artist, row_number() OVER (ORDER BY add_date, id) - 1 AS pos FROM songs)
WHERE pos >= (SELECT i * step FROM st) AND pos < (SELECT (i + 1) * step FROM st)
UNION ALL
SELECT name, artist, 'new' AS source FROM songs WHERE add_date = {RUN}""",
                   SONGS,
                   "fd AS (SELECT min(add_date) AS d FROM songs)",
                   f"st AS (SELECT datediff('day', (SELECT d FROM fd), {RUN}) AS i, "
                   "(SELECT count(*) FROM songs WHERE add_date = (SELECT d FROM fd)) // 7 AS step)"),
    "search_string": _q(f"""SELECT id, name, artist, {trim_title_sql('name')} AS song_q,
       {search_string_sql(trim_title_sql('name'), 'artist')} AS query FROM tracks""", TRACKS),
    "title_trim": f"SELECT doc_id, {trim_title_sql('text')} AS title_q FROM documents",
    "select_posts": _q(POST_OUT + f"""
FROM (SELECT * FROM flat WHERE lang = 'en' AND created < TIMESTAMP '{CAT.END_DATE}'
      QUALIFY row_number() OVER (PARTITION BY song ORDER BY created DESC, seq DESC) <= {CAT.POSTS_PER_SEARCH})
WHERE retweeted = 0""", FLAT),
    "attach_posts": _q("""SELECT song_id, song, tweet_id, CAST(created AS VARCHAR) AS created, seq FROM (
  SELECT * FROM joined QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY song, seq) = 1)
WHERE tweet_id NOT IN (SELECT CAST(event_id // 2 AS VARCHAR) FROM events WHERE event_id < 1000)""", FLAT),
    "attach_posts_all": _q("SELECT song_id, song, tweet_id, CAST(created AS VARCHAR) AS created, seq FROM joined",
                           FLAT),
    "rejected_posts": _q("SELECT song, tweet_id, seq FROM flat WHERE song NOT IN (SELECT name FROM songs_a)", FLAT),
    "fix_names": _q("""SELECT id, CASE WHEN id = min(id) OVER (PARTITION BY name) AND length(short) > 0 THEN short ELSE name END AS name
FROM (SELECT id, name, regexp_replace(name, '[^\\p{L}\\p{N}]+$', '') AS short FROM songs)""", SONGS),
    "blob_names": _q(f"""SELECT id, '{CAT.RUN_DATE}/' || name || CASE WHEN popularity % 4 = 0 THEN '.csv' ELSE '.csv.csv' END AS blob,
       name AS song FROM tracks""", TRACKS),
})


# Queries that write and read back tables equal one of the queries above.
SQL["csv_round_trip"] = _q(POST_OUT + f"""
FROM flat WHERE lang = 'en' AND created < TIMESTAMP '{CAT.END_DATE}' AND retweeted = 0""", FLAT)
SQL["csv_line_breaks"] = "SELECT doc_id, text, source FROM documents"
SQL["ingest_batch"] = _q("""SELECT * FROM early UNION ALL
SELECT song_id, song, tweet_id, CAST(created AS VARCHAR) AS created, seq FROM (
  SELECT * FROM joined QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY song, seq) = 1)
WHERE tweet_id NOT IN (SELECT tweet_id FROM early)""", FLAT, """early AS (
  SELECT song_id, song, tweet_id, CAST(created AS VARCHAR) AS created, seq FROM joined WHERE seq < 1000 AND song_id % 3 = 0
  QUALIFY row_number() OVER (PARTITION BY tweet_id ORDER BY song, seq) = 1)""")
SQL["stream_intake"] = SQL["attach_posts"].replace("ORDER BY song, seq", "ORDER BY seq % 2, song, seq")  # the first drop wins
SQL["recommend_from"] = SQL["recommend_bounded"] = SQL["recommend_benchmark"]
SQL["path_to_song"] = _q(f"""SELECT song, song AS song_from_path, tweet_id, '{CAT.RUN_DATE}' AS date
FROM flat WHERE lang = 'en' AND created < TIMESTAMP '{CAT.END_DATE}' AND retweeted = 0""", FLAT)
SQL["intake_snapshot"] = _q(f"""SELECT f.name, f.id, f.artist, f.popularity, CAST(dayofyear({RUN}) AS INTEGER) AS add_day,
       {RUN} AS add_date, a.danceability, a.energy, a.key, a.loudness, a.mode, a.speechiness, a.acousticness,
       a.instrumentalness, a.liveness, a.valence, a.tempo, a.type, a.duration_ms, a.time_signature
FROM (SELECT * FROM tracks WHERE popularity >= 60
      QUALIFY row_number() OVER (PARTITION BY name ORDER BY p_partkey) = 1) f
LEFT JOIN audio a USING (id)""", TRACKS, AUDIO)
def plain(x: str) -> str:
    """Words of a text with one space before and after each."""
    return f"(' ' || trim(regexp_replace(lower({x}), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' ')"


_WHO = (f"CASE WHEN len(string_split(a, ' ')) > 1 AND NOT list_contains({STOP}, lower(string_split(a, ' ')[1])) "
        "THEN string_split(a, ' ')[1] ELSE a END")
SQL["daily_job"] = _q(f"""SELECT song, tweet_id, CAST(created AS VARCHAR) AS created, retweeted, content
FROM (SELECT DISTINCT plan.name AS song, p.* FROM plan JOIN landed p ON contains({plain('p.content')}, {plain('title')})
      AND contains({plain('p.content')}, {plain('who')}))
WHERE lang = 'en' AND created < TIMESTAMP '{CAT.END_DATE}' AND retweeted = 0""", TRACKS, FLAT,
    """landed AS (SELECT seq, tweet_id, created, retweeted, lang, e.event_type || ' heard: ' || p_name || ' ' || chr(10) || '- by '
    || CASE WHEN CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 4 = 0 THEN p_brand
            WHEN CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 4 = 1 THEN 'the ' || p_type
            WHEN CAST(json_extract_string(e.props, '$.k') AS INTEGER) % 4 = 2 THEN string_split(p_type, ' ')[1] ELSE 'nobody' END
    || ' !' AS content
  FROM flat JOIN events e ON e.event_id = seq JOIN part ON p_partkey = e.event_id // 5 + 1)""",
    """stored AS (SELECT name, id, artist FROM tracks WHERE popularity >= 60 AND p_partkey % 3 = 0
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY p_partkey) = 1)""",
    """fresh AS (SELECT name, id, artist FROM tracks WHERE popularity >= 60 AND name NOT IN (SELECT name FROM stored)
  QUALIFY row_number() OVER (PARTITION BY name ORDER BY p_partkey) = 1)""",
    f"""plan AS (SELECT name, {trim_title_sql('name')} AS title, {_WHO} AS who FROM (
  SELECT name, unnest(string_split(artist, ',')) AS a FROM (
    SELECT name, artist FROM stored QUALIFY (row_number() OVER (ORDER BY id) - 1) // ((SELECT count(*) FROM stored) // 7) = 1
    UNION ALL SELECT name, artist FROM fresh)))""")


for _k, _v in list(SQL.items()):
    for _name, _val in (("{R_SCORE}", R_SCORE), ("{R_IDF}", R_IDF), ("{R_W}", R_W), ("{R_PCT}", R_PCT),
                        ("{R_ACC}", R_ACC)):
        _v = _v.replace(_name, _val)
    SQL[_k] = _v


SQL["topk_accuracy_code"] = _q(f"""SELECT count(*) AS n_tests,
       CAST(sum(CASE WHEN rank <= {CAT.CODE_HIT_RANK} THEN 1 ELSE 0 END) AS BIGINT) AS n_hits,
       {rnd(f"avg(CASE WHEN rank <= {CAT.CODE_HIT_RANK} THEN 1.0 ELSE 0.0 END)")} AS accuracy
FROM (SELECT tq.query_song, CAST(coalesce(b.rank - 1, {T.MISSING_RANK}) AS INTEGER) AS rank
      FROM tq LEFT JOIN best b ON b.query_song = tq.query_song AND b.query_line = tq.query_line
                               AND b.id = tq.query_song)""",
                               LINES, CLEAN, MODEL, TESTQ.replace("{k}", str(CAT.CODE_LIST_SIZE)))


SQL["accuracy_at_10_15"] = _q(f"""SELECT count(*) AS n_tests,
       CAST(sum(CASE WHEN rank < 10 THEN 1 ELSE 0 END) AS BIGINT) AS hits_at_10,
       {rnd("avg(CASE WHEN rank < 10 THEN 1.0 ELSE 0.0 END)")} AS accuracy_at_10,
       CAST(sum(CASE WHEN rank < 15 THEN 1 ELSE 0 END) AS BIGINT) AS hits_at_15,
       {rnd("avg(CASE WHEN rank < 15 THEN 1.0 ELSE 0.0 END)")} AS accuracy_at_15
FROM (SELECT tq.query_song, CAST(coalesce(b.rank - 1, {T.MISSING_RANK}) AS INTEGER) AS rank
      FROM tq LEFT JOIN best b ON b.query_song = tq.query_song AND b.query_line = tq.query_line
                               AND b.id = tq.query_song)""",
                              LINES, CLEAN, MODEL, TESTQ.replace("{k}", "15"))

SQL["sample_tests"] = _q(f"""SELECT id, tweet_line FROM test_p
WHERE tweet_line IS NOT NULL AND length(replace(tweet_line, ' ', '')) > 1
ORDER BY md5(concat_ws('|', CAST(id AS VARCHAR), tweet_line)), id, tweet_line LIMIT {CAT.SAMPLE_TESTS}""", LINES, CLEAN, MODEL)

SQL["posts_clean_one_scan"] = SQL["posts_clean"]
SQL["verses_clean_one_scan"] = SQL["verses_clean"]
SQL |= oracle_html.SQL


# --- stems and hash buckets ----------------------------------------------------

VOCABULARY = f"vocabulary AS (SELECT DISTINCT unnest({tokens('tweet_line')}) AS term FROM all_lines)"
SQL["stem_vocab"] = _q("SELECT term, stem FROM stems", LINES, VOCABULARY, OT.stems("vocabulary"))
SQL["lemma_stem_vocab"] = _q("""SELECT v.term, coalesce(lemma, v.term) AS lemma, stem
FROM vocabulary v LEFT JOIN lemmas ON word = v.term JOIN stems s ON s.term = coalesce(lemma, v.term)""",
                             LINES, VOCABULARY, "dictionary AS (SELECT term AS word FROM vocabulary)",
                             OT.lemmas("vocabulary", "dictionary"),
                             "bases AS (SELECT DISTINCT coalesce(lemma, v.term) AS term FROM vocabulary v LEFT JOIN lemmas ON word = v.term)",
                             OT.stems("bases"))

#: The model over another kind of term: ``mapped`` (term, u) gives it.
MAPPED = """utf AS (SELECT id, u, CAST(sum(tf) AS BIGINT) AS tf FROM tf JOIN mapped USING (term) GROUP BY id, u),
uidf AS (SELECT u, ln(((SELECT count(DISTINCT id) FROM utf) + 1.0) / (count(*) + 1.0)) AS idf FROM utf GROUP BY u),
upost AS (SELECT id, u, tf, tf * idf AS w FROM utf JOIN uidf USING (u))"""
BENCH_TERMS = f"""bocc AS (SELECT item_id, unnest({tokens('text')}) AS term FROM benchmark),
bn AS (SELECT item_id, count(*) AS n FROM bocc GROUP BY item_id)"""
BENCH_BEST = f"""bq AS (SELECT o.item_id, u, count(*) * max({factor('bn.n')}) AS qtf FROM bocc o JOIN bn USING (item_id)
  JOIN mapped USING (term) GROUP BY o.item_id, u),
bsc AS (SELECT item_id, id, sum(qtf * w) AS score FROM bq JOIN upost USING (u) GROUP BY item_id, id),
best AS (SELECT b.item_id, c.id, coalesce(bsc.score, 0.0) AS score, row_number() OVER (
    PARTITION BY b.item_id ORDER BY round(coalesce(bsc.score, 0.0), 9) DESC, c.id) AS rank
  FROM benchmark b CROSS JOIN (SELECT DISTINCT id FROM upost) c
  LEFT JOIN bsc ON bsc.item_id = b.item_id AND bsc.id = c.id QUALIFY rank <= {CAT.TOP_K})"""
BENCH_OUT = f"""SELECT best.item_id, CAST(rank AS INTEGER) AS rank, best.id, songs.name, {R_SCORE} AS score
FROM best LEFT JOIN songs USING (id)"""
SQL["recommend_stemmed"] = _q(BENCH_OUT, SONGS, LINES, CLEAN, MODEL, BENCH_TERMS,
                              "both_terms AS (SELECT term FROM tf UNION SELECT term FROM bocc)", OT.stems("both_terms"),
                              "mapped AS (SELECT term, stem AS u FROM stems)", MAPPED, BENCH_BEST)
SQL["recommend_hashed"] = _q(BENCH_OUT, SONGS, LINES, CLEAN, MODEL, BENCH_TERMS,
                             "both_terms AS (SELECT term FROM tf UNION SELECT term FROM bocc)", OT.buckets("both_terms"),
                             "mapped AS (SELECT term, h AS u FROM buckets)", MAPPED, BENCH_BEST)
SQL["tfidf_hashed"] = _q(f"SELECT id, u AS h, tf, {R_W} AS w FROM upost", LINES, CLEAN, MODEL, OT.buckets("tf"),
                         "mapped AS (SELECT term, h AS u FROM buckets)", MAPPED)
SQL["topk_accuracy_hashed"] = _q(f"""SELECT count(*) AS n_tests,
       CAST(sum(CASE WHEN rank <= {CAT.CODE_HIT_RANK} THEN 1 ELSE 0 END) AS BIGINT) AS n_hits,
       {rnd(f"avg(CASE WHEN rank <= {CAT.CODE_HIT_RANK} THEN 1.0 ELSE 0.0 END)")} AS accuracy
FROM (SELECT tq.query_song, CAST(coalesce(b.rank - 1, {T.MISSING_RANK}) AS INTEGER) AS rank
      FROM tq LEFT JOIN best b ON b.query_song = tq.query_song AND b.query_line = tq.query_line AND b.id = tq.query_song)""",
    LINES, CLEAN, MODEL, f"""tq AS (SELECT id AS query_song, tweet_line AS query_line FROM test_p
  WHERE tweet_line IS NOT NULL AND length(replace(tweet_line, ' ', '')) > 1),
qocc AS (SELECT query_song, query_line, unnest({tokens('query_line')}) AS term FROM tq),
qn AS (SELECT query_song, query_line, count(*) AS n FROM qocc GROUP BY query_song, query_line),
both_terms AS (SELECT term FROM tf UNION SELECT term FROM qocc)""", OT.buckets("both_terms"),
    "mapped AS (SELECT term, h AS u FROM buckets)", MAPPED, f"""qu AS (SELECT o.query_song, o.query_line, u, count(*) * max({factor('qn.n')}) AS qtf
  FROM qocc o JOIN qn USING (query_song, query_line) JOIN mapped USING (term) GROUP BY o.query_song, o.query_line, u),
sc AS (SELECT query_song, query_line, id, sum(qtf * w) AS score FROM qu JOIN upost USING (u) GROUP BY query_song, query_line, id),
best AS (SELECT tq.query_song, tq.query_line, c.id, row_number() OVER (PARTITION BY tq.query_song, tq.query_line
    ORDER BY round(coalesce(sc.score, 0.0), 9) DESC, c.id) AS rank
  FROM tq CROSS JOIN (SELECT DISTINCT id FROM upost) c
  LEFT JOIN sc ON sc.query_song = tq.query_song AND sc.query_line = tq.query_line AND sc.id = c.id
  QUALIFY rank <= {CAT.CODE_LIST_SIZE})""")
