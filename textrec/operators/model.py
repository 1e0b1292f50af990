"""Per-song term corpus and TF-IDF weights.

The corpus is kept as postings ``(id, term, tf)`` rather than one huge
string or array per song: tokenising each line and counting ``(id, term)``
gives the same counts as tokenising the space-joined corpus (the tokenizer
splits on single spaces), but it is a partial aggregate, so a song holding a
third of all lines never has its text gathered into one row or one task.
"""

from __future__ import annotations

from pyspark.ml.feature import HashingTF
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from textrec.functions import text as T

NUM_FEATURES = 100000


def line_terms(lines: DataFrame, line_col: str, id_col: str = "id",
               stop_words=T.STOP_WORDS) -> DataFrame:
    """(id, term) for every token occurrence of every line.

    The line is split natively and exploded first; length and stop-word
    tests then run as ordinary code-generated row predicates."""
    # explode_outer: a plain explode makes Catalyst add size(array) > 0 below
    # the generator, which would run the regex a second time
    words = lines.select(id_col, F.explode_outer(T.pieces(line_col)).alias("term"))
    return words.where(F.col("term").isNotNull() & T.is_token("term", stop_words))


def term_counts(lines: DataFrame, line_col: str, id_col: str = "id",
                stop_words=T.STOP_WORDS, stem_map: DataFrame | None = None) -> DataFrame:
    """A13 exact-term variant: (id, term, tf)."""
    occ = line_terms(lines, line_col, id_col, stop_words)
    tf = occ.groupBy(id_col, "term").agg(F.count("*").alias("tf"))
    if stem_map is not None:
        tf = apply_stems(tf, stem_map, id_col)
    return tf


def apply_stems(tf: DataFrame, stem_map: DataFrame, id_col: str = "id") -> DataFrame:
    """Replace each term by its stem and re-add counts (T12 applied to postings)."""
    return (tf.join(stem_map, "term", "left")
              .select(id_col, F.coalesce("stem", "term").alias("term"), "tf")
              .groupBy(id_col, "term").agg(F.sum("tf").alias("tf")))


def corpus_terms(post_lines: DataFrame, verse_lines: DataFrame, id_col: str = "id",
                 post_col: str = "tweet_line", verse_col: str = "lyric_line",
                 stop_words=T.STOP_WORDS, stem_map: DataFrame | None = None) -> DataFrame:
    """The per-song corpus of posts and lyrics, as (id, term, tf).

    J1: only songs that have both post lines and lyric lines take part; the
    two corpora are concatenated (A2 + T22) by adding their term counts.  Lines of
    other songs are left out before they are split into terms; the ids are
    written first, so that the join knows their size."""
    from textrec.session import materialize
    both = materialize(post_lines.select(id_col).distinct()
                       .join(verse_lines.select(id_col).distinct(), id_col, "left_semi"), "songs-both")
    lines = (post_lines.select(id_col, F.col(post_col).alias("_line"))
             .unionByName(verse_lines.select(id_col, F.col(verse_col).alias("_line"))))
    return term_counts(lines.join(both, id_col, "left_semi"), "_line", id_col, stop_words, stem_map)


def fit_idf(tf: DataFrame, id_col: str = "id", term_col: str = "term") -> DataFrame:
    """A11 + M2: (term, df, idf) with idf = ln((m + 1) / (df + 1)), m = songs."""
    m = tf.select(F.count_distinct(id_col)).scalar()
    return (tf.groupBy(term_col).agg(F.count("*").alias("df"))
              .withColumn("idf", F.log((m + F.lit(1.0)) / (F.col("df") + F.lit(1.0)))))


def tfidf(tf: DataFrame, id_col: str = "id", term_col: str = "term",
          drop_zero: bool = False) -> DataFrame:
    """M3: postings (id, term, tf, idf, w = tf * idf).

    ``drop_zero`` removes postings whose weight is exactly 0 (terms in every
    song): they cannot change any score, and they are the longest lists."""
    idf = fit_idf(tf, id_col, term_col)
    # the terms are hashed, as sorting the postings by term costs more than the join
    # and a range exchange after it samples, that is, joins twice
    post = tf.join(idf.select(term_col, "idf").hint("shuffle_hash"), term_col, "inner").withColumn("w", F.col("tf") * F.col("idf"))
    if drop_zero:
        post = post.where(F.col("w") != 0)
    return post


# ---------------------------------------------------------------------------
# Hashed variant (M1): the bucket of each distinct term comes from Spark ML's
# HashingTF, so buckets equal what HashingTF.transform gives for the corpus.
# ---------------------------------------------------------------------------

def hash_terms(terms: DataFrame, term_col: str = "term", num_features: int = NUM_FEATURES,
               out_col: str = "h") -> DataFrame:
    """Adds the HashingTF bucket of a single term (JVM-side, no Python)."""
    htf = HashingTF(inputCol="_arr", outputCol="_vec", numFeatures=num_features)
    withArr = terms.withColumn("_arr", F.array(F.col(term_col)))
    return (htf.transform(withArr)
               .withColumn(out_col, F.unwrap_udt("_vec").indices[0])
               .drop("_arr", "_vec"))


def hashed_counts(tf: DataFrame, id_col: str = "id", num_features: int = NUM_FEATURES) -> DataFrame:
    """(id, h, tf): term counts folded into hash buckets.

    Hashing runs once per distinct term; the (term -> h) map is joined back
    and AQE picks broadcast only when its measured size allows."""
    vocab = hash_terms(tf.select("term").distinct(), num_features=num_features)
    return (tf.join(vocab, "term", "inner")
              .groupBy(id_col, "h").agg(F.sum("tf").alias("tf")))


def tfidf_hashed(tf: DataFrame, id_col: str = "id", num_features: int = NUM_FEATURES,
                 drop_zero: bool = False) -> DataFrame:
    """M1-M3 hashed: postings (id, h, tf, idf, w), equal to HashingTF + IDF."""
    return tfidf(hashed_counts(tf, id_col, num_features), id_col, "h", drop_zero)
