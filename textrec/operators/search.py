"""Search strings evaluated over landed posts.

A search string is one or more clauses joined by OR; a clause is a bracketed
list of quoted phrases joined by AND (T15).  A post matches a clause if every
phrase of it occurs in the post's words as consecutive words, at any position.
Words are maximal runs of letters and digits, lower-cased.

A clause is looked up by its rarest word, so a post is compared only with clauses
it may well match; common words in a title cost nothing as long as one word of
the clause is rarer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def words_of(c: Column) -> Column:
    return F.array_remove(F.split(F.regexp_replace(F.lower(c), r"[^\p{L}\p{N}]+", " "), " "), "")


def clauses(query: Column) -> Column:
    """array<array<string>>: the phrases of each clause of a search string."""
    inside = F.substring(query, F.lit(3), F.length(query) - 4)
    return F.transform(F.split(inside, r'"\) OR \("'), lambda c: F.split(c, '" AND "'))


def has_phrase(words: Column, phrase: Column) -> Column:
    """Whether ``phrase`` (an array of words) stands somewhere in ``words``."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(words) - F.size(phrase) + 1, F.lit(1)))
    return F.exists(starts, lambda i: F.slice(words, i, F.size(phrase)) == phrase)


def search(posts: DataFrame, queries: DataFrame, key: str, content: str = "content", query: str = "query") -> DataFrame:
    """All columns of ``queries`` with each post that matches: ``posts.*`` beside
    them, one row a (query row, post).  ``key`` identifies a post.  A phrase
    without a word asks for nothing; a clause without one matches nothing."""
    asked = queries.withColumn("_q", F.monotonically_increasing_id()) if "_q" not in queries.columns else queries
    from textrec.session import materialize
    asked = materialize(asked, "search-queries")       # numbers stay the same in all branches
    parts = (asked.select("_q", F.posexplode(clauses(F.col(query))).alias("_c", "_p"))
                  .select("_q", "_c", F.filter(F.transform("_p", words_of), lambda p: F.size(p) > 0).alias("_phrases"))
                  .where(F.size("_phrases") > 0))
    terms = parts.select("_q", "_c", F.explode(F.array_distinct(F.flatten("_phrases"))).alias("_w"))
    seen = posts.select(F.col(key).alias("_key"), F.explode(F.array_distinct(words_of(F.col(content)))).alias("_w"))
    known = seen.join(terms.select("_w").distinct(), "_w", "left_semi")
    counts = known.groupBy("_w").agg(F.count("*").alias("_df"))
    # a word that no post has gives its clause no posts
    rarest = (terms.join(counts, "_w", "left").groupBy("_q", "_c")
                   .agg(F.min_by("_w", F.struct(F.coalesce("_df", F.lit(0)), F.col("_w"))).alias("_w")))
    anchors = rarest.join(parts, ["_q", "_c"]).select("_q", "_w", "_phrases")
    pairs = seen.join(anchors, "_w").select("_key", "_q", "_phrases")
    texts = posts.select(F.col(key).alias("_key"), words_of(F.col(content)).alias("_words"))
    matched = (pairs.join(texts, "_key")
                    .where(F.forall("_phrases", lambda p: has_phrase(F.col("_words"), p)))
                    .select("_key", "_q").distinct())
    found = matched.join(asked, "_q").drop("_q")
    return found.join(posts, found["_key"] == posts[key]).drop("_key")
