"""URL filter by the ratio of two character language models.

A list of (host, path) rules labels part of the URLs.  Two variable-order
Markov models are counted over the distinct labelled URLs, one for accepted
and one for rejected ones; a URL without a rule is judged by the difference of
its log-likelihoods under both, divided by its length, against a threshold that
is calibrated on labelled URLs which the models haven't seen.

Models.  A URL is lower-cased (A-Z), led by ``ORDER`` start characters and ended
by one end character; each of its places gives a window of ``ORDER`` characters
and the one that follows.  Counts of windows, summed over their suffixes, are
the counts of all grams of 1 to ``ORDER`` + 1 characters.  The chance of a
character after a context is smoothed by Witten and Bell's rule,

    P(c | h) = (n(hc) + t(h) P(c | h')) / (n(h) + t(h)),

with t(h) the number of distinct characters seen after h and h' the context
without its first character; a context seen fewer than ``MIN_CONTEXT`` times
passes the chance of the shorter one on, so the order varies with what was
seen.  Before the empty context, all known characters and one unknown are alike.

Work.  Windows are counted before anything is looked up, so chances are worked
out once for each distinct window; URLs meet them again in one join on the
window.  Log-ratios are whole millionths, so sums don't depend on their order.
Copies of a URL are judged once and add nothing to the counts.  All is made of
DataFrame functions.

Threshold.  A quarter of the labelled URLs, chosen by the md5 of the URL, is
kept from the models.  Of all steps of ``STEP`` millionths, the threshold is
the one with the largest sum of the shares of accepted URLs at or above it and
of rejected URLs below it; of equal ones the one nearest 0, then the lower.
Without such URLs of both classes it is 0.

Defined cases: a null or empty URL, or one without ``://``, has an empty host
and path and no rule; a null URL is judged as an empty one; without rules, or
with URLs of one class only, every other URL is accepted; repeated rows are
judged alike; an empty table gives no rows; other columns are not read."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textrec.llm.common import table
from textrec.session import materialize

#: (host, path, verdict) of the contract's rules (fixed values).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
ORDER = 4
MIN_CONTEXT = 4
STEP = 10_000
START, END = "\x02", "\x03"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def url_host(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def with_rules(urls: DataFrame, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """Adds rule and rule_verdict (null without a fitting rule) to (url, host, path)."""
    longest_first = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))
    none = F.lit(None).cast("string")
    rule, verdict = none, none
    for host, path, says in reversed(longest_first):
        fits = (((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path))
        rule = F.when(fits, host + path).otherwise(rule)
        verdict = F.when(fits, says).otherwise(verdict)
    return urls.select("*", rule.alias("rule"), verdict.alias("rule_verdict"))


def windows(urls: DataFrame, order: int, *keep: str) -> DataFrame:
    """One row (keep..., w) for each place of each URL.  The text becomes an
    array of characters once; shifted copies of it are zipped, so a long URL
    takes time in proportion to its length."""
    text = lower_ascii(F.col("url"))
    chars = F.split(F.concat(F.lit(START * order), text, F.lit(END)), "")
    base = urls.select(*keep, chars.alias("c"), (F.length("url") + 1).alias("n"))
    shifted = [F.slice("c", F.lit(i + 1), F.col("n")).alias(f"c{i}") for i in range(order + 1)]
    return (base.select(*keep, F.explode(F.arrays_zip(*shifted)).alias("z"))
                .select(*keep, F.concat(*[F.col(f"z.c{i}") for i in range(order + 1)]).alias("w")))


def gram_counts(counted: DataFrame, order: int) -> DataFrame:
    """(g, ga, gb): how often each gram of 1 to ``order`` + 1 characters occurs
    in accepted and rejected URLs (0 if only in others), from window counts
    (w, na, nb)."""
    return _suffixes(counted, order).groupBy("g").agg(F.sum("na").alias("ga"), F.sum("nb").alias("gb"))


def _suffixes(counted: DataFrame, order: int) -> DataFrame:
    sizes = counted.select("*", F.explode(F.sequence(F.lit(1), F.lit(order + 1))).alias("k"))
    return sizes.select("*", F.expr("right(w, k)").alias("g"))


def context_counts(grams: DataFrame) -> DataFrame:
    """(h, ha, ta, hb, tb): occurrences of each context and the number of
    distinct characters after it, for both classes."""
    return grams.where("ga + gb > 0").groupBy(F.expr("left(g, length(g) - 1)").alias("h")).agg(
        F.sum("ga").alias("ha"), F.sum(F.expr("cast(ga > 0 AS bigint)")).alias("ta"),
        F.sum("gb").alias("hb"), F.sum(F.expr("cast(gb > 0 AS bigint)")).alias("tb"))


def log_ratios(counted: DataFrame, order: int, min_context: int) -> DataFrame:
    """(w, r): the log-ratio of accepted to rejected of each window's last
    character, in millionths.  Contexts meet distinct grams, so the short ones
    that most windows share are looked up few times."""
    grams = materialize(gram_counts(counted, order), "url-grams")
    known = grams.where("length(g) = 1 AND ga + gb > 0").agg(F.count("*").alias("v"))
    unknown = 1.0 / (known.select("v").scalar() + 1)
    in_context = materialize(grams.withColumn("h", F.expr("left(g, length(g) - 1)"))
                                  .join(context_counts(grams), "h", "left").drop("h"), "url-contexts")
    parts = _suffixes(counted.select("w"), order).join(in_context, "g")
    zero = {c: 0 for c in ("ga", "ha", "ta", "gb", "hb", "tb")}
    steps = parts.na.fill(zero).groupBy("w").agg(
        F.sort_array(F.collect_list(F.struct("k", *zero))).alias("steps")).select("w", "steps", unknown.alias("p0"))

    def step(acc: Column, s: Column) -> Column:
        def chance(p, n, h, t):
            return F.when(h < min_context, p).otherwise((n + t * p) / (h + t))
        return F.struct(chance(acc["a"], s["ga"], s["ha"], s["ta"]).alias("a"),
                        chance(acc["b"], s["gb"], s["hb"], s["tb"]).alias("b"))

    start = F.struct(F.col("p0").alias("a"), F.col("p0").alias("b"))
    last = steps.select("w", F.aggregate("steps", start, step).alias("p"))
    return last.select("w", F.round((F.log("p.a") - F.log("p.b")) * 1e6).cast("bigint").alias("r"))


def threshold(scored: DataFrame, step: int = STEP) -> DataFrame:
    """One row (threshold): scored has (label, score) of the kept labelled URLs.
    Scores lie within some tens of millions, so there are few thousand steps
    however many URLs there are, and the running sums over them are small."""
    from pyspark.sql import Window
    steps = scored.groupBy(F.floor(F.col("score") / step).alias("bin")).agg(
        F.sum(F.expr("cast(label = 'allow' AS bigint)")).alias("a"),
        F.sum(F.expr("cast(label = 'block' AS bigint)")).alias("b"))
    totals = scored.agg(F.sum(F.expr("cast(label = 'allow' AS bigint)")).alias("a"),
                        F.sum(F.expr("cast(label = 'block' AS bigint)")).alias("b"))
    below = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    at = steps.select("bin", F.coalesce(F.sum("a").over(below), F.lit(0)).alias("a_below"),
                      F.coalesce(F.sum("b").over(below), F.lit(0)).alias("b_below"),
                      totals.select("a").scalar().alias("n_a"), totals.select("b").scalar().alias("n_b"))
    good = (F.col("n_a") - F.col("a_below")) / F.col("n_a") + F.col("b_below") / F.col("n_b")
    best = (at.where("n_a > 0 AND n_b > 0")
              .agg(F.max_by("bin", F.struct(good, -F.abs("bin"), -F.col("bin"))).alias("bin")))
    return best.select((F.coalesce("bin", F.lit(0)) * step).alias("threshold"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, id_col: str = "page_id",
          url_col: str = "url", order: int = ORDER, min_context: int = MIN_CONTEXT) -> DataFrame:
    """(page_id, host, path, rule, verdict, score): verdict is allow or block,
    score the log-likelihood difference for each character in millionths (null
    where a rule decides and the URL wasn't kept for calibration)."""
    rows = pages.select(F.col(id_col).alias("page_id"),
                        F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"))
    distinct = rows.select("url").distinct().select("url", url_host(F.col("url")).alias("host"),
                                                    url_path(F.col("url")).alias("path"))
    digest = F.md5(F.col("url"))
    urls = materialize(with_rules(distinct, rules).select(
        "*", F.unhex(digest).alias("key"),
        F.substring(digest, 1, 1).isin("0", "1", "2", "3").alias("kept")), "urls")
    teach = F.col("rule_verdict").isNotNull() & ~F.col("kept")
    asked = F.col("rule_verdict").isNull() | F.col("kept")
    taught = urls.select("url", *[(teach & (F.col("rule_verdict") == v)).cast("int").alias(c)
                                  for v, c in (("allow", "a"), ("block", "b"))])
    counted = materialize(windows(taught, order, "a", "b").groupBy("w").agg(
        F.sum("a").alias("na"), F.sum("b").alias("nb")), "url-windows")
    # written first, so that the join on windows has exchanges of its own, whose hot keys Spark can split
    ratios = materialize(log_ratios(counted, order, min_context), "url-ratios")
    places = windows(urls.where(asked), order, "key").join(ratios, "w", "left")
    score = F.floor(F.sum("r") / F.count(F.lit(1))).alias("score")
    scored = materialize(urls.join(places.groupBy("key").agg(score), "key", "left"), "url-scores")
    cut = threshold(scored.where("rule_verdict IS NOT NULL AND kept").select(
        F.col("rule_verdict").alias("label"), "score"))
    # without URLs of both classes there is nothing to tell apart
    classes = scored.where("rule_verdict IS NOT NULL AND NOT kept").agg(F.count_distinct("rule_verdict").alias("n"))
    by_model = F.when((classes.select("n").scalar() == 2) & (F.col("score") < cut.select("threshold").scalar()), "block") \
        .otherwise("allow")
    judged = scored.select("url", "host", "path", "rule", F.coalesce("rule_verdict", by_model).alias("verdict"), "score")
    return rows.join(judged, "url").select("page_id", "host", "path", "rule", "verdict", "score")


def op13_url_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "score")
