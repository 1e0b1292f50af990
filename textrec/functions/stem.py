"""Lemmas and stems of a vocabulary.

The published Snowball English ("Porter2") rules are written as Column
expressions: the regions R1 and R2 are lengths found by a regular expression, a
step is one projection over the word so far.  Stemming runs over the *distinct*
terms only (the vocabulary job), and the (term, stem) table is joined back to the
postings; there is no Python worker.

A lemma step may come first.  It takes a (word, lemma) table, given or made by
``lemma_map`` from any dictionary of base forms: a word's candidates are the
word itself and what the published noun rules detach from it, and the shortest
one in the dictionary is its lemma.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values of the published algorithm.
# ---------------------------------------------------------------------------
VOWELS = "aeiouy"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDING = "cdeghkmnrt"
R1_PREFIXES = ("gener", "commun", "arsen")
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
AFTER_1A = ("inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed")
STEP2 = (
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
    ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
    ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"),
    ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
    ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
)
STEP3 = (
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"),
    ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""),
)
STEP4 = ("ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti",
         "ous", "ive", "ize", "ion", "al", "er", "ic")



# Endings of English nouns and what stands in their place in the base form.
NOUN_ENDINGS = (("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"), ("ches", "ch"), ("shes", "sh"),
                ("men", "man"), ("ies", "y"))

V, NON_V = f"[{VOWELS}]", f"[^{VOWELS}]"
#: Up to and with the first non-vowel after a vowel.
REGION = f"^{NON_V}*{V}+{NON_V}"
SHORT_END = f"^{V}{NON_V}$|{NON_V}{V}[^{VOWELS}wxY]$"


def _cut(w: Column, n: int, more: str = "") -> Column:
    """The word without its last ``n`` characters, with ``more`` after it."""
    kept = F.substring(w, F.lit(1), F.length(w) - n)
    return F.concat(kept, F.lit(more)) if more else kept


def _by_suffix(w: Column, cases) -> Column:
    """The result of the first case (suffix, result) whose suffix the word has."""
    first, *others = cases
    out = F.when(w.endswith(first[0]), first[1])
    for suffix, result in others:
        out = out.when(w.endswith(suffix), result)
    return out.otherwise(w)


def _region_end(w: Column, start: Column) -> Column:
    """Where the region after ``start`` begins; the word's length if there is none."""
    found = F.length(F.regexp_extract(F.substring(w, start + 1, F.length(w)), REGION, 0))
    return F.when(found > 0, start + found).otherwise(F.length(w))


def stems(words: DataFrame, word: str = "term", out: str = "stem") -> DataFrame:
    """Adds the stem of a lower-case word."""
    w, r1, r2 = F.col("_w"), F.col("_r1"), F.col("_r2")
    exception = F.create_map(*[F.lit(x) for pair in EXCEPTIONS.items() for x in pair])
    # short words and exceptions are done at the start, and some after the plural step
    df = words.withColumn("_done", F.when(F.length(word) <= 2, F.col(word)).otherwise(F.try_element_at(exception, F.col(word))))
    df = df.withColumn("_w", F.regexp_replace(F.ltrim(F.col(word), F.lit("'")), "^y", "Y"))
    df = df.withColumn("_w", F.regexp_replace(w, f"(?<={V})y", "Y"))
    prefix = F.length(F.regexp_extract(w, f"^({'|'.join(R1_PREFIXES)})", 1))
    df = df.withColumn("_r1", F.when(prefix > 0, prefix).otherwise(_region_end(w, F.lit(0))))
    df = df.withColumn("_r2", _region_end(w, r1))

    def in_region(n: int, region: Column, result: Column) -> Column:
        return F.when(F.length(w) - n >= region, result).otherwise(w)

    # 0 and 1a: possessives, plurals
    df = df.withColumn("_w", F.regexp_replace(w, "('s'|'s|')$", ""))
    short = F.when(F.length(w) > 4, _cut(w, 2)).otherwise(_cut(w, 1))
    df = df.withColumn("_w", _by_suffix(w, [
        ("sses", _cut(w, 2)), ("ied", short), ("ies", short), ("us", w), ("ss", w),
        ("s", F.when(w.rlike(f"{V}.*..$"), _cut(w, 1)).otherwise(w))]))
    df = df.withColumn("_done", F.coalesce("_done", F.when(w.isin(*AFTER_1A), w)))
    # 1b: past and -ing forms; what they leave is mended
    df = df.withColumn("_cut", F.when(w.endswith("eedly") | w.endswith("eed"), None)
                       .when(w.rlike(f"{V}.*(ingly|edly|ing|ed)$"), F.regexp_replace(w, "(ingly|edly|ing|ed)$", "")))
    # the vowel has to stand before the ending, so the rest is asked again
    df = df.withColumn("_cut", F.when(F.col("_cut").rlike(V), F.col("_cut")))
    c = F.col("_cut")
    mended = (F.when(c.rlike("(at|bl|iz)$"), F.concat(c, F.lit("e")))
               .when(c.rlike(f"({'|'.join(DOUBLES)})$"), _cut(c, 1))
               .when((F.length(c) <= r1) & c.rlike(SHORT_END), F.concat(c, F.lit("e"))).otherwise(c))
    df = df.withColumn("_w", F.when(c.isNotNull(), mended).otherwise(_by_suffix(w, [
        ("eedly", in_region(5, r1, _cut(w, 5, "ee"))), ("eed", in_region(3, r1, _cut(w, 3, "ee")))])))
    # 1c: y after a consonant
    df = df.withColumn("_w", F.regexp_replace(w, f"^(.+{NON_V})[yY]$", "$1i"))
    # 2, 3 and 4: suffixes in R1 and R2
    df = df.withColumn("_w", _by_suffix(w, [(s, in_region(len(s), r1, _cut(w, len(s), more) if s not in ("ogi", "li") else
        F.when(w.rlike("logi$" if s == "ogi" else f"[{LI_ENDING}]li$"), _cut(w, len(s), more)).otherwise(w)))
        for s, more in STEP2]))
    df = df.withColumn("_w", _by_suffix(w, [(s, in_region(len(s), r2 if s == "ative" else r1, _cut(w, len(s), more)))
                                            for s, more in STEP3]))
    df = df.withColumn("_w", _by_suffix(w, [(s, in_region(len(s), r2, _cut(w, len(s)) if s != "ion" else
        F.when(w.rlike("[st]ion$"), _cut(w, 3)).otherwise(w))) for s in STEP4]))
    # 5: a last e or l
    e = F.when((F.length(w) - 1 >= r2) | ((F.length(w) - 1 >= r1) & ~_cut(w, 1).rlike(SHORT_END)), _cut(w, 1)).otherwise(w)
    df = df.withColumn("_w", _by_suffix(w, [("e", e), ("l", in_region(1, r2, F.when(w.endswith("ll"), _cut(w, 1)).otherwise(w)))]))
    return df.withColumn(out, F.coalesce("_done", F.replace(w, F.lit("Y"), F.lit("y")))).drop("_w", "_r1", "_r2", "_done", "_cut")


def lemma_map(terms: DataFrame, dictionary: DataFrame, term_col: str = "term", word_col: str = "word") -> DataFrame:
    """(word, lemma) for each distinct term that has a base form in the dictionary."""
    t = F.col("word")
    forms = [F.struct(t.alias("form"), F.lit(0).alias("rule"))] + [
        F.when(t.endswith(end), F.struct(_cut(t, len(end), put).alias("form"), F.lit(i + 1).alias("rule")))
        for i, (end, put) in enumerate(NOUN_ENDINGS)]
    words = terms.select(F.col(term_col).alias("word")).distinct()
    tried = words.select("word", F.explode(F.array(*forms)).alias("f")).where(F.col("f").isNotNull() & (F.length("f.form") > 0))
    known = dictionary.select(F.col(word_col).alias("form")).distinct()
    kept = tried.select("word", "f.form", "f.rule").join(known, "form", "left_semi")
    # of equally short forms the earlier rule; length and rule are one number, so the choice is a hash aggregate
    ranked = kept.select("word", F.col("form").alias("lemma"), (F.length("form") * 100 + F.col("rule")).alias("rank"))
    best = ranked.groupBy("word").agg(F.min("rank").alias("rank"))
    return ranked.join(best, ["word", "rank"], "left_semi").select("word", "lemma")


def stem_map(terms: DataFrame, term_col: str = "term", lemmas: DataFrame | None = None) -> DataFrame:
    """Vocabulary job: (term, stem) for every distinct term; with a (word, lemma)
    table each term's lemma is stemmed, if it has one."""
    vocab = terms.select(F.col(term_col).alias("term")).distinct()
    if lemmas is None:
        return stems(vocab)
    known = vocab.join(lemmas.select(F.col("word").alias("term"), "lemma"), "term", "left")
    return stems(known.select("term", F.coalesce("lemma", "term").alias("_base")), "_base").select("term", "stem")
