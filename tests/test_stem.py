"""Published Snowball English stems, the same rules in plain Python, lemmas."""

import random


from tests.helpers.porter2 import stem_word
from textrec.functions import stem as ST
from textrec.functions.stem import lemma_map, stem_map
from textrec.operators import model as M
from textrec.sources import fixtures as FX

GOLDEN = dict(running="run", generously="generous", consignment="consign", knightly="knight",
              happiness="happi", caresses="caress", ponies="poni", ties="tie", cats="cat", agreed="agre",
              hopping="hop", hoping="hope", relational="relat", conditional="condit",
              generalization="general", beautiful="beauti", mountains="mountain", fountains="fountain",
              skies="sky", news="news", communication="communic", cried="cri", gas="gas", gaps="gap",
              kiwis="kiwi", controlling="control", sensational="sensat", hopeful="hope", goodness="good",
              electrical="electr", adjustable="adjust", adoption="adopt", cease="ceas", inning="inning",
              exceed="exceed", luxuriating="luxuri", crying="cri", lying="lie", argued="argu",
              national="nation", heavenly="heaven", triplicate="triplic", formative="format",
              angularity="angular", electricity="electr")


def stemmed(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "term string")
    return {r.term: r.stem for r in stem_map(df).collect()}


def test_golden_stems(spark):
    assert {w: stem_word(w) for w in GOLDEN} == GOLDEN
    assert stemmed(spark, list(GOLDEN) * 3) == GOLDEN


def test_random_words_equal_plain_python(spark):
    rnd = random.Random(9)
    ends = [s for s, _ in ST.STEP2 + ST.STEP3] + list(ST.STEP4) + list(ST.DOUBLES) + [
        "sses", "ied", "ies", "us", "ss", "s", "eedly", "eed", "ingly", "edly", "ing", "ed", "'s'", "'s", "'", "at", "bl", "iz", "e", "y", "l", "ll"]
    heads = ["", "y", "'", "gener", "commun", "arsen", "by", "sky", "ay", "yy", "é", "w", "x"]
    syllable = lambda: "".join(rnd.choice("bcdgklmnrstwxyz") * rnd.randint(0, 2) + rnd.choice("aeiouy"))
    words = {rnd.choice(heads) + "".join(syllable() for _ in range(rnd.randint(0, 3))) + rnd.choice(["", "t", "l", "s"])
             + "".join(rnd.choice(ends) for _ in range(rnd.randint(0, 2))) for _ in range(20000)} - {""}
    words |= set(ST.EXCEPTIONS) | set(ST.AFTER_1A) | {"a", "to", "sees", "gas", "s", "ed", "ing"}
    assert stemmed(spark, sorted(words)) == {w: stem_word(w) for w in words}


def test_vocabulary_of_the_documents(spark, sf):
    terms = [r.term for r in M.line_terms(FX.lines(spark, sf), "tweet_line").select("term").distinct().collect()]
    assert stemmed(spark, terms) == {w: stem_word(w) for w in terms}


def test_no_python_worker(spark, sf):
    plan = stem_map(M.line_terms(FX.lines(spark, sf), "tweet_line"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_lemmas(spark):
    dictionary = spark.createDataFrame([(w,) for w in ("glass", "wolf", "man", "city", "box", "church", "s", "bus", "cat", "cats")], "word string")
    terms = spark.createDataFrame([(w,) for w in ("glasses", "wolves", "men", "cities", "boxes", "churches", "bus", "cats", "unknown", "s")] * 2,
                                  "term string")
    got = {r.word: r.lemma for r in lemma_map(terms, dictionary).collect()}
    assert got == {"glasses": "glass", "men": "man", "cities": "city", "boxes": "box", "churches": "church",
                   "wolves": "wolf", "bus": "bus", "cats": "cat", "s": "s"}
    stems = {r.term: r.stem for r in stem_map(terms, lemmas=lemma_map(terms, dictionary)).collect()}
    assert stems == {w: stem_word(got.get(w, w)) for w in stems} and len(stems) == 10


def test_stemmed_query_matches_inflected_corpus(spark):
    from textrec.operators import score as S
    lines = spark.createDataFrame([(1, "mountain mountain"), (2, "fountain")], "id long, line string")
    tf = M.apply_stems(M.term_counts(lines, "line"), stem_map(M.line_terms(lines, "line")))
    post = M.tfidf(tf)
    q = spark.createDataFrame([(0, "mountains")], "query_id int, text string")
    got = {r.id for r in S.scores(S.query_terms(q, stem=True), post).collect()}
    assert got == {1}
