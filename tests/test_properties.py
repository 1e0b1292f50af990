"""Randomised comparison of the Spark text functions with brute-force Python
definitions of the same rules, and static checks on the library code."""

import os
import random
import string

from pyspark.sql import functions as F

from textrec.functions import text as T

REPLACED = (set(string.punctuation) - {"\\"}) | set("0123456789\r\t\n")
STOPS = set(T.STOP_WORDS)


def in_emoji_ranges(ch):
    cp = ord(ch)
    for lo, hi in T.EMOJI_RANGES:
        a = int(lo, 16)
        b = int(hi, 16) if hi else a
        if a <= cp <= b:
            return True
    return False


def py_symbols(s):
    return "".join(" " if c in REPLACED else c for c in s)


def py_words(s):
    return [w for w in py_symbols(s.lower()).split(" ") if w]


def py_tokens(s):
    return [w for w in py_symbols(s.lower()).split(" ") if len(w) > 2 and w not in STOPS]


def py_emoji(s):
    return "".join(c for c in s if not in_emoji_ranges(c))


def py_trim(s):
    for i in range(1, len(s)):
        if s[i] in "-(":
            return s[: i - 1]
    return s


ALPHABET = (list("abcdefghij ABC  ") + list(string.punctuation) + list("0123456789\r\t\n")
            + ["é", "ß", "中", "😀", "🚀", "‍", "☀", "☂", "\x0b", "İ"]
            + ["the ", "and ", "don't ", "love ", "stop "])


def random_texts(n=400, seed=7):
    rnd = random.Random(seed)
    return [("".join(rnd.choice(ALPHABET) for _ in range(rnd.randint(0, 40))),) for _ in range(n)]


def test_text_functions_match_brute_force(spark):
    rows = random_texts()
    df = spark.createDataFrame(rows, "s string").select(
        "s", T.strip_symbols("s").alias("sym"), T.words("s").alias("w"), T.tokens("s").alias("t"),
        T.strip_emoji("s").alias("e"), T.trim_title("s").alias("tt"))
    for r in df.collect():
        s = r.s
        assert r.sym == py_symbols(s), repr(s)
        assert r.e == py_emoji(s), repr(s)
        assert r.tt == py_trim(s), repr(s)
        if "İ" not in s:   # lower-casing of dotted capital I differs between languages
            assert r.w == py_words(s), repr(s)
            assert r.t == py_tokens(s), repr(s)


def test_exploded_tokens_equal_array_tokens(spark):
    from textrec.operators.model import line_terms
    df = spark.createDataFrame([(i, t[0]) for i, t in enumerate(random_texts(200, 11))], "id long, line string")
    a = line_terms(df, "line").groupBy("id", "term").count()
    b = df.select("id", F.explode(T.tokens("line")).alias("term")).groupBy("id", "term").count()
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_library_collects_bounded_lists_only():
    """No data reaches the driver; the exceptions are lists whose size the caller
    or a parameter bounds: a text's own terms (``SCAN_TERMS`` at most), the
    folder numbers of a batch (``BUCKETS`` at most), the files of given songs."""
    root = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "textrec")
    allowed = {("score.py", ".collect()"), ("store.py", ".collect()"), ("readers.py", ".collect()")}
    for dirpath, _, files in os.walk(root):
        if os.path.basename(dirpath) == "llm":
            continue  # optional subpackage with bounded samples, tested on its own
        for f in files:
            if f.endswith(".py"):
                src = open(os.path.join(dirpath, f)).read()
                for bad in (".collect()", ".toPandas()", "localCheckpoint", ".rdd."):
                    if (f, bad) in allowed:
                        assert src.count(bad) == 1, (f, bad)
                    else:
                        assert bad not in src, (f, bad)
