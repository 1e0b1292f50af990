"""Column-level text functions.

Every function takes and returns a ``Column`` built only from Spark built-ins,
so they stay inside whole-stage codegen and are pushed into a single stage
with the scan that feeds them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for the same results.
# ---------------------------------------------------------------------------

# English stop words (the published NLTK English list, in its own order).
STOP_WORDS = (
    "i", "me", "my", "myself", "we", "our", "ours", "ourselves", "you", "you're",
    "you've", "you'll", "you'd", "your", "yours", "yourself", "yourselves", "he",
    "him", "his", "himself", "she", "she's", "her", "hers", "herself", "it", "it's",
    "its", "itself", "they", "them", "their", "theirs", "themselves", "what", "which",
    "who", "whom", "this", "that", "that'll", "these", "those", "am", "is", "are",
    "was", "were", "be", "been", "being", "have", "has", "had", "having", "do",
    "does", "did", "doing", "a", "an", "the", "and", "but", "if", "or", "because",
    "as", "until", "while", "of", "at", "by", "for", "with", "about", "against",
    "between", "into", "through", "during", "before", "after", "above", "below",
    "to", "from", "up", "down", "in", "out", "on", "off", "over", "under", "again",
    "further", "then", "once", "here", "there", "when", "where", "why", "how", "all",
    "any", "both", "each", "few", "more", "most", "other", "some", "such", "no", "nor",
    "not", "only", "own", "same", "so", "than", "too", "very", "s", "t", "can",
    "will", "just", "don", "don't", "should", "should've", "now", "d", "ll", "m",
    "o", "re", "ve", "y", "ain", "aren", "aren't", "couldn", "couldn't", "didn",
    "didn't", "doesn", "doesn't", "hadn", "hadn't", "hasn", "hasn't", "haven",
    "haven't", "isn", "isn't", "ma", "mightn", "mightn't", "mustn", "mustn't",
    "needn", "needn't", "shan", "shan't", "shouldn", "shouldn't", "wasn", "wasn't",
    "weren", "weren't", "won", "won't", "wouldn", "wouldn't",
)

# Characters replaced by a space: ASCII punctuation except the backslash, the
# digits, CR, TAB and LF.  (In the reference's class the backslash escapes the
# closing bracket, so a backslash itself is never replaced.)
PUNCT_DIGITS = r"""[!"#$%&'()*+,\-./:;<=>?@\[\]^_`{|}~0-9\r\t\n]"""

# Emoji and symbol code-point ranges deleted from posts, as listed in the
# reference (one range appears twice there and is kept twice here).
EMOJI_RANGES = (
    ("1F600", "1F64F"),  # emoticons
    ("1F300", "1F5FF"),  # symbols & pictographs
    ("1F680", "1F6FF"),  # transport & map symbols
    ("1F1E0", "1F1FF"),  # flags
    ("2500", "2BEF"),
    ("2702", "27B0"),
    ("2702", "27B0"),
    ("24C2", "1F251"),
    ("1F926", "1F937"),
    ("10000", "10FFFF"),
    ("2640", "2642"),
    ("2600", "2B55"),
    ("200D", None),
    ("23CF", None),
    ("23E9", None),
    ("231A", None),
    ("FE0F", None),
    ("3030", None),
)

# Substrings that mark an advertising or bot post.
AD_MARKERS = ("playing", "amp", "hps:", "http", "@")

# Length of a query after repetition, and the repetition factor.
MIN_QUERY_TOKENS = 15
QUERY_REPEAT = 5

# Sentinel rank for a target missing from the recommendation list.
MISSING_RANK = 100000


def _emoji_class() -> str:
    parts = []
    for lo, hi in EMOJI_RANGES:
        parts.append(f"\\x{{{lo}}}" + (f"-\\x{{{hi}}}" if hi else ""))
    return "[" + "".join(parts) + "]+"


EMOJI_PATTERN = _emoji_class()


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------------------
# T1-T10
# ---------------------------------------------------------------------------

def strip_emoji(c) -> Column:
    """Delete emoji and symbol runs."""
    return F.regexp_replace(_col(c), EMOJI_PATTERN, "")


def strip_symbols(c) -> Column:
    """Punctuation (not backslash), digits, CR, TAB, LF become a space."""
    return F.regexp_replace(_col(c), PUNCT_DIGITS, " ")


def normalize(c) -> Column:
    """T3 then T2: lower-case, then replace symbols by spaces."""
    return strip_symbols(F.lower(_col(c)))


def split_spaces(c) -> Column:
    """T4: split on one space; empty strings are kept."""
    return F.split(_col(c), " ")


#: Runs of the characters that T2 makes spaces, and of spaces.
BETWEEN_WORDS = PUNCT_DIGITS.removesuffix("]") + " ]+"


def pieces(c) -> Column:
    """T3 -> T2 -> T4 in one pass over the text: the same non-empty words, with
    an empty one at most at either end."""
    return F.split(F.lower(_col(c)), BETWEEN_WORDS)


def words(c) -> Column:
    """Lower, replace symbols, split on a space, keep non-empty words
    (``array_remove`` is a native, code-generated array function)."""
    return F.array_remove(pieces(c), "")


def tokens(c, stop_words=STOP_WORDS, min_len: int = 3) -> Column:
    """T7 = T3 -> T2 -> T4 -> T5 (length >= min_len) -> T6 (stop words)."""
    stops = [F.lit(w) for w in stop_words]
    return F.filter(
        split_spaces(normalize(c)) if min_len < 1 else pieces(c),
        lambda w: (F.length(w) >= min_len) & ~w.isin(*stops) if stops else F.length(w) >= min_len,
    )


def is_token(term, stop_words=STOP_WORDS, min_len: int = 3) -> Column:
    """T5 + T6 as a row predicate on one exploded word (code-generated; the
    stop list becomes a hash-set lookup)."""
    term = _col(term)
    cond = F.length(term) >= min_len
    return cond & ~term.isin(*stop_words) if stop_words else cond


def word_count(c) -> Column:
    """Number of words."""
    return F.size(words(c))


def distinct_word_count(c) -> Column:
    """Number of distinct words."""
    return F.size(F.array_distinct(words(c)))


def space_count(c) -> Column:
    """Number of single spaces in a string."""
    c = _col(c)
    return F.length(c) - F.length(F.replace(c, F.lit(" "), F.lit("")))


def remove_words(text, word_array) -> Column:
    """Delete every word of ``word_array`` from ``text`` as a substring,
    in order, case-sensitive."""
    return F.aggregate(_col(word_array), _col(text),
                       lambda acc, w: F.replace(acc, w, F.lit("")))


def has_ad_marker(c, markers=AD_MARKERS) -> Column:
    """true when the line contains any marker substring."""
    c = _col(c)
    return reduce(lambda a, b: a | b, [c.contains(m) for m in markers])


def repeat_factor(n_tokens, min_tokens: int = MIN_QUERY_TOKENS,
                  mult: int = QUERY_REPEAT) -> Column:
    """How many copies of a query's tokens are used: multiply by ``mult``
    until there are at least ``min_tokens`` tokens; 1 when there are none."""
    n = _col(n_tokens)
    expr = F.when(n <= 0, F.lit(1)).when(n >= min_tokens, F.lit(1))
    factor = mult
    # smallest power of mult that lifts one token above the minimum
    while factor < min_tokens:
        expr = expr.when(n * factor >= min_tokens, F.lit(factor))
        factor *= mult
    return expr.otherwise(F.lit(factor))


def repeat_tokens(token_array, min_tokens: int = MIN_QUERY_TOKENS,
                  mult: int = QUERY_REPEAT) -> Column:
    """T13 as an array: the tokens repeated ``repeat_factor`` times."""
    t = _col(token_array)
    return F.flatten(F.array_repeat(t, repeat_factor(F.size(t), min_tokens, mult)))


# ---------------------------------------------------------------------------
# Collection-side strings
# ---------------------------------------------------------------------------

def join_names(struct_array, field: str = "name", sep: str = ",") -> Column:
    """``a.name`` of every element joined by ``sep``."""
    return F.array_join(F.transform(_col(struct_array), lambda a: a[field]), sep)


def search_string(song, artist, stop_words=STOP_WORDS) -> Column:
    """Per artist ``("song" AND "first-name")``; the full name when it has
    one word or starts with a stop word; parts joined by `` OR ``."""
    song = _col(song)
    stops = [F.lit(w) for w in stop_words]

    def part(a):
        first = F.split(a, " ")
        head = F.element_at(first, 1)
        use_first = (F.size(first) > 1) & ~F.lower(head).isin(*stops)
        who = F.when(use_first, head).otherwise(a)
        return F.concat(F.lit('("'), song, F.lit('" AND "'), who, F.lit('")'))

    return F.array_join(F.transform(F.split(_col(artist), ","), part), " OR ")


def trim_title(c) -> Column:
    """Cut a title at the first ``-`` or ``(`` found at index >= 1,
    also dropping the character just before it."""
    c = _col(c)
    # locate counts code points like substring (regexp_instr counts UTF-16
    # units, which differs after an emoji); least() skips the nulls
    hits = [F.when(F.locate(ch, c, 2) > 0, F.locate(ch, c, 2)) for ch in "-("]
    pos = F.least(*hits)
    return F.when(pos.isNotNull(), F.substring(c, F.lit(1), pos - 2)).otherwise(c)


def concat_space(*cols) -> Column:
    """Concatenate with a space, skipping nulls."""
    return F.concat_ws(" ", *[_col(c) for c in cols])


def song_from_path(c) -> Column:
    """Drop ``.csv`` and a leading ``d-d-d/`` from a blob name."""
    return F.regexp_replace(F.replace(_col(c), F.lit(".csv"), F.lit("")),
                            r"^[0-9]+-[0-9]+-[0-9]+/", "")
