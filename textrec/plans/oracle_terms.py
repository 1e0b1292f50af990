"""DuckDB SQL of stems, lemmas and hash buckets, over a table of terms.

Stems: one common table expression a step, on prefixes and suffixes of strings.
Buckets: MurmurHash3 (x86, 32 bit, seed 42) of the UTF-8 bytes, in whole numbers."""

from __future__ import annotations

from textrec.functions import stem as ST

VOWEL = "[aeiouy]"
REST = "[^aeiouy]"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _cut(n: int, more: str = "", w: str = "w") -> str:
    return f"(left({w}, length({w}) - {n}) || {_q(more)})"


def _case(cases: list[tuple[str, str]]) -> str:
    return "CASE " + " ".join(f"WHEN suffix(w, {_q(s)}) THEN {r}" for s, r in cases) + " ELSE w END"


def _if(condition: str, then: str) -> str:
    return f"(CASE WHEN {condition} THEN {then} ELSE w END)"


def _region(text: str) -> str:
    return f"length(regexp_extract({text}, '^{REST}*{VOWEL}+{REST}'))"


def stems(terms: str, word: str = "term", name: str = "stems") -> str:
    """CTEs ending in ``name`` (term, stem) of the distinct words of a table."""
    n = name
    short = f"regexp_matches({{w}}, '^{VOWEL}{REST}$') OR regexp_matches({{w}}, '{REST}{VOWEL}[^aeiouywxY]$')"
    exceptions = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in ST.EXCEPTIONS.items())
    after = ", ".join(_q(x) for x in ST.AFTER_1A)
    step2 = [(s, _if(f"length(w) - {len(s)} >= r1" + {"ogi": " AND suffix(w, 'logi')",
                     "li": f" AND contains('{ST.LI_ENDING}', substr(w, length(w) - 2, 1)) AND length(w) > 2"}.get(s, ""), _cut(len(s), m)))
             for s, m in ST.STEP2]
    step3 = [(s, _if(f"length(w) - {len(s)} >= {'r2' if s == 'ative' else 'r1'}", _cut(len(s), m))) for s, m in ST.STEP3]
    step4 = [(s, _if(f"length(w) - {len(s)} >= r2" + (" AND (suffix(w, 'sion') OR suffix(w, 'tion'))" if s == "ion" else ""), _cut(len(s))))
             for s in ST.STEP4]
    ended = " ".join(f"WHEN suffix(w, '{e}') THEN {_cut(len(e))}" for e in ("ingly", "edly", "ing", "ed"))
    doubled = " OR ".join(f"suffix(c, '{d}')" for d in ST.DOUBLES)
    dropped = _cut(1)
    return f"""{n}_0 AS (SELECT DISTINCT {word} AS term, regexp_replace(ltrim({word}, chr(39)), '^y', 'Y') AS w FROM {terms}),
{n}_1 AS (SELECT term, array_to_string(list_transform(string_split(w, ''), lambda x, i: CASE WHEN x = 'y' AND i > 1
    AND contains('aeiouy', substr(w, i - 1, 1)) THEN 'Y' ELSE x END), '') AS w FROM {n}_0),
{n}_2 AS (SELECT *, CASE WHEN prefix(w, 'gener') OR prefix(w, 'arsen') THEN 5 WHEN prefix(w, 'commun') THEN 6
    WHEN {_region('w')} > 0 THEN {_region('w')} ELSE length(w) END AS r1 FROM {n}_1),
{n}_3 AS (SELECT term, r1, CASE WHEN {_region('substr(w, r1 + 1)')} > 0 THEN r1 + {_region('substr(w, r1 + 1)')} ELSE length(w) END AS r2,
    {_case([("'s'", _cut(3)), ("'s", _cut(2)), ("'", _cut(1))])} AS w FROM {n}_2),
{n}_4 AS (SELECT term, r1, r2, {_case([("sses", _cut(2)), ("ied", f"CASE WHEN length(w) > 4 THEN {_cut(2)} ELSE {_cut(1)} END"),
    ("ies", f"CASE WHEN length(w) > 4 THEN {_cut(2)} ELSE {_cut(1)} END"), ("us", "w"), ("ss", "w"),
    ("s", _if(f"regexp_matches({_cut(2)}, '{VOWEL}')", _cut(1)))])} AS w FROM {n}_3),
{n}_5 AS (SELECT *, CASE WHEN suffix(w, 'eed') OR suffix(w, 'eedly') THEN NULL {ended} END AS c0,
    CASE WHEN w IN ({after}) THEN w END AS stop FROM {n}_4),
{n}_6 AS (SELECT *, CASE WHEN regexp_matches(c0, '{VOWEL}') THEN c0 END AS c FROM {n}_5),
{n}_7 AS (SELECT term, r1, r2, stop, CASE WHEN c IS NULL THEN {_case([
        ("eedly", _if("length(w) - 5 >= r1", _cut(5, "ee"))), ("eed", _if("length(w) - 3 >= r1", _cut(3, "ee")))])}
    WHEN suffix(c, 'at') OR suffix(c, 'bl') OR suffix(c, 'iz') THEN c || 'e' WHEN {doubled} THEN {_cut(1, "", "c")}
    WHEN r1 >= length(c) AND ({short.format(w='c')}) THEN c || 'e' ELSE c END AS w FROM {n}_6),
{n}_8 AS (SELECT term, r1, r2, stop, CASE WHEN length(w) > 2 AND regexp_matches(w, '{REST}[yY]$') THEN {_cut(1, "i")} ELSE w END AS w
    FROM {n}_7),
{n}_9 AS (SELECT term, r1, r2, stop, {_case(step2)} AS w FROM {n}_8),
{n}_10 AS (SELECT term, r1, r2, stop, {_case(step3)} AS w FROM {n}_9),
{n}_11 AS (SELECT term, r1, r2, stop, {_case(step4)} AS w FROM {n}_10),
{n}_12 AS (SELECT term, stop, {_case([
    ("e", _if(f"length(w) - 1 >= r2 OR (length(w) - 1 >= r1 AND NOT ({short.format(w=dropped)}))", dropped)),
    ("l", _if("length(w) - 1 >= r2 AND suffix(w, 'll')", dropped))])} AS w FROM {n}_11),
{name} AS (SELECT term, CASE WHEN length(term) <= 2 THEN term ELSE
    coalesce(CASE term {exceptions} END, stop, replace(w, 'Y', 'y')) END AS stem FROM {n}_12)"""


def lemmas(terms: str, dictionary: str) -> str:
    """CTE ``lemmas`` (word, lemma) of terms (term) by the noun rules and a dictionary (word)."""
    tried = " UNION ALL ".join(
        ["SELECT term, term AS form, 0 AS rule FROM " + terms] +
        [f"SELECT term, {_cut(len(e), p, 'term')}, {i + 1} FROM {terms} WHERE suffix(term, '{e}')"
         for i, (e, p) in enumerate(ST.NOUN_ENDINGS)])
    return f"""lemmas AS (SELECT term AS word, form AS lemma FROM ({tried}) WHERE form IN (SELECT word FROM {dictionary}) AND form <> ''
  QUALIFY row_number() OVER (PARTITION BY term ORDER BY length(form), rule) = 1)"""


M = "4294967296"
_PAIR = "lambda i: ('0x' || substr(hx, 2 * i + 1, 2))::BIGINT::HUGEINT"


def buckets(terms: str, size: int = 100000) -> str:
    """CTEs ending in ``buckets`` (term, h)."""
    def mixed(x: str) -> str:                        # two multiplications and a turn by 15 bits
        a = f"(({x}) * 3432918353 % {M})"
        return f"((({a} * 32768) % {M} + {a} // 131072) * 461845907 % {M})"

    def xor(a: str, b: str) -> str:
        return f"xor(({a})::BIGINT, ({b})::BIGINT)::HUGEINT"

    x = xor("h", "k")
    turned = f"((({x} * 8192) % {M} + {x} // 524288) * 5 + 3864292196) % {M}"
    return f"""raw_bytes AS (SELECT term, n, list_transform(range(n), {_PAIR}) AS b
  FROM (SELECT DISTINCT term, hex(encode(term)) AS hx, octet_length(encode(term)) AS n FROM {terms})),
wo AS (SELECT term, n, list_transform(range(n // 4), lambda i: b[4 * i + 1] + 256 * b[4 * i + 2] + 65536 * b[4 * i + 3] + 16777216 * b[4 * i + 4]) AS ws,
  CASE WHEN n % 4 > 0 THEN b[n - n % 4 + 1] ELSE 0 END + CASE WHEN n % 4 > 1 THEN 256 * b[n - n % 4 + 2] ELSE 0 END
  + CASE WHEN n % 4 > 2 THEN 65536 * b[n - n % 4 + 3] ELSE 0 END AS tail FROM raw_bytes),
mu AS (SELECT term, n, tail, list_reduce(list_concat([42::HUGEINT], list_transform(ws, lambda w: {mixed('w')})), lambda h, k: {turned}) AS h FROM wo),
f0 AS (SELECT term, {xor(f"CASE WHEN n % 4 > 0 THEN {xor('h', mixed('tail'))} ELSE h END", 'n')} AS h FROM mu),
f1 AS (SELECT term, ({xor('h', 'h // 65536')} * 2246822507) % {M} AS h FROM f0),
f2 AS (SELECT term, ({xor('h', 'h // 8192')} * 3266489909) % {M} AS h FROM f1),
f3 AS (SELECT term, {xor('h', 'h // 65536')} AS h FROM f2),
buckets AS (SELECT term, (((CASE WHEN h >= 2147483648 THEN h - {M} ELSE h END) % {size} + {size}) % {size})::INT AS h FROM f3)"""
