"""A plain Python stemmer of the published algorithm, to hold the Column
expressions of ``textrec.functions.stem`` against."""

from textrec.functions.stem import (AFTER_1A, DOUBLES, EXCEPTIONS, LI_ENDING, R1_PREFIXES, STEP2, STEP3, STEP4, VOWELS)


def _is_vowel(ch: str) -> bool:
    return ch in VOWELS


def _regions(w: str) -> tuple[int, int]:
    def after_vc(start: int) -> int:
        for i in range(start + 1, len(w)):
            if not _is_vowel(w[i]) and _is_vowel(w[i - 1]):
                return i + 1
        return len(w)

    r1 = None
    for p in R1_PREFIXES:
        if w.startswith(p):
            r1 = len(p)
            break
    if r1 is None:
        r1 = after_vc(0)
    r2 = after_vc(r1) if r1 < len(w) else len(w)
    return r1, r2


def _short_syllable_end(w: str) -> bool:
    n = len(w)
    if n == 2:
        return _is_vowel(w[0]) and not _is_vowel(w[1])
    if n >= 3:
        return (not _is_vowel(w[-3]) and _is_vowel(w[-2]) and not _is_vowel(w[-1])
                and w[-1] not in "wxY")
    return False


def _is_short(w: str, r1: int) -> bool:
    return r1 >= len(w) and _short_syllable_end(w)


def stem_word(word: str) -> str:
    """Snowball English stem of one lower-case word."""
    if word is None:
        return None
    if len(word) <= 2:
        return word
    if word in EXCEPTIONS:
        return EXCEPTIONS[word]
    w = word.lstrip("'")
    if w.startswith("y"):
        w = "Y" + w[1:]
    w = "".join("Y" if (c == "y" and i > 0 and _is_vowel(w[i - 1])) else c for i, c in enumerate(w))
    r1, r2 = _regions(w)

    # Step 0
    for suf in ("'s'", "'s", "'"):
        if w.endswith(suf):
            w = w[: -len(suf)]
            break

    # Step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ied") or w.endswith("ies"):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("us") or w.endswith("ss"):
        pass
    elif w.endswith("s"):
        if any(_is_vowel(c) for c in w[:-2]):
            w = w[:-1]

    if w in AFTER_1A:
        return w

    # Step 1b
    done = False
    for suf in ("eedly", "eed"):
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                w = w[: -len(suf)] + "ee"
            done = True
            break
    if not done:
        for suf in ("ingly", "edly", "ing", "ed"):
            if w.endswith(suf):
                stem = w[: -len(suf)]
                if any(_is_vowel(c) for c in stem):
                    w = stem
                    if w.endswith(("at", "bl", "iz")):
                        w += "e"
                    elif w.endswith(DOUBLES):
                        w = w[:-1]
                    elif _is_short(w, r1):
                        w += "e"
                break

    # Step 1c
    if len(w) > 2 and w[-1] in "yY" and not _is_vowel(w[-2]):
        w = w[:-1] + "i"

    # Step 2
    for suf, rep in STEP2:
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ogi":
                    if w[-4:-3] == "l":
                        w = w[:-3] + rep
                elif suf == "li":
                    if len(w) >= 3 and w[-3] in LI_ENDING:
                        w = w[:-2]
                else:
                    w = w[: -len(suf)] + rep
            break

    # Step 3
    for suf, rep in STEP3:
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ative":
                    if len(w) - len(suf) >= r2:
                        w = w[:-5]
                else:
                    w = w[: -len(suf)] + rep
            break

    # Step 4
    for suf in STEP4:
        if w.endswith(suf):
            if len(w) - len(suf) >= r2:
                if suf == "ion":
                    if len(w) >= 4 and w[-4] in "st":
                        w = w[:-3]
                else:
                    w = w[: -len(suf)]
            break

    # Step 5
    if w.endswith("e"):
        if len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_syllable_end(w[:-1])):
            w = w[:-1]
    elif w.endswith("l"):
        if len(w) - 1 >= r2 and w[-2:-1] == "l":
            w = w[:-1]

    return w.replace("Y", "y")
