"""Toxicity by compression distance.

Two zstandard dictionaries are trained on a bounded sample of labelled rows:
one of ordinary text, one of toxic text.  Both hold the most frequent words of
ordinary rows; the toxic one ends with the segments (words and their
beginnings) that are far more frequent in toxic rows, where the ordinary one
has further ordinary words of the same size.  A segment counts by its distinct
neighbours, not by its occurrences, so passages that copies share don't get in.
Toxic phrases of ordinary words give no gain; dictionaries of whole windows find
far less (README).

A text is cut into windows of ``WINDOW`` words.  A window's gain is by how many
bytes it is shorter with the toxic dictionary than with the ordinary one.  The
largest gains, their mean and how many exceed thresholds (calibrated as
quantiles over ordinary windows) go into a logistic curve that is fitted on
sample rows that the dictionaries haven't seen.

Defined cases: null and empty texts have no windows and score as a text with
no gain; where the sample lacks a class the score is the constant share of
ones (0.5 without any rows)."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession

from textrec.llm.common import table
from textrec.llm.learning import Constant, Logistic, scored, split_rows, training_sample

WINDOW = 8
ORDINARY_BYTES = 40_000
MIN_CONTEXTS = 3
#: Log-odds of a segment, and how many standard errors they are at least.
MIN_LOG_ODDS = 2.5
MIN_Z = 2.7
#: Lengths of word beginnings that may be segments, in characters.
BEGINNINGS = (4, 5, 6)
THRESHOLD = 0.3
#: Calibrated thresholds: gains that this share of ordinary windows reaches.
QUANTILES = (0.99, 0.999)
_WORDS = re.compile(r"\w+").findall


def windows(text: str) -> list[bytes]:
    words = text.lower().split()
    return [(" " + " ".join(words[i:i + WINDOW])).encode("utf-8", "surrogatepass") for i in range(0, len(words), WINDOW)]


def segments(word: str) -> list[str]:
    return [word, *(word[:n] for n in BEGINNINGS if n < len(word))]


def toxic_segments(toxic: list[str], ordinary: list[str]) -> list[str]:
    """Segments with high log-odds in toxic rows, the most telling last."""
    counts = [Counter(), Counter()]
    for count, texts in zip(counts, (toxic, ordinary), strict=True):
        for text in texts:
            count.update({s for w in _WORDS(text.lower()) for s in segments(w)})

    def telling(segment: str, n: float) -> bool:
        other = counts[1][segment] + .5
        odds = math.log((n + .5) / (len(toxic) + 1)) - math.log(other / (len(ordinary) + 1))
        return odds > MIN_LOG_ODDS and odds > MIN_Z * math.sqrt(1 / (n + .5) + 1 / other)

    candidates = {s for s, n in counts[0].items() if n >= MIN_CONTEXTS and telling(s, n)}
    contexts: dict[str, set] = defaultdict(set)
    for text in toxic:
        words = ["", *_WORDS(text.lower()), ""]
        for before, word, after in zip(words, words[1:], words[2:], strict=False):
            for s in segments(word):
                if s in candidates:
                    contexts[s].add((before, after))
    size = {s: min(len(contexts[s]), counts[0][s]) for s in candidates}
    return sorted((s for s in candidates if size[s] >= MIN_CONTEXTS and telling(s, size[s])), key=lambda s: (size[s], s))


def dictionaries(toxic: list[str], ordinary: list[str]) -> tuple[bytes, bytes]:
    """Contents of the ordinary and the toxic dictionary, of the same size."""
    found = " ".join(toxic_segments(toxic, ordinary)).encode()
    counts = Counter(w for t in ordinary for w in t.lower().split())
    words = sorted(counts, key=lambda w: (-counts[w], w))[:ORDINARY_BYTES]
    common = " ".join(reversed(words)).encode("utf-8", "surrogatepass")
    core = common[-ORDINARY_BYTES:]
    filler = common[:-ORDINARY_BYTES][-len(found) - 2:] if len(found) else b""
    return core + b" " * (len(found) + 2 - len(filler)) + filler, core + b" " + found + b" "


class Model:
    def __init__(self, ordinary: bytes, toxic: bytes):
        self.ordinary, self.toxic = ordinary, toxic
        self.limits, self.curve, self._compress = (1.0,) * len(QUANTILES), None, None

    def __getstate__(self):
        return self.__dict__ | {"_compress": None}  # compressors are made where they are used

    @staticmethod
    def compressor(content: bytes):
        kind = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        params = zstandard.ZstdCompressionParameters.from_level(
            3, dict_size=len(content), source_size=64, min_match=5, strategy=zstandard.STRATEGY_DFAST, hash_log=17,
            chain_log=17, write_checksum=False, write_content_size=False, write_dict_id=False)
        return zstandard.ZstdCompressor(dict_data=kind, compression_params=params).compress

    def gains(self, text: str) -> np.ndarray:
        if self._compress is None:
            self._compress = self.compressor(self.ordinary), self.compressor(self.toxic)
        plain, toxic = self._compress
        return np.array([len(plain(w)) - len(toxic(w)) for w in windows(text)], float)

    def features(self, text: str) -> list[float]:
        g = np.sort(self.gains(text))[::-1]
        if not len(g):
            return [0.0] * (4 + len(QUANTILES))
        return [g[0], g[:3].sum(), g.mean(), math.log(len(g)), *(math.log1p((g > x).sum()) for x in self.limits)]

    def __call__(self, texts: list[str]) -> list[float]:
        return self.curve(np.array([self.features(t) for t in texts])).tolist() if texts else []


def fit(sample: dict[int, list[str]]):
    """A model of texts of class 1 (toxic) against class 0."""
    if min(map(len, sample.values())) < 2:
        return Constant(len(sample[1]), len(sample[0]))
    parts = {y: split_rows(texts, 3) for y, texts in sample.items()}
    model = Model(*dictionaries(parts[1][0], parts[0][0]))
    seen = np.concatenate([model.gains(t) for t in parts[0][1]] + [np.zeros(1)])
    model.limits = tuple(float(np.quantile(seen, q)) for q in QUANTILES)
    x = np.array([model.features(t) for label in (0, 1) for t in parts[label][1]])
    model.curve = Logistic(x, np.repeat([0, 1], [len(parts[0][1]), len(parts[1][1])]))
    return model


def score(docs: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = THRESHOLD,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return scored(docs, fit(training_sample(docs, labels, label, id_col, text_col)), threshold, id_col, text_col)


def op7_compression_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
