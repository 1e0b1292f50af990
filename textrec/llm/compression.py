"""Quality rules: compression bands.

A text is compressed with zstandard, whole and in fixed chunks of
``CHUNK_BYTES``.  Repetitive text compresses far better than other text of its
length, noise far worse.  What is usual depends on the length (a short text
compresses little), so texts are put in length bands, two for each doubling of
the byte length, and each band has its own limits.

The limits come from all documents with text, each distinct text counted
once, so that copies don't become the norm: Spark groups the ratios by a hash
of the text and counts an exact histogram of ratios (in thousandths) for each
band.  A band's limits are its median minus/plus ``SPREAD_LOW`` /
``SPREAD_HIGH`` robust standard deviations (1.4826 x median absolute
deviation), at least ``FLOOR`` of the median.  No band's deviation is below
that of the typical band (a share of the median), and a band with fewer than
``MIN_TEXTS`` texts takes its neighbours in, up to ``REACH`` bands on either
side.  The histogram is bounded (bands x ratios), whatever the input.  A text
without another one in reach is judged by its chunks only.  ``fit_limits`` has
the plain limits over rows, each band by itself.

Defined cases: null text counts as empty (no words, fails the base rules);
empty tables give an empty result; repeated rows are judged alike; a text of
any length is compressed whole."""

from __future__ import annotations

import hashlib
from collections import Counter
from dataclasses import dataclass, field

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textrec.llm.common import id_text, id_type, keep_where, ship_package, table, text_slices

CHUNK_BYTES = 2048
LEVEL = 3
SPREAD_LOW = 3.0
SPREAD_HIGH = 6.0
FLOOR = 0.08
#: A band with fewer distinct texts takes in its neighbours up to REACH bands
#: away (a factor of four in length).
MIN_TEXTS = 30
REACH = 4
#: A text fails when more than this share of its full chunks is out of limits.
CHUNK_SHARE = 0.25
MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT_PERCENT = 20

#: The symbols counted by the base rules.
SYMBOLS = "#*$%&|<>"
_NOT_SYMBOL = {i: None for i in range(128) if chr(i) not in SYMBOLS}
#: Code points 0x09-0x0D and 0x20 separate words.
_BLANKS = bytes([9, 10, 11, 12, 13, 32])


@dataclass(frozen=True)
class Limits:
    """(low, high) in thousandths by length band; chunks have one pair."""
    whole: dict[int, tuple[float, float]] = field(default_factory=dict)
    chunk: tuple[float, float] = (0.0, float("inf"))


def band(n_bytes: int) -> int:
    """Two bands for each doubling of the length."""
    if n_bytes < 2:
        return n_bytes
    top = n_bytes.bit_length()
    return 2 * top + ((n_bytes >> (top - 2)) & 1)


def repeated_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that occur twice or more in the text."""
    if len(words) <= WINDOW:
        return 0
    windows = list(zip(*(words[i:] for i in range(WINDOW)), strict=False))
    counts = Counter(windows)
    if len(counts) == len(windows):
        return 0
    covered, end = 0, 0
    for i, w in enumerate(windows):
        if counts[w] > 1:
            covered += i + WINDOW - max(i, end)
            end = i + WINDOW
    return covered


def duplicate_lines(raw: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in raw.split(b"\n") if x.strip(_BLANKS)]
    return len(lines) - len(set(lines))


def base_measures(text: str) -> tuple[int, int, int, int, int, bool]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    n = len(words)
    blanks = len(raw) - len(raw.translate(None, _BLANKS))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS.encode()))
    repeat = repeated_words(words)
    return (n, len(text) - blanks, symbols, duplicate_lines(raw), repeat,
            n < MIN_WORDS or 100 * repeat > MAX_REPEAT_PERCENT * n)


class Ratios:
    """Compressed size in thousandths of the size, whole and of full chunks."""

    def __init__(self):
        self.compress = zstandard.ZstdCompressor(level=LEVEL, write_checksum=False,
                                                 write_content_size=False).compress

    def of(self, raw: bytes) -> tuple[int, list[int]]:
        if not raw:
            return 1000, []
        whole = 1000 * len(self.compress(raw)) // len(raw)
        chunks = [1000 * len(self.compress(raw[i:i + CHUNK_BYTES])) // CHUNK_BYTES
                  for i in range(0, len(raw) - CHUNK_BYTES + 1, CHUNK_BYTES)]
        return whole, chunks


def distinct_histogram(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """kind (w, c), band, ratio, n, with each distinct text counted once.  What is
    grouped is a hash of the text and its ratios; copies are combined in their
    tasks."""
    ship_package(docs.sparkSession)

    def run(batches):
        ratios = Ratios()
        for _, texts in text_slices(batches):
            raws = [t.encode("utf-8", "surrogatepass") for t in texts if t]
            found = [ratios.of(raw) for raw in raws]
            yield pa.RecordBatch.from_pydict({
                "key": pa.array([hashlib.blake2b(raw, digest_size=16).digest() for raw in raws], pa.binary()),
                "band": pa.array([band(len(raw)) for raw in raws], pa.int32()),
                "ratio": pa.array([whole for whole, _ in found], pa.int32()),
                "chunks": pa.array([chunks for _, chunks in found], pa.list_(pa.int32()))})

    texts = (docs.select(F.col(text_col).cast("string").alias("text"))
             .mapInArrow(run, "key binary, band int, ratio int, chunks array<int>").distinct())
    whole = F.struct(F.lit("w").alias("kind"), "band", "ratio")
    chunks = F.transform("chunks", lambda c: F.struct(F.lit("c").alias("kind"), F.lit(0).alias("band"), c.alias("ratio")))
    return (texts.select(F.explode(F.concat(F.array(whole), chunks)).alias("x")).select("x.*")
            .groupBy("kind", "band", "ratio").agg(F.count("*").alias("n")))


def weighted_median(counts: dict[float, int]) -> float:
    """Mean of the lower and the upper median."""
    total, seen, low = sum(counts.values()), 0, None
    for value in sorted(counts):
        seen += counts[value]
        if low is None and 2 * seen >= total:
            low = value
        if 2 * seen > total:
            return (low + value) / 2
    return 0.0


def spread_of(counts: dict[int, int]) -> tuple[float, float]:
    """Median and robust standard deviation."""
    mid = weighted_median(counts)
    off = Counter()
    for ratio, n in counts.items():
        off[abs(ratio - mid)] += n
    return mid, 1.4826 * weighted_median(off)


def limits_of(counts: dict[int, int], least: float = 0.0) -> tuple[float, float]:
    """``least``: the smallest deviation, as a share of the median."""
    mid, sigma = spread_of(counts)
    sigma = max(sigma, least * mid)
    return (mid - max(SPREAD_LOW * sigma, FLOOR * mid), mid + max(SPREAD_HIGH * sigma, FLOOR * mid))


def collected(counts: DataFrame) -> tuple[dict[int, dict[int, int]], dict[int, int]]:
    """The histogram of whole texts by band, and that of chunks: at most a few
    thousand ratios for each of some 70 bands."""
    whole: dict[int, dict[int, int]] = {}
    chunk: dict[int, int] = {}
    for kind, b, ratio, n in counts.collect():
        if kind == "w":
            whole.setdefault(b, {})[ratio] = n
        else:
            chunk[ratio] = n
    return whole, chunk


def pooled(whole: dict[int, dict[int, int]], b: int) -> Counter:
    """Ratios of a band, with those of the nearest bands if it is thin."""
    out = Counter(whole[b])
    for d in range(1, REACH + 1):
        if out.total() >= MIN_TEXTS:
            break
        for other in (b - d, b + d):
            out.update(whole.get(other, {}))
    return out


def fit_norms(docs: DataFrame, text_col: str = "text") -> Limits:
    """The limits that texts are judged by: from distinct texts, thin bands
    pooled, deviations not below the typical band's."""
    whole, chunk = collected(distinct_histogram(docs, text_col))
    pools = {b: pooled(whole, b) for b in whole}
    spreads = [spread_of(c) for c in pools.values() if c.total() >= MIN_TEXTS]
    least = weighted_median(Counter(sigma / mid for mid, sigma in spreads)) if spreads else 0.0
    return Limits({b: limits_of(c, least) for b, c in pools.items()}, limits_of(chunk) if chunk else Limits.chunk)


def verdict(raw: bytes, ratios: Ratios, limits: Limits) -> tuple[bool, int, int, int]:
    """kept, whole ratio, full chunks, chunks out of limits."""
    whole, chunks = ratios.of(raw)
    low, high = limits.whole.get(band(len(raw)), (0.0, float("inf")))
    c_low, c_high = limits.chunk
    bad = sum(not c_low <= c <= c_high for c in chunks)
    return low <= whole <= high and bad <= CHUNK_SHARE * len(chunks), whole, len(chunks), bad


def measure(docs: DataFrame, limits: Limits, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: base measures, ratios and the verdict."""
    ship_package(docs.sparkSession)
    pairs = id_text(docs, id_col, text_col)

    def run(batches):
        ratios = Ratios()
        for rows, texts in text_slices(batches):
            out = []
            for text in texts:
                base = base_measures(text)
                kept, whole, n, bad = verdict(text.encode("utf-8", "surrogatepass"), ratios, limits)
                out.append((*base, kept and not base[-1], whole, n, bad))
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), *(pa.array(c, pa.bool_() if name in ("base_failed", "kept") else pa.int64())
                                   for name, c in zip(NAMES[1:], cols, strict=True))], names=NAMES)

    return pairs.mapInArrow(run, f"doc_id {id_type(pairs)}, n_words bigint, word_chars bigint, n_symbols bigint, "
                                 "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, "
                                 "ratio_permille bigint, n_chunks bigint, n_bad_chunks bigint")


NAMES = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
         "ratio_permille", "n_chunks", "n_bad_chunks"]


def filter_documents(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that pass the base rules and the compression bands, all
    columns unchanged."""
    limits = fit_norms(docs, text_col)

    def mask(texts):
        ratios = Ratios()
        return [not base_measures(t)[-1] and verdict(t.encode("utf-8", "surrogatepass"), ratios, limits)[0]
                for t in texts]

    return keep_where(docs, mask, text_col)


def op2_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return measure(docs, fit_norms(docs))
