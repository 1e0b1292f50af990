"""Benchmark decontamination with a distributed positional inverted index.

Index.  The index is partitioned by documents: a segment holds some
``SEGMENT_WORDS`` words of consecutive documents (a longer single document is a
segment of its own) and is one row of a Parquet table: its terms, and for each
term the ascending positions of all its occurrences, delta-coded and
compressed.  Documents follow each other in one position space with a gap that
no match can bridge.  Building needs no shuffle, any number of tasks can read
it, and a lost task rebuilds its own segments only.

Search.  Windows of ``WINDOW`` consecutive words of an item (one shorter window
for a shorter item) are looked up in every segment.  Windows with a term that
the segment lacks are dropped at once.  For the others the positions of the
rarest term, shifted by its offset, are intersected with the shifted positions
of the next rarer ones.  With ``slop`` each term may stand that many words away
from its exact place, counted from the window's first word (proximity), which
doesn't depend on the segments; exact phrases are those with none.

The test side is dealt by hash into parts of at most ``PART_BYTES``, counted
before anything is sent; matches of all parts are merged for each document.  A
part's windows are packed arrays (one number a word, a start and a size for
each distinct window), at most ``PACKED`` bytes for a counted byte, which is
checked before they are broadcast.  A segment's positions are unpacked only if
it has all terms of some window.  Both ``op6_positional_index`` and
``op6_positional_near`` give the exact matches and the items that are near
within ``SLOP`` words only.

Defined cases: null and wordless texts have no words and no hits; items
without words have no windows; an item without an id hits but isn't counted;
repeated items count once; empty tables give no hits or no rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textrec.llm.common import id_text, id_type, keep_where, ship_package, table, text_slices
from textrec.session import scratch_path

WINDOW = 10
SLOP = 2
#: More than a window and any sensible slop.
GAP = 64
SEGMENT_WORDS = 1 << 20
PART_BYTES = 4 << 20
#: Counted for an item beside its bytes; packed bytes for a counted one.
ITEM_BYTES = 64
PACKED = 24

#: Bytes of words are digits, lower-case letters and all beyond
#: ASCII; A-Z are lower-cased first; every other byte separates.
_TO_WORDS = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
                  for b in range(256))


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORDS).split()


class Segment:
    """Postings of some documents."""

    def __init__(self, terms: list[bytes], counts: np.ndarray, deltas, doc_words: np.ndarray):
        self.terms, self.counts, self._deltas = terms, counts, deltas
        self.doc_words = doc_words
        self.doc_start = np.cumsum(doc_words + GAP) - doc_words - GAP
        self.offsets = np.concatenate([[0], np.cumsum(counts)])
        self._open: dict[int, np.ndarray] = {}

    @classmethod
    def of(cls, texts: list[list[bytes]]) -> Segment:
        number: dict[bytes, int] = {}
        ids = np.array([number.setdefault(w, len(number)) for words in texts for w in words], np.int64)
        sizes = np.array([len(words) for words in texts], np.int64)
        at = np.arange(len(ids), dtype=np.int64) + np.repeat(GAP * np.arange(len(sizes)), sizes)
        order = np.argsort(ids, kind="stable")
        counts = np.bincount(ids, minlength=len(number))
        sorted_at = at[order]
        deltas = np.diff(sorted_at, prepend=0)
        first = np.cumsum(counts) - counts
        deltas[first] = sorted_at[first]
        return cls(list(number), counts, deltas, sizes)

    @property
    def deltas(self) -> np.ndarray:
        if callable(self._deltas):  # still packed
            self._deltas = self._deltas()
        return self._deltas

    def postings(self, term: int) -> np.ndarray:
        found = self._open.get(term)
        if found is None:
            found = self._open[term] = np.cumsum(self.deltas[self.offsets[term]:self.offsets[term + 1]])
        return found

    def packed(self) -> dict:
        wide = np.uint32 if not len(self.deltas) or self.deltas.max() < 1 << 32 else np.uint64
        z = zstandard.ZstdCompressor(level=1)
        return {"terms": z.compress(b" ".join(self.terms)), "counts": z.compress(self.counts.astype(np.uint32).tobytes()),
                "deltas": z.compress(self.deltas.astype(wide).tobytes()), "delta_bytes": np.dtype(wide).itemsize}

    @classmethod
    def unpacked(cls, row: dict) -> Segment:
        z = zstandard.ZstdDecompressor()
        return cls(z.decompress(row["terms"]).split(), np.frombuffer(z.decompress(row["counts"]), np.uint32).astype(np.int64),
                   lambda: np.frombuffer(z.decompress(row["deltas"]), f"<u{row['delta_bytes']}").astype(np.int64),
                   np.array(row["doc_words"], np.int64))


def ranks(ids: np.ndarray, size: int) -> np.ndarray:
    """A number for the ``size`` ids from each place on, equal where the ids
    are equal: numbers of doubled lengths are paired."""
    def paired(left, right, shift):
        right = np.concatenate([right[shift:], np.zeros(min(shift, len(right)), np.int64)])
        return np.unique(left * (len(ids) + 1) + right, return_inverse=True)[1].astype(np.int64)

    power, width = np.unique(ids, return_inverse=True)[1].astype(np.int64), 1
    out, done = None, 0
    while True:
        if size & width:
            out, done = (power if out is None else paired(out, power, done)), done + width
        if done == size:
            return out
        power, width = paired(power, power, width), 2 * width


class Windows:
    """The distinct windows of some items, over the items' own term numbers.

    ``tokens`` holds the items' words one after another, ``window`` zeros after
    each; a window is a place in it and a size."""

    def __init__(self, items: list[tuple[str | None, str | None]], window: int = WINDOW):
        number: dict[bytes, int] = {}
        self.items: list[str | None] = []
        self.window = window
        tokens, starts, sizes, owners, at = [], [], [], [], 0
        for item_id, text in items:
            ids = np.array([number.setdefault(w, len(number) + 1) for w in words_of(text or "")], np.int32)
            if len(ids):
                n = max(1, len(ids) - window + 1)
                tokens += [ids, np.zeros(window, np.int32)]
                starts.append(np.arange(at, at + n, dtype=np.int64))
                sizes.append(np.full(n, min(len(ids), window), np.int32))
                owners.append(np.full(n, len(self.items), np.int32))
                at += len(ids) + window
                self.items.append(item_id)
        self.terms = b" ".join(number)
        self.tokens, self.starts, self.sizes, owners = (
            np.concatenate(x) if x else np.zeros(0, kind)
            for x, kind in ((tokens, np.int32), (starts, np.int64), (sizes, np.int32), (owners, np.int32)))
        if len(self.starts):
            _, first, which = np.unique(ranks(self.tokens, window)[self.starts], return_index=True, return_inverse=True)
            self.starts, self.sizes = self.starts[first], self.sizes[first]
            pairs = np.unique(which.astype(np.int64) * len(self.items) + owners)
            which, owners = pairs // len(self.items), (pairs % len(self.items)).astype(np.int32)
            self.owner_at = np.searchsorted(which, np.arange(len(first) + 1))
        self.owners = owners

    def of(self, window: int) -> list[int]:
        """The items that hold a window."""
        return self.owners[self.owner_at[window]:self.owner_at[window + 1]].tolist()

    def nbytes(self) -> int:
        arrays = (self.tokens, self.starts, self.sizes, self.owners, *([self.owner_at] if len(self.starts) else []))
        return sum(x.nbytes for x in arrays) + len(self.terms) + sum(ITEM_BYTES + len(x or "") for x in self.items)


def search(segment: Segment, windows: Windows, slop: int = 0):
    """Matches in a segment: (window number, exact starts, near starts)."""
    if not segment.terms or not len(windows.starts):
        return
    place = {t: i for i, t in enumerate(segment.terms)}
    here = np.array([-2, *(place.get(t, -1) for t in windows.terms.split(b" "))], np.int64)[windows.tokens]  # -2: no word
    missing = np.concatenate([[0], np.cumsum(here == -1)])
    for number in np.flatnonzero(missing[windows.starts + windows.window] == missing[windows.starts]).tolist():
        start = windows.starts[number]
        terms = here[start:start + windows.sizes[number]].tolist()
        order = sorted(range(len(terms)), key=lambda i: (segment.counts[terms[i]], i))
        at = segment.postings(terms[order[0]]) - order[0]
        if slop and order[0]:  # the places of the first word that have the rarest in reach
            first, at = segment.postings(terms[0]), np.unique(np.add.outer(at, np.arange(-slop, slop + 1)))
            k = np.searchsorted(first, at)
            there = k < len(first)
            there[there] = first[k[there]] == at[there]
            at, order = at[there], [0, *(i for i in order if i)]
        exact = np.ones(len(at), bool)
        for i in order[1:]:
            if not len(at):
                break
            post = segment.postings(terms[i])
            k = np.searchsorted(post, at + i - slop)
            near = k < len(post)
            near[near] = post[k[near]] <= at[near] + i + slop
            at, exact = at[near], exact[near]
            if slop and len(at):
                k = np.minimum(np.searchsorted(post, at + i), len(post) - 1)
                exact &= post[k] == at + i
        if len(at):
            yield number, at[exact], at[~exact]


def matches(segment: Segment, windows: Windows, slop: int = 0) -> dict[int, tuple[list, set, set]]:
    """For each document with matches: merged spans of hit words (in words of
    the document), items found exactly, items found near only."""
    spans: dict[int, list] = {}
    exact_items: dict[int, set] = {}
    near_items: dict[int, set] = {}
    for number, exact, near in search(segment, windows, slop):
        size, items_here = int(windows.sizes[number]), windows.of(number)
        for starts, items in ((exact, exact_items), (near, near_items)):
            docs = np.searchsorted(segment.doc_start, starts, "right") - 1
            for doc, at in zip(docs.tolist(), (starts - segment.doc_start[docs]).tolist(), strict=True):
                items.setdefault(doc, set()).update(items_here)
                if items is exact_items:
                    spans.setdefault(doc, []).append((at, at + size))
    out = {}
    for doc in {*exact_items, *near_items}:
        found = exact_items.get(doc, set())
        ids = lambda items: {windows.items[i] for i in items} - {None}
        out[doc] = merged(spans.get(doc, [])), ids(found), ids(near_items.get(doc, set())) - ids(found)
    return out


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def grouped(texts: list[str], sizes_left: int):
    """Word lists of consecutive texts, cut where a segment is full (a text
    counts as one word more than it has)."""
    group, n = [], 0
    for text in texts:
        words = words_of(text)
        if group and n + len(words) + 1 > sizes_left:
            yield group
            group, n = [], 0
        group.append(words)
        n += len(words) + 1
    if group:
        yield group


# ---- Spark --------------------------------------------------------------

def build_index(docs: DataFrame, folder: str, id_col: str = "doc_id", text_col: str = "text",
                segment_words: int = SEGMENT_WORDS) -> DataFrame:
    """Write the index of all texts into ``folder`` and return it."""
    ship_package(docs.sparkSession)
    pairs = id_text(docs, id_col, text_col)
    id_name = id_type(pairs)

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        ids, words, n, id_arrow = [], [], 0, None

        def flush():
            seg = Segment.of(words)
            row = seg.packed() | {"doc_words": seg.doc_words.tolist()}
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + number], pa.int64()), pa.array([ids], pa.list_(id_arrow)),
                 pa.array([row["doc_words"]], pa.list_(pa.int64())),
                 *(pa.array([row[c]], pa.binary()) for c in ("terms", "counts", "deltas")),
                 pa.array([row["delta_bytes"]], pa.int32())],
                names=["segment", "doc_ids", "doc_words", "terms", "counts", "deltas", "delta_bytes"])

        for rows, texts in text_slices(batches):
            id_arrow = rows.schema.field(0).type
            for doc_id, text in zip(rows.column(0).to_pylist(), texts, strict=True):
                found = words_of(text)
                if n and n + len(found) + 1 > segment_words:
                    yield flush()
                    number, ids, words, n = number + 1, [], [], 0
                ids.append(doc_id)
                words.append(found)
                n += len(found) + 1
        if ids:
            yield flush()

    pairs.mapInArrow(run, f"segment bigint, doc_ids array<{id_name}>, doc_words array<bigint>, terms binary, "
                          "counts binary, deltas binary, delta_bytes int").write.option("compression", "none").parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def item_parts(items: DataFrame, id_col: str = "item_id", text_col: str = "text", limit: int = PART_BYTES) -> list[DataFrame]:
    """The items in parts by hash, each of at most ``limit`` bytes of text and
    ids, ``ITEM_BYTES`` more for an item, unless it is a single row.  Sizes are
    counted before anything is sent."""
    pairs = items.select(F.col(id_col).cast("string").alias("item_id"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = F.sum(F.octet_length("text") + F.coalesce(F.octet_length("item_id"), F.lit(0)) + ITEM_BYTES)
    total = pairs.agg(size).first()[0] or 0
    n = -(-total // limit) if total else 1
    while True:
        key = F.pmod(F.xxhash64("item_id", "text"), F.lit(n))
        if n == 1:
            return [pairs]
        over = (pairs.groupBy(key.alias("part"), "item_id", "text").agg(F.lit(1)).groupBy("part")
                .agg(size.alias("size"), F.count("*").alias("rows"))
                .where((F.col("size") > limit) & (F.col("rows") > 1)).limit(1).collect())
        if not over:
            return [pairs.where(key == i).distinct() for i in range(n)]
        n *= 2


def windows_of(part: DataFrame) -> Windows:
    """Windows of one part, whose size has been counted; what is built from it
    is checked too."""
    rows = part.orderBy("item_id", "text").collect()
    built = Windows([(r.item_id, r.text) for r in rows])
    counted = sum(len(r.text.encode("utf-8", "surrogatepass")) + len(r.item_id or "") + ITEM_BYTES for r in rows)
    if built.nbytes() > PACKED * counted:
        raise ValueError(f"windows of {counted} bytes take {built.nbytes()}")
    return built


def find(index: DataFrame, items: DataFrame, slop: int = 0, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per document of the index: doc_id, n_words, spans (merged, in
    words, end exclusive), items (exact), near_items (proximity only)."""
    if not 0 <= slop <= GAP - WINDOW:
        raise ValueError(f"slop must be 0 to {GAP - WINDOW}")
    spark = index.sparkSession
    ship_package(spark)

    def hits(part: DataFrame) -> DataFrame:
        shared = spark.sparkContext.broadcast(windows_of(part))

        def run(batches):
            windows = shared.value
            for batch in batches:
                for i in range(batch.num_rows):
                    row = batch.slice(i, 1).to_pylist()[0]
                    found = sorted(matches(Segment.unpacked(row), windows, slop).items())
                    if found:
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([row["segment"]] * len(found), pa.int64()),
                             pa.array([d for d, _ in found], pa.int32()),
                             pa.array([[{"s": s, "e": e} for s, e in m[0]] for _, m in found],
                                      pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))),
                             pa.array([sorted(m[1]) for _, m in found], pa.list_(pa.string())),
                             pa.array([sorted(m[2]) for _, m in found], pa.list_(pa.string()))],
                            names=["segment", "doc", "spans", "items", "near_items"])

        return index.select("segment", "doc_words", "terms", "counts", "deltas", "delta_bytes").mapInArrow(
            run, "segment bigint, doc int, spans array<struct<s:bigint,e:bigint>>, items array<string>, "
                 "near_items array<string>")

    found = None
    for part in item_parts(items, id_col, text_col):
        found = hits(part) if found is None else found.unionByName(hits(part))
    spans, ids = "array<struct<s:bigint,e:bigint>>", "array<string>"
    one = found.groupBy("segment", "doc").agg(
        F.array_sort(F.flatten(F.collect_list("spans"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        F.array_distinct(F.flatten(F.collect_list("near_items"))).alias("near_items"))
    docs = index.select("segment", F.posexplode(F.arrays_zip("doc_ids", "doc_words")).alias("doc", "d")).select(
        "segment", "doc", F.col("d.doc_ids").alias("doc_id"), F.col("d.doc_words").alias("n_words"))
    none = lambda kind: F.array().cast(kind)
    return docs.join(one, ["segment", "doc"], "left").select(
        "doc_id", "n_words", F.coalesce(join_spans("spans"), none(spans)).alias("spans"),
        F.coalesce("items", none(ids)).alias("items"),
        F.coalesce(F.array_except("near_items", "items"), none(ids)).alias("near_items"))


def join_spans(column: str):
    """Sorted spans with overlapping ones joined."""
    grow = lambda acc, x: F.when(
        (F.size(acc) > 0) & (x["s"] <= F.element_at(acc, -1)["e"]),
        F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
            F.element_at(acc, -1)["s"].alias("s"), F.greatest(F.element_at(acc, -1)["e"], x["e"]).alias("e"))))
    ).otherwise(F.concat(acc, F.array(x)))
    return F.aggregate(column, F.array().cast("array<struct<s:bigint,e:bigint>>"), grow)


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", id_col: str = "item_id",
                  item_text: str = "text") -> DataFrame:
    """The documents without a window of any item, all columns unchanged.  The
    rows go through segments of their own task, a part of the items a pass, so
    that nothing needs to be joined back."""
    spark = docs.sparkSession
    ship_package(spark)
    out = docs
    for part in item_parts(items, id_col, item_text):
        shared = spark.sparkContext.broadcast(windows_of(part))

        def mask(texts, shared=shared):
            kept = []
            for words in grouped(texts, SEGMENT_WORDS):
                found = matches(Segment.of(words), shared.value)
                kept += [not (i in found and found[i][0]) for i in range(len(words))]
            return kept

        out = keep_where(out, mask, text_col)
    return out


def findings(spark: SparkSession, sf_dir: str, slop: int) -> DataFrame:
    index = build_index(table(spark, sf_dir, "documents"), scratch_path(spark, "postings"))
    found = find(index, table(spark, sf_dir, "benchmark"), slop)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, x: n + x["e"] - x["s"])
    digest = lambda items: F.sha2(F.array_join(items, ","), 256)
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
                        digest("items").alias("items_sha256"), (hit > 0).alias("contaminated"),
                        F.size("near_items").cast("bigint").alias("n_near_items"),
                        F.array_sort("near_items").alias("near_items"))


def op6_positional_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact matches, and the items near within ``SLOP`` words only by number
    and digest."""
    near = F.sha2(F.array_join("near_items", ","), 256)
    return findings(spark, sf_dir, SLOP).withColumn("near_items_sha256", near).drop("near_items")


def op6_positional_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``op6_positional_index`` with the near items themselves."""
    return findings(spark, sf_dir, SLOP)
