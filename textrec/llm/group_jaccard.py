"""N-gram Jaccard join by token groups.

Two documents link when 100 x intersection >= 75 x union of their sets of
5-word shingles.  A document can only link to a set of documents whose token
union holds 75 % of its own tokens, since the intersection is at least 75 % of
either set.  This bound is used at two levels, always before any pair is made:

1. Against all other documents as one group.  Tasks send each distinct token of
   a chunk of documents once to the token's bucket (4 bytes and a document
   number; a token that several documents of the chunk share is only sent as a
   witness with its count), and a bucket tells each chunk how many of the
   tokens that it asked for others have too.  Documents with fewer than 75 %
   shared tokens have no partner and are done.
2. Documents with equal sets become one class.  Classes are put in groups of
   similar ones: among the classes that share a token of their prefix (the
   tokens that a partner can't miss all of, rarest first) the first is the
   leader, each of the others is compared with it, and what links forms
   groups.  Members of a group are connected, so no pair inside a group matters
   any more.
3. Between groups: a class and another group that share a prefix token are a
   query and a group of the token-group matrix, if the tokens that both have
   from the shared one on in the common order can make up a link.  A group is
   dealt into sub-groups of a few similar sets, each with its token union, which
   bounds the overlap; only the members of qualifying sub-groups are compared
   with the query.  What links joins groups.

So the work inside a group of N near copies is N comparisons for each leader,
never N x N, and the result is exact: every linked pair shares a prefix token,
and a pair goes unchecked only if both are known to be connected or the bound
rules it out.  Tokens are 64-bit hashes of shingles, sets are compared by them.

Tokens frequent over all documents come last in the order (the ``HOT_TOKENS``
most frequent, counted exactly; any order gives the same result).

Defined cases: null, empty and blank texts have no shingles and link with
nothing; fewer than five words are one shingle; rows without an id take part,
and a component's id is its smallest id that isn't null; repeated rows are
documents of one class; empty tables give an empty result."""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textrec.llm.common import fresh, id_type, ship_package, table, text_slices
from textrec.session import discard, materialize

WORDS = 5
PERCENT = 75
#: Shingles and documents in a chunk; text bytes for each bucket of tokens.
CHUNK_SHINGLES = 1 << 20
CHUNK_DOCS = 1 << 16
BUCKET_BYTES = 8 << 20
HOT_TOKENS = 1 << 18
HOT_DF = 16
#: Sizes in one band differ by less than this factor, above 100 / PERCENT, so
#: that partners are in the same or in neighbouring bands.
BAND = 1.34

_MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection that spreads all bits (the published splitmix64 finaliser)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    known: dict[bytes, int] = {}
    digest = xxhash.xxh3_64_intdigest
    split = [t.encode("utf-8", "surrogatepass").lower().split() for t in texts]
    for words in split:
        for w in words:
            if w not in known:
                known[w] = digest(w)
    flat = np.array([known[w] for words in split for w in words], np.uint64)
    sizes = [len(words) for words in split]
    with np.errstate(over="ignore"):
        n = max(0, len(flat) - WORDS + 1)
        h = np.zeros(n, np.uint64)
        for i in range(WORDS):
            h = (h + flat[i:i + n]) * _MULTIPLY
        h = mix(h)
        out, at = [], 0
        for size in sizes:
            if size >= WORDS:
                out.append(np.unique(h[at:at + size - WORDS + 1]))
            elif size:
                one = np.uint64(size)
                for x in flat[at:at + size]:
                    one = (one + x) * _MULTIPLY
                out.append(mix(np.array([one])))
            else:
                out.append(np.zeros(0, np.uint64))
            at += size
    return out


def set_key(tokens: np.ndarray) -> bytes:
    return hashlib.md5(tokens.tobytes()).digest()


#: Keys of texts and classes have 124 bits, as whole numbers in a decimal: of
#: fixed width for joins and hash aggregates, and beyond collisions.
KEY = "decimal(38,0)"
KEY_BITS = 62


def class_id(key: bytes) -> Decimal:
    return Decimal(int.from_bytes(key, "little") >> (128 - 2 * KEY_BITS))


def text_key(text: Column) -> Column:
    """Two hashes of a text with different seeds; null where the text is."""
    low = F.lit((1 << KEY_BITS) - 1)
    halves = [h.bitwiseAND(low).cast(KEY) for h in (F.xxhash64(text), F.xxhash64(F.lit("second"), text))]
    return F.when(text.isNotNull(), (halves[0] * F.lit(1 << KEY_BITS).cast("decimal(19,0)") + halves[1]).cast(KEY))


def bucket_token(tokens: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Where a token is counted, and its 32 bits there."""
    return (tokens % np.uint64(buckets)).astype(np.int64), (tokens >> np.uint64(32)).astype(np.uint32)


def enough(shared, size):
    return 100 * shared >= PERCENT * size


def prefix_size(n: int) -> int:
    """Two linked sets can't differ in all of the first so many tokens."""
    return n - -(-PERCENT * n // 100) + 1


# ---- 1. documents whose tokens others share ------------------------------

def info_bucket(number: int, buckets: int) -> int:
    """A negative bucket from the mixed bits of a chunk's number, whose low bits
    are zero for the first chunk of each partition."""
    return -1 - ((number * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF) >> 32) % buckets


class Chunk:
    """Sets of consecutive documents on their way to the buckets."""

    def __init__(self, number: int):
        self.number, self.ids, self.text_keys, self.sets, self.n = number, [], [], [], 0

    def rows(self, buckets: int, id_arrow: pa.DataType, schema: pa.Schema) -> pa.RecordBatch:
        z = zstandard.ZstdCompressor(level=1)
        sizes = np.array([len(s) for s in self.sets], np.int64)
        tokens = np.concatenate(self.sets) if self.sets else np.zeros(0, np.uint64)
        docs = np.repeat(np.arange(len(sizes)), sizes)
        distinct, place, counts = np.unique(tokens, return_inverse=True, return_counts=True)
        shared_here = counts[place] > 1
        own = np.bincount(docs[shared_here], minlength=len(sizes))
        out = [{"bucket": info_bucket(self.number, buckets), "chunk": self.number, "doc_ids": self.ids,
                "text_keys": self.text_keys, "sizes": sizes.tolist(), "own": own.tolist(),
                "keys": [set_key(s) for s in self.sets]}]
        asked, asked_docs = tokens[~shared_here], docs[~shared_here]
        seen, seen_counts = distinct[counts > 1], counts[counts > 1]
        a_bucket, a_token = bucket_token(asked, buckets)
        s_bucket, s_token = bucket_token(seen, buckets)
        a_order, s_order = np.argsort(a_bucket, kind="stable"), np.argsort(s_bucket, kind="stable")
        a_cut = np.searchsorted(a_bucket[a_order], np.arange(buckets + 1))
        s_cut = np.searchsorted(s_bucket[s_order], np.arange(buckets + 1))
        for b in range(buckets):
            a, s = a_order[a_cut[b]:a_cut[b + 1]], s_order[s_cut[b]:s_cut[b + 1]]
            if len(a) or len(s):
                out.append({"bucket": b, "chunk": self.number, "asked": a_token[a].tobytes(),
                            "docs": z.compress(np.diff(asked_docs[a], prepend=0).astype(np.uint32).tobytes()),
                            "seen": s_token[s].tobytes(),
                            "seen_counts": z.compress(seen_counts[s].astype(np.uint32).tobytes())})
        return pa.RecordBatch.from_pylist(out, schema=schema)


def numbers(data: bytes | None, packed: bool = False) -> np.ndarray:
    if not data:
        return np.zeros(0, np.uint32)
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data) if packed else data, np.uint32)


INFO = "doc_ids array<{id}>, text_keys array<" + KEY + ">, sizes array<bigint>, own array<bigint>, keys array<binary>"


_KEY = pa.decimal128(38, 0)


def info_fields(id_arrow: pa.DataType) -> list:
    longs = pa.list_(pa.int64())
    return [("doc_ids", pa.list_(id_arrow)), ("text_keys", pa.list_(_KEY)), ("sizes", longs), ("own", longs),
            ("keys", pa.list_(pa.binary()))]


def chunk_schema(id_arrow: pa.DataType) -> pa.Schema:
    return pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("asked", pa.binary()), ("docs", pa.binary()),
                      ("seen", pa.binary()), ("seen_counts", pa.binary()), *info_fields(id_arrow)])


def answer_schema(id_arrow: pa.DataType) -> pa.Schema:
    return pa.schema([("kind", pa.string()), ("chunk", pa.int64()), ("docs", pa.binary()), ("shared", pa.binary()),
                      ("token", pa.int64()), ("df", pa.int64()), *info_fields(id_arrow)])


def answer(rows: pa.Table) -> pa.Table:
    """What a bucket finds: for each chunk the shared tokens of its documents,
    and the tokens that are frequent over all chunks."""
    id_arrow = rows.schema.field("doc_ids").type.value_type
    schema, bucket = answer_schema(id_arrow), rows.column("bucket")[0].as_py()
    if bucket < 0:
        info = rows.select(["chunk", "doc_ids", "text_keys", "sizes", "own", "keys"]).to_pylist()
        return pa.Table.from_pylist([{"kind": "info", **r} for r in info], schema=schema)
    z = zstandard.ZstdCompressor(level=1)
    chunks = rows.column("chunk").to_pylist()
    asked = [numbers(x) for x in rows.column("asked").to_pylist()]
    seen = [numbers(x) for x in rows.column("seen").to_pylist()]
    seen_counts = [numbers(x, True) for x in rows.column("seen_counts").to_pylist()]
    everything = np.concatenate(asked + seen)
    distinct, place = np.unique(everything, return_inverse=True)
    weight = np.concatenate([np.ones(sum(map(len, asked)), np.int64), *[c.astype(np.int64) for c in seen_counts]])
    df = np.bincount(place, weights=weight, minlength=len(distinct)).astype(np.int64)
    out, at = [], 0
    for chunk, tokens, packed in zip(chunks, asked, rows.column("docs").to_pylist(), strict=True):
        docs = np.cumsum(numbers(packed, True).astype(np.int64))[df[place[at:at + len(tokens)]] > 1]
        at += len(tokens)
        if len(docs):
            which, count = np.unique(docs, return_counts=True)
            out.append({"kind": "shared", "chunk": chunk,
                        "docs": z.compress(np.diff(which, prepend=0).astype(np.uint32).tobytes()),
                        "shared": z.compress(count.astype(np.uint32).tobytes())})
    for t in np.flatnonzero(df >= HOT_DF):
        out.append({"kind": "hot", "token": (bucket << 32) | int(distinct[t]), "df": int(df[t])})
    return pa.Table.from_pylist(out, schema=schema)


def add_up(rows: pa.Table) -> pa.Table:
    """One row per document of a chunk: its size, key and shared tokens."""
    info = rows.filter(pa.compute.equal(rows.column("kind"), "info")).to_pylist()[0]
    shared = np.array(info["own"], np.int64)
    for docs, counts in zip(rows.column("docs").to_pylist(), rows.column("shared").to_pylist(), strict=True):
        if docs:
            shared[np.cumsum(numbers(docs, True).astype(np.int64))] += numbers(counts, True)
    id_arrow = rows.schema.field("doc_ids").type.value_type
    return pa.Table.from_arrays(
        [pa.array(info["doc_ids"], id_arrow), pa.array(info["text_keys"], _KEY),
         pa.array(info["sizes"], pa.int64()), pa.array([class_id(k) for k in info["keys"]], _KEY),
         pa.array(shared, pa.int64())], names=["doc_id", "text_key", "n_shingles", "class", "shared"])


def bucket_count(pairs: DataFrame) -> int:
    total = pairs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(1, -(-total // BUCKET_BYTES))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, text_key (a hash of the text)."""
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .withColumn("text_key", text_key(F.col("text")))


def coverage(pairs: DataFrame, buckets: int) -> DataFrame:
    """Answers of all buckets (see ``answer``)."""
    info = INFO.format(id=id_type(pairs))

    def run(batches):
        part, number = TaskContext.get().partitionId(), 0
        chunk, id_arrow = Chunk(part << 24), None
        for rows, texts in text_slices(batches):
            id_arrow = rows.schema.field(0).type
            for doc_id, key, tokens in zip(rows.column(0).to_pylist(), rows.column(2).to_pylist(),
                                           shingle_sets(texts), strict=True):
                if (chunk.n and chunk.n + len(tokens) > CHUNK_SHINGLES) or len(chunk.ids) >= CHUNK_DOCS:
                    yield chunk.rows(buckets, id_arrow, chunk_schema(id_arrow))
                    number += 1
                    chunk = Chunk((part << 24) + number)
                chunk.ids.append(doc_id)
                chunk.text_keys.append(key)
                chunk.sets.append(tokens)
                chunk.n += len(tokens)
        if chunk.ids:
            yield chunk.rows(buckets, id_arrow, chunk_schema(id_arrow))

    sent = pairs.mapInArrow(run, "bucket bigint, chunk bigint, asked binary, docs binary, seen binary, "
                                 f"seen_counts binary, {info}")
    return sent.groupBy("bucket").applyInArrow(
        answer, f"kind string, chunk bigint, docs binary, shared binary, token bigint, df bigint, {info}")


# ---- 2. and 3. classes, groups and links ---------------------------------

#: Multiplication by an odd number is a bijection of 58 bits.
ODD = 0x9E3779B97F4A7C15


def class_sets(reps: DataFrame, kept: DataFrame, hot: np.ndarray, buckets: int) -> DataFrame:
    """id, class, n, shared and the tokens in the common order (rarest first).
    An id begins with how few of the tokens others share, so that the smallest
    ids are the most central sets; what follows is the set's own number, spread
    by a bijection, so that ties are broken without regard to the order of rows."""
    shared = reps.sparkSession.sparkContext.broadcast(hot)  # two longs for each of at most HOT_TOKENS tokens

    def run(batches):
        known, df = shared.value
        number = TaskContext.get().partitionId() << 33
        for rows, texts in text_slices(batches):
            out = []
            for cls, also, tokens in zip(rows.column(1).to_pylist(), rows.column(2).to_pylist(),
                                         shingle_sets(texts), strict=True):
                rank = np.zeros(len(tokens), np.int64)
                if len(known):
                    bucket, low = bucket_token(tokens, buckets)
                    key = (bucket << 32) | low.astype(np.int64)
                    at = np.minimum(np.searchsorted(known, key), len(known) - 1)
                    rank = np.where(known[at] == key, df[at], 0)
                order = np.lexsort((tokens, rank))
                n = len(tokens)
                out.append(((31 - 31 * also // n << 58) | (number * ODD & ((1 << 58) - 1)), cls, n, also,
                            tokens[order].view(np.int64)))
                number += 1
            if out:
                cols = list(zip(*out, strict=True))
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], _KEY),
                                                  *(pa.array(c, pa.int64()) for c in cols[2:4]),
                                                  pa.array(cols[4], pa.list_(pa.int64()))],
                                                 names=["id", "class", "n", "shared", "tokens"])

    return reps.join(kept, "class").select("text", "class", "shared").mapInArrow(
        run, f"id bigint, class {KEY}, n bigint, shared bigint, tokens array<bigint>")


def prefix_lists(sets: DataFrame) -> DataFrame:
    """list, id, n, shared, rest: sets under each token of their prefix, for their
    size band and for the next one; ``rest`` of the set's tokens stand from this
    one on in the common order."""
    band = F.floor(F.log("n") / F.log(F.lit(BAND))).cast("int")
    prefix = F.slice("tokens", 1, (F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1).cast("int"))
    return (sets.select("id", "n", "shared", band.alias("band"), F.posexplode(prefix).alias("at", "token"))
            .select("id", "n", "shared", (F.col("n") - F.col("at")).alias("rest"),
                    F.explode(F.array(F.xxhash64("token", "band"), F.xxhash64("token", F.col("band") + 1))).alias("list")))


def may_link(shared_a, shared_b, n_a, n_b):
    """The intersection is at most the smaller number of shared tokens, and a
    link needs (100 + PERCENT) x intersection >= PERCENT x both sizes."""
    return F.least(shared_a, shared_b) * (100 + PERCENT) >= (n_a + n_b) * PERCENT


def compared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs (a, b) of sets that link; the bound is checked before any set is
    fetched."""
    sizes = sets.select("id", "n", "shared")
    a, b = (sizes.select(F.col("id").alias(x), F.col("n").alias(f"n_{x}"), F.col("shared").alias(f"s_{x}")) for x in "ab")
    near = materialize(pairs.join(a, "a").join(b, "b")
                       .where(may_link(F.col("s_a"), F.col("s_b"), F.col("n_a"), F.col("n_b")))
                       .select("a", "b", "n_a", "n_b"), "pairs")
    a, b = (sets.select(F.col("id").alias(x), F.col("tokens").alias(f"t_{x}")) for x in "ab")
    return (near.join(a, "a").join(b, "b").withColumn("both", F.size(F.array_intersect("t_a", "t_b")))
            .where(enough(F.col("both"), F.col("n_a") + F.col("n_b") - F.col("both"))).select("a", "b"))


def components(links: DataFrame) -> DataFrame:
    """node, root (smallest node that links reach), for nodes with links, by
    alternating large-star and small-star steps until nothing changes."""
    edges = materialize(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .where("a != b").distinct(), "edges")
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("root"))
        joined = large.join(least, "a")
        small = joined.select(F.col("b").alias("a"), F.col("root").alias("b")).unionByName(joined.select("a", F.col("root").alias("b")))
        before, edges = edges, materialize(small.where("a != b").distinct(), "edges")
        discard(before)
        now = tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == state:
            break
        state = now
    roots = edges.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


#: Sets in a sub-group, which has a token union of its own (about; they are dealt by hash).
SUB_SETS = 8
#: Leaders of a list: the most central set, ties broken in so many ways.
LEADER_MASKS = (0, (1 << 58) - 1, 0x155555555555555, 0x2AAAAAAAAAAAAAA, 0x333333333333333)


def grouped_links(sets: DataFrame) -> DataFrame:
    """Links between sets that connect all that any links connect."""
    lists = prefix_lists(sets)
    orders = [F.min(F.col("id").bitwiseXOR(F.lit(m))).bitwiseXOR(F.lit(m)).alias(f"leader{i}")
              for i, m in enumerate(LEADER_MASKS)]
    leaders = materialize(lists.groupBy("list").agg(*orders, F.max("id").alias("last"))
                          .where("leader0 != last").drop("last"), "leaders")
    members = materialize(lists.join(leaders, "list"), "members")
    star = None
    for i in range(len(LEADER_MASKS)):
        part = members.where(f"id != leader{i}").select(F.col("id").alias("a"), F.col(f"leader{i}").alias("b")).distinct()
        star = part if star is None else star.unionByName(part)
    first = materialize(compared(star.distinct(), sets), "links")
    groups = materialize(components(first).withColumnsRenamed({"node": "id", "root": "group"}), "groups")

    # Lists with several groups, and what their sets share with other groups.
    open_ = members.select("list", "id", "n", "rest").join(groups, "id", "left").withColumn("group", F.coalesce("group", "id"))
    mixed = open_.groupBy("list").agg(F.min("group").alias("low"), F.max("group").alias("high")) \
        .where("low != high").select("list")
    open_ = materialize(open_.join(mixed, "list"), "open")
    discard(members, leaders)
    wanted = open_.select("id", "group").distinct()
    tokens = materialize(sets.select("id", "n", F.explode("tokens").alias("token")).join(wanted, "id"), "open-tokens")
    union = tokens.select("group", "token").distinct()  # the token-group matrix, a row for each mark
    elsewhere = materialize(union.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token"), "elsewhere")
    bounds = (tokens.join(elsewhere, "token").groupBy("id", "n").agg(F.count("*").alias("shared"))
              .where(enough(F.col("shared"), F.col("n"))).select("id", "shared"))
    open_ = materialize(open_.join(bounds, "id"), "still-open")

    # A set against another group: by sizes and shared tokens, then by the
    # group's token union, then (only for groups that qualify) by its members.
    query = open_.select("list", F.col("id").alias("a"), F.col("n").alias("n_a"), F.col("shared").alias("s_a"),
                         F.col("rest").alias("r_a"), F.col("group").alias("own"))
    target = open_.groupBy("list", "group", "n").agg(F.max("shared").alias("s"), F.max("rest").alias("r"))
    asked = materialize(query.join(target, "list").where("own > group").where(
        may_link(F.col("s_a"), F.col("s"), F.col("n_a"), F.col("n"))
        & may_link(F.col("r_a"), F.col("r"), F.col("n_a"), F.col("n")))
        .groupBy("a", "n_a", "group").agg(F.min("n").alias("n")), "asked")
    # A group is dealt into sub-groups of similar sets (by the least mixed token),
    # each with its token union; a query opens those whose union allows a link.
    members = wanted.join(asked.select("group").distinct(), "group", "left_semi").join(sets.select("id", "n", "shared", "tokens"), "id")
    alike = members.withColumn("like", F.array_min(F.transform("tokens", lambda t: F.xxhash64(t))))
    counts = alike.groupBy("group", "like").agg(F.ceil(F.count("*") / SUB_SETS).alias("parts"))
    subs = materialize(alike.join(counts, ["group", "like"]).withColumn("sub", F.xxhash64(
        "group", "like", F.pmod(F.xxhash64("id"), F.col("parts")))).drop("like", "parts"), "sub-groups")
    unions = materialize(subs.groupBy("group", "sub").agg(
        F.min("n").alias("n"), F.max("shared").alias("s"), F.array_distinct(F.flatten(F.collect_list("tokens"))).alias("union")), "unions")
    bounded = (asked.select("a", "n_a", "group").join(unions.select("group", "sub", "n", "s"), "group")
               .join(sets.select(F.col("id").alias("a"), F.col("shared").alias("s_a"), F.col("tokens").alias("t_a")), "a")
               .where(may_link(F.col("s_a"), F.col("s"), F.col("n_a"), F.col("n")))
               .join(unions.select("sub", "union"), "sub")
               .withColumn("both", F.size(F.array_intersect("t_a", "union"))))
    needed = F.greatest(F.col("n"), F.ceil(F.col("n_a") * PERCENT / 100))
    qualifying = materialize(bounded.where(may_link(F.col("both"), F.col("both"), F.col("n_a"), needed))
                             .select("a", "n_a", "s_a", "sub", "both"), "qualifying")
    opened = (qualifying.join(subs.select("sub", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("shared").alias("s_b")), "sub")
              .where(may_link(F.least("both", "s_a"), F.col("s_b"), F.col("n_a"), F.col("n_b"))).select("a", "b"))
    return materialize(first.unionByName(compared(opened, sets)), "all-links")


def counted(pairs: DataFrame) -> tuple[DataFrame, np.ndarray, int]:
    """One row per document (doc_id, text_key, n_shingles, class, shared), the
    frequent tokens with their document frequencies, and the bucket count."""
    buckets = bucket_count(pairs)
    answers = materialize(coverage(pairs, buckets), "answers")
    found = answers.where("kind != 'hot'").drop("token", "df").groupBy("chunk").applyInArrow(
        add_up, f"doc_id {id_type(pairs)}, text_key {KEY}, n_shingles bigint, class {KEY}, shared bigint")
    rows = materialize(found, "sets")
    top = answers.where("kind = 'hot'").select("token", "df").orderBy(F.desc("df"), "token").limit(HOT_TOKENS).toPandas()
    discard(answers)
    return rows, top.sort_values("token").to_numpy(np.int64).T.copy(), buckets


def class_texts(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """class, text, text_key: one text of each class, that of its first document,
    so that copies of a text are not brought together."""
    # classes grow with the documents, so they are never broadcast
    wanted = classes.select(F.col("first").alias("_first"), F.col("text_key").alias("_key"), "class").hint("merge")
    found = pairs.join(wanted, pairs["doc_id"].eqNullSafe(F.col("_first")) & (F.col("text_key") == F.col("_key")))
    return materialize(found.groupBy("class").agg(F.first("text").alias("text"), F.first("text_key").alias("text_key")),
                       "class-texts")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, text_key, n_shingles, class, component_id,
    class_first (the smallest id of its class) and component (a key that doesn't
    depend on ids; null without shingles)."""
    spark = docs.sparkSession
    ship_package(spark)
    pairs = keyed(docs, id_col, text_col)
    rows, _, _ = counted(pairs)

    shared = rows.where("n_shingles > 0").where(enough(F.col("shared"), F.col("n_shingles")))
    firsts = materialize(shared.groupBy("class").agg(F.min("doc_id").alias("first")), "firsts")
    of_first = shared.select("class", "doc_id", "text_key").join(firsts, "class").where(F.col("doc_id").eqNullSafe(F.col("first")))
    classes = materialize(of_first.groupBy("class", "first").agg(F.min("text_key").alias("text_key")), "classes")
    reps = class_texts(pairs, classes)
    again, hot, buckets = counted(reps.select(F.col("class").alias("doc_id"), "text", "text_key"))
    kept = again.where("doc_id = class").where(enough(F.col("shared"), F.col("n_shingles"))).select("class", "shared")
    sets = materialize(class_sets(reps, kept, hot, buckets), "class-sets")
    discard(reps, again)
    links = grouped_links(sets)
    roots = (components(links).withColumnRenamed("node", "id").join(sets.select("id", "class"), "id")
             .join(sets.select(F.col("id").alias("root"), F.col("class").alias("top")), "root")
             .select("class", F.col("top").alias("root")))
    named = materialize(classes.join(roots, "class", "left").withColumn("root", F.coalesce("root", "class")), "named")
    least = materialize(named.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    labels = materialize(named.join(least, "root").select("class", "first", "component_id", "root"), "labels")
    discard(sets, links, named, classes)
    own = F.when(F.col("n_shingles") > 0, F.col("class"))  # documents without shingles link with nothing
    return rows.withColumn("class", own).join(labels, "class", "left").select(
        "doc_id", "text_key", "n_shingles", "class", F.coalesce("component_id", "doc_id").alias("component_id"),
        F.coalesce("first", "doc_id").alias("class_first"), F.coalesce("root", "class").alias("component"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component, the one with the smallest id (of rows
    without an id or with the same id: the smallest text hash, then any of
    equal rows).  Documents without shingles all stay."""
    found = materialize(join(docs, id_col, text_col).where("n_shingles > 0")
                        .select("doc_id", "text_key", "component"), "found")
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")
    # written, so that the join on components has exchanges of its own, whose hot keys Spark can split
    best = materialize(found.groupBy("component").agg(F.min(row).alias("best"), F.count("*").alias("rows"))
                       .where("rows > 1"), "best")
    drop = (found.join(best, "component").where(~row.eqNullSafe(F.col("best"))).select("doc_id", "text_key").distinct())
    twice = (found.groupBy("doc_id", "text_key").count().where("count > 1").select("doc_id", "text_key"))
    key = fresh(docs, "text_key")
    keyed_docs = docs.withColumn(key, text_key(F.col(text_col).cast("string")))

    def same(other):
        return keyed_docs[f"`{id_col}`"].eqNullSafe(other["doc_id"]) & (keyed_docs[key] == other["text_key"])

    kept = keyed_docs.join(drop, same(drop), "left_anti")
    single = kept.join(twice, same(twice), "left_anti")
    repeated = kept.join(twice, same(twice), "left_semi").dropDuplicates([id_col, key])
    return single.unionByName(repeated).drop(key)


def op4_token_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "class_first")
