"""Prefix trie of conversations, summed up by time-forward processing.

Sequences of turns are merged where they start alike: each distinct sequence of
first d turns is a node.  Totals of a node's subtree are made without holding
the trie: nodes are sorted by reverse level order (deepest first, then by key),
each sends its totals to its parent, and a priority queue keyed by the place of
the receiver hands a node all that its children sent when its turn comes.  The
queue holds ``QUEUE_ENTRIES`` messages in memory and spills sorted runs.

Keys.  A turn is the md5 of its role and text, a node the md5 of its parent's
key and its turn (128 bits); texts are not shuffled.

Shards.  Nodes fall into bands by their number of sequences: up to L =
``SHARD_CONVS``, up to L squared, and so on.  A shard root is a node whose
parent lies in a higher band; a shard is what hangs from it within its band, at
most L sequences' worth of nodes, whatever a first turn's share of the table.
Spark sorts the shards of a band and a task runs the time-forward pass over
those dealt to it; then the totals of shard roots, added up for each parent,
are messages to the next band, and so on up to the root.  There are as many
passes as bands: one for each power of L in the number of sequences.

Rebuilding.  ``rebuild`` makes the sequences of the contract: the first h turns
of a conversation's base (the id less its remainder by ``GROUP``), then its own
turns after its first h.

Ids that end at a node are sorted by Spark and joined to texts of some 64 KB by
any number of tasks; the texts of a node are then hashed in order, so a node at
which a third of all conversations end is a stream of few rows.

One conversation's turns are read in order by one task as a sorted stream, in
bounded memory however long it is.

Defined cases: turns are ordered by turn (null first), equal ones by role and
digest; null roles and texts are empty; rows without a conv_id belong to no
conversation; an empty table has no nodes; a conversation left without turns is
a member of the root only; other columns are not read."""

from __future__ import annotations

import hashlib
import heapq
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from textrec.llm.common import table
from textrec.session import materialize, ship_package

GROUP = 100
HEADS = 6
#: L: the most sequences of a shard of the first band.
SHARD_CONVS = 512
QUEUE_ENTRIES = 1 << 17
RUN_ROWS = 1 << 14
CHUNK_BYTES = 1 << 16
ROOT = hashlib.md5(b"").digest()
NO_ENDS = hashlib.sha256(b"").hexdigest()


# --- sequences ----------------------------------------------------------------

def numbered_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, token, chars): turns in order, from 1."""
    from pyspark.sql import Window
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    token = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))
    rows = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn"), role.alias("role"), token.alias("token"),
        F.length(text).cast("bigint").alias("chars"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "token")
    return rows.select("conv_id", F.row_number().over(order).cast("bigint").alias("pos"), "token", "chars")


def head_turns(conv_id: Column, heads: int = HEADS) -> Column:
    """How many turns a conversation takes from its base."""
    return F.pmod(F.crc32(conv_id.cast("string").cast("binary")), F.lit(heads))


def rebuild(turns: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """Rebuilt sequences from numbered turns: (conv_id, part, pos, token,
    chars), in the order of part and pos; each has one row of part -1 for the
    root, so that a sequence without turns is there as well."""
    base = F.col("conv_id") - F.col("conv_id") % group
    convs = turns.where("pos = 1").select("conv_id", base.alias("base"), head_turns(F.col("conv_id"), heads).alias("h"))
    lent = (turns.where((F.col("pos") < heads) & (F.col("conv_id") % group == 0))
                 .select(F.col("conv_id").alias("base"), "pos", "token", "chars"))
    root = convs.select("conv_id", F.lit(-1).alias("part"), F.lit(0).cast("bigint").alias("pos"),
                        F.lit(None).cast("binary").alias("token"), F.lit(0).cast("bigint").alias("chars"))
    head = (convs.join(lent, "base").where("pos <= h")
                 .select("conv_id", F.lit(0).alias("part"), "pos", "token", "chars"))
    own = (turns.where(F.col("pos") > head_turns(F.col("conv_id"), heads))
                .select("conv_id", F.lit(1).alias("part"), "pos", "token", "chars"))
    return root.unionByName(head).unionByName(own)


# --- nodes ----------------------------------------------------------------------

def _rows(batches, *names: str) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*[batch.column(batch.schema.get_field_index(n)).to_pylist() for n in names], strict=True)


def _batches(rows: Iterator[tuple], schema: pa.Schema, size: int = RUN_ROWS) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)],
                                          schema=schema)

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
            held = []
    if held:
        yield batch()


_PATH = pa.schema([("conv_id", pa.int64()), ("depth", pa.int64()), ("key", pa.binary()), ("chars", pa.int64()),
                   ("ends", pa.bool_())])


def paths(sequences: DataFrame) -> DataFrame:
    """(conv_id, depth, key, chars, ends): the nodes on each sequence's path."""
    def chain(rows):
        last, conv, depth, key = None, None, 0, ROOT
        for c, part, token, chars in rows:
            if part < 0:
                conv, depth, key = c, 0, ROOT
            else:
                depth, key = depth + 1, hashlib.md5(key + token).digest()
            if last is not None:
                yield *last, last[0] != conv
            last = (conv, depth, key, chars)
        if last is not None:
            yield *last, True

    def run(batches):
        yield from _batches(chain(_rows(batches, "conv_id", "part", "token", "chars")), _PATH)

    ordered = sequences.repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos")
    return ordered.mapInArrow(run, "conv_id bigint, depth bigint, key binary, chars bigint, ends boolean")


_NODE = pa.schema([("key", pa.binary()), ("parent", pa.binary()), ("shard", pa.binary()), ("band", pa.int32()),
                   ("depth", pa.int64()), ("conv_id", pa.int64()), ("parent_conv_id", pa.int64()),
                   ("n_convs", pa.int64()), ("chars", pa.int64())])


def band_of(n: int, shard_convs: int) -> int:
    band, most = 0, shard_convs
    while n > most:
        band, most = band + 1, most * shard_convs
    return band


def nodes(on_paths: DataFrame, shard_convs: int = SHARD_CONVS) -> DataFrame:
    """One row a node, given by its smallest member, which sees on its own path
    the parent and the shard root."""
    # written first: the join then has exchanges of its own, whose hot keys (the
    # root, a common first turn) Spark can split
    counts = materialize(on_paths.groupBy("key").agg(F.count("*").alias("n_convs"), F.min("conv_id").alias("first")),
                         "trie-counts")

    def owned(rows):
        above = shard = band = first_above = None
        for conv, depth, key, chars, n, first in rows:
            if depth == 0:
                above = shard = band = first_above = None
            own = band_of(n, shard_convs)
            if own != band:
                shard, band = key, own
            if conv == first:
                yield key, above, shard, band, depth, conv, first_above, n, chars
            above, first_above = key, first

    def run(batches):
        yield from _batches(owned(_rows(batches, "conv_id", "depth", "key", "chars", "n_convs", "first")), _NODE)

    ordered = (on_paths.select("conv_id", "depth", "key", "chars").join(counts, "key")
                       .repartition("conv_id").sortWithinPartitions("conv_id", "depth"))
    return ordered.mapInArrow(run, "key binary, parent binary, shard binary, band int, depth bigint, conv_id bigint, "
                                   "parent_conv_id bigint, n_convs bigint, chars bigint")


# --- time-forward processing ------------------------------------------------------

class SpillingQueue:
    """Messages (level, key, leaves, saved), smallest (level, key) first.  Beyond
    ``memory`` messages the held ones are written as a sorted run to an unnamed
    temporary file of the task, gone with it like Spark's own spill files."""

    ROW = struct.Struct(">q16sqq")

    def __init__(self, memory: int = QUEUE_ENTRIES):
        self.memory, self.heap, self.runs, self.tops = memory, [], [], []

    def push(self, message: tuple) -> None:
        heapq.heappush(self.heap, message)
        if len(self.heap) > self.memory:
            self._spill()

    def _spill(self) -> None:
        run = tempfile.TemporaryFile()
        self.heap.sort()
        for at in range(0, len(self.heap), RUN_ROWS):
            run.write(b"".join(self.ROW.pack(*m) for m in self.heap[at:at + RUN_ROWS]))
        run.seek(0)
        self.heap = []
        self.runs.append(self._read(run))
        self._advance(len(self.runs) - 1)

    def _read(self, run) -> Iterator[tuple]:
        with run:
            while block := run.read(self.ROW.size * 1024):
                yield from self.ROW.iter_unpack(block)

    def _advance(self, number: int) -> None:
        message = next(self.runs[number], None)
        if message is not None:
            heapq.heappush(self.tops, (message, number))

    def take(self, level: int, key: bytes) -> Iterator[tuple]:
        """Removes and yields the messages for one node, the next in order."""
        while True:
            held = self.heap[0] if self.heap else None
            spilled = self.tops[0][0] if self.tops else None
            least = min((m for m in (held, spilled) if m is not None), default=None)
            if least is None or least[:2] != (level, key):
                return
            if least is held:
                heapq.heappop(self.heap)
            else:
                self._advance(heapq.heappop(self.tops)[1])
            yield least

    def __len__(self) -> int:
        return len(self.heap) + len(self.tops)


def time_forward(rows: Iterator[tuple], memory: int = QUEUE_ENTRIES) -> Iterator[tuple]:
    """Rows (depth, key, parent, shard, own, children, leaves, saved) by depth
    descending, then key, with what shard roots below have sent; yields (key,
    children, leaves, saved) of each."""
    queue = SpillingQueue(memory)
    for depth, key, parent, shard, own, children, leaves, saved in rows:
        saved += own
        for _, _, its_leaves, its_saved in queue.take(-depth, key):
            children, leaves, saved = children + 1, leaves + its_leaves, saved + its_saved
        leaves = leaves if children else 1
        yield key, children, leaves, saved
        if key != shard:
            queue.push((1 - depth, parent, leaves, saved))
    assert not len(queue), "a message found no receiver"


_TOTAL = pa.schema([("key", pa.binary()), ("n_children", pa.int64()), ("n_leaves", pa.int64()), ("saved_tokens", pa.int64()),
                    ("parent", pa.binary()), ("is_shard_root", pa.bool_()), ("conv_id", pa.int64()), ("depth", pa.int64()),
                    ("parent_conv_id", pa.int64()), ("n_convs", pa.int64())])


def band_totals(of_band: DataFrame, messages: DataFrame | None, memory: int = QUEUE_ENTRIES) -> DataFrame:
    """Totals of a band's nodes, given the sums that lower shard roots sent."""
    def run(batches):
        def asked():
            nonlocal last
            for last in _rows(batches, "depth", "key", "parent", "shard", "own", "c", "l", "s", "conv_id",
                              "parent_conv_id", "n_convs"):
                yield last[:8]
        last = None
        out = ((key, c, leaves, saved, last[2], key == last[3], last[8], last[0], last[9], last[10])
               for key, c, leaves, saved in time_forward(asked(), memory))
        yield from _batches(out, _TOTAL)

    none = F.lit(0).cast("bigint")
    joined = (of_band.select("*", none.alias("c"), none.alias("l"), none.alias("s")) if messages is None else
              of_band.join(messages, "key", "left").na.fill(0, ["c", "l", "s"]))
    own = (F.col("n_convs") - 1) * F.col("chars")
    ordered = (joined.withColumn("own", own).repartition("shard")
                     .sortWithinPartitions(F.col("depth").desc(), "key"))
    return ordered.mapInArrow(run, "key binary, n_children bigint, n_leaves bigint, saved_tokens bigint, parent binary, "
                                   "is_shard_root boolean, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint")


def subtree_totals(all_nodes: DataFrame, memory: int = QUEUE_ENTRIES) -> DataFrame:
    """All nodes with their subtrees' totals: one time-forward pass a band."""
    bands = all_nodes.agg(F.max("band").alias("b")).first()["b"]
    done: list[DataFrame] = []
    for band in range((bands or 0) + 1):
        sent = None
        for part in done:
            roots = part.where("is_shard_root AND parent IS NOT NULL").select("parent", "n_leaves", "saved_tokens")
            sent = roots if sent is None else sent.unionByName(roots)
        messages = None if sent is None else sent.groupBy(F.col("parent").alias("key")).agg(
            F.count("*").alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s"))
        done.append(materialize(band_totals(all_nodes.where(F.col("band") == band), messages, memory), f"trie-band-{band}"))
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


# --- ends -------------------------------------------------------------------------

def end_digests(on_paths: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(key, ends_sha256) of the nodes at which sequences end."""
    def join_ids(batches):
        def chunks():
            key, first, ids, size = None, None, [], 0
            for k, c in _rows(batches, "key", "conv_id"):
                if k != key or size >= chunk_bytes:
                    if ids:
                        yield key, first, ",".join(ids)
                    key, first, ids, size = k, c, [], 0
                ids.append(str(c))
                size += len(ids[-1]) + 1
            if ids:
                yield key, first, ",".join(ids)
        schema = pa.schema([("key", pa.binary()), ("first", pa.int64()), ("ids", pa.string())])
        yield from _batches(chunks(), schema, 64)

    def digest(batches):
        def digests():
            key, sha = None, None
            for k, ids in _rows(batches, "key", "ids"):
                if k != key:
                    if sha is not None:
                        yield key, sha.hexdigest()
                    key, sha = k, hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(ids.encode())
            if sha is not None:
                yield key, sha.hexdigest()
        yield from _batches(digests(), pa.schema([("key", pa.binary()), ("ends_sha256", pa.string())]))

    ends = on_paths.where("ends").select("key", "conv_id")
    texts = (ends.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
                 .mapInArrow(join_ids, "key binary, first bigint, ids string"))
    return (texts.repartition("key").sortWithinPartitions("key", "first")
                 .mapInArrow(digest, "key binary, ends_sha256 string"))


def build(sequences: DataFrame, shard_convs: int = SHARD_CONVS, memory: int = QUEUE_ENTRIES) -> DataFrame:
    """The trie of (conv_id, part, pos, token, chars): one row a node (key,
    parent, conv_id: smallest member, depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256)."""
    ship_package(sequences.sparkSession)
    on_paths = materialize(paths(sequences), "trie-paths")
    all_nodes = materialize(nodes(on_paths, shard_convs), "trie-nodes")
    totals = subtree_totals(all_nodes, memory)
    return (totals.drop("is_shard_root").join(end_digests(on_paths), "key", "left")
                  .withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS))))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = materialize(numbered_turns(table(spark, sf_dir, "conversations")), "trie-turns")
    return build(rebuild(turns)).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                        "saved_tokens", "ends_sha256")
