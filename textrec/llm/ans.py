"""Token-ID / binary output: static range asymmetric numeral system (rANS).

File format: Parquet files as containers of blocks, one row a block, so that
Spark's own committer, splits and column pruning apply on any store.  A row holds

    file, block     place in the order: documents ascend with (file, block),
                    where ``file`` is the number of a range of ids
    n_docs, doc_ids, doc_tokens
                    the documents (or parts of a long one) inside the block
    first_part      the first document continues one of the block before
    n_tokens        ids in the block
    states          final encoder states of all lanes, uint64 little-endian
    words           renormalisation words, uint32 little-endian, in decoding order
    checkpoints     for every ``CHECKPOINT_STEPS`` steps: words consumed so
                    far, then all lane states; decoding can start at any of them
    ids_crc32, words_crc32   checksums of the decoded ids and of the words

Coding.  One frequency table, counted over all ids of the corpus, is shared by
all blocks (the vocabulary bounds its size).  Token ``t`` of a block belongs to
lane ``t % LANES``; all lanes advance together as numpy arrays, and each emits
at most one 32-bit word a step, so decoding is vectorised within a block, and
blocks and checkpoints are independent units for parallel decoding.

Defined cases: null text is an empty document (its end id only); empty tables
give no blocks and an empty result; repeated rows are kept as documents of
their own; null ids come first,
rows with one id as they are read; a text of any length is cut into as many
blocks as it needs."""

from __future__ import annotations

import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from textrec.llm.common import id_text, id_type, ship_package, table, text_slices
from textrec.session import discard, materialize, scratch_path

SCALE_BITS = 22
STATE_LOW = np.uint64(1) << np.uint64(31)
LANES = 1024
#: Ids in a block; a document that doesn't fit opens a new one or is cut.
BLOCK_TOKENS = 1 << 19
CHECKPOINT_STEPS = 128
END_ID = 0
VOCABULARY = "byte_bpe_50k.json"


# ---- tokens -------------------------------------------------------------

#: The vocabulary's published splitting rule, for texts of the
#: characters that ``_PLAIN`` admits (where every library agrees on classes).
_PLAIN = re.compile(r"[\n\r\t\x20-\x7e\xa1-\xac\xae-\u024f]*")
_PLAIN_LATIN1 = bytes([9, 10, 13, *range(0x20, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)])
_LETTER, _NUMBER = "A-Za-zªµºÀ-ÖØ-öø-\u024f", "0-9²³¹¼-¾"
_SPLIT = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[{_NUMBER}]+| ?[^\s{_LETTER}{_NUMBER}]+|\s+(?!\S)|\s+")


def is_plain(text: str) -> bool:
    """Whether all characters are of ``_PLAIN``; in Latin-1 by one byte table."""
    if "<|" in text:
        return False
    try:
        return not text.encode("latin-1").translate(None, _PLAIN_LATIN1)
    except UnicodeEncodeError:
        return _PLAIN.fullmatch(text) is not None


class PieceIds(dict):
    """Piece to ids (little-endian, ``width`` bytes each) by the library's model, for the
    pieces met so far; what neither of two generations of ``KEEP`` pieces has
    used is forgotten."""

    KEEP = 400_000

    def __init__(self, library, width: int):
        super().__init__()
        from textrec.llm.lexicon import byte_alphabet
        model = library.model
        if hasattr(model, "_resize_cache"):
            model._resize_cache(0)  # pieces are kept here; asking it for a new one costs more than merging
        self.tokenize = model.tokenize
        self.letters = dict(enumerate(byte_alphabet()))
        self.space = self.letters[ord(" ")]
        self.raw = [i.to_bytes(width, "little") for i in range(library.get_vocab_size(with_added_tokens=True))]
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= self.KEEP:
            self.older = dict(self)
            self.clear()
        found = self.older.get(piece)
        if found is None:
            raw = self.raw
            if piece.isascii() and not piece.isspace():  # the alphabet shows the other signs of ASCII as themselves
                shown = piece.replace(" ", self.space)
            else:
                shown = piece.encode().decode("latin-1").translate(self.letters)
            found = b"".join([raw[t.id] for t in self.tokenize(shown)])
        self[piece] = found
        return found


def id_kind(vocab: int) -> str:
    return "<u2" if vocab <= 1 << 16 else "<u4"


class PieceTokenizer:
    """Ids of whole texts, as the library's ``encode`` gives them.  Ordinary
    texts are split by the vocabulary's published rule, and each distinct piece
    goes through the library's model once; texts with other characters or with
    the special token's string go to ``encode`` whole."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread of many on its executor
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.kind = id_kind(self.library.get_vocab_size(with_added_tokens=True))
        self.pieces = PieceIds(self.library, np.dtype(self.kind).itemsize)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as numbers of ``kind``."""
        ids, out = self.pieces.__getitem__, []
        for text in texts:
            if is_plain(text):
                out.append(b"".join(map(ids, _SPLIT.findall(text))))
            else:
                out.append(np.asarray(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes())
        return out


_TOKENIZERS: dict[str, PieceTokenizer] = {}


def tokenizer(path: str) -> PieceTokenizer:
    """One per worker process."""
    if path not in _TOKENIZERS:
        _TOKENIZERS[path] = PieceTokenizer(path)
    return _TOKENIZERS[path]


# ---- coder --------------------------------------------------------------

class Coder:
    """rANS with one static table for all blocks."""

    def __init__(self, freq: np.ndarray):
        self.freq = freq.astype(np.uint64)
        self.start = np.concatenate([[0], np.cumsum(self.freq)[:-1]]).astype(np.uint64)
        self._symbol = None

    @property
    def symbol(self) -> np.ndarray:
        """Slot to id; made when a block is first decoded."""
        if self._symbol is None:
            self._symbol = np.repeat(np.arange(len(self.freq), dtype=np.uint32), self.freq.astype(np.int64))
        return self._symbol

    def encode(self, ids: np.ndarray) -> dict:
        n = len(ids)
        steps = -(-n // LANES)
        x = np.full(LANES, STATE_LOW, np.uint64)
        words: list[np.ndarray] = []
        marks: list[tuple[int, np.ndarray]] = []  # from the last to the first
        emitted = 0
        bits, shift = np.uint64(SCALE_BITS), np.uint64(63 - SCALE_BITS)
        for step in range(steps - 1, -1, -1):
            row = ids[step * LANES:(step + 1) * LANES]
            k = len(row)
            f, y = self.freq[row], x[:k]
            big = y >= (f << shift)  # the state would leave its 63 bits
            if big.any():
                words.append((y[big] & np.uint64(0xFFFFFFFF)).astype("<u4"))
                emitted += len(words[-1])
                y = np.where(big, y >> np.uint64(32), y)
            q = y // f
            x[:k] = (q << bits) + (y - q * f) + self.start[row]
            if step and step % CHECKPOINT_STEPS == 0:
                marks.append((emitted, x.copy()))
        # The decoder reads steps forward: words of step 0 first, lanes ascending.
        data = b"".join(w.tobytes() for w in reversed(words))
        checkpoints = b"".join(np.uint64(emitted - e).tobytes() + s.astype("<u8").tobytes() for e, s in reversed(marks))
        return {"n_tokens": n, "states": x.astype("<u8").tobytes(), "words": data, "checkpoints": checkpoints,
                "ids_crc32": zlib.crc32(ids.astype("<u4").tobytes()), "words_crc32": zlib.crc32(data)}

    def decode(self, block: dict, from_checkpoint: int = 0, to_step: int | None = None) -> np.ndarray:
        """Ids of a block, or of its steps from a checkpoint on."""
        n = block["n_tokens"]
        steps = -(-n // LANES)
        words = np.frombuffer(block["words"], "<u4").astype(np.uint64)
        if from_checkpoint:
            size = 8 * (LANES + 1)
            mark = np.frombuffer(block["checkpoints"], "<u8", LANES + 1, size * (from_checkpoint - 1))
            at, x = int(mark[0]), mark[1:].astype(np.uint64)
        else:
            at, x = 0, np.frombuffer(block["states"], "<u8").astype(np.uint64)
        first = from_checkpoint * CHECKPOINT_STEPS
        last = steps if to_step is None else min(steps, to_step)
        out = np.empty(max(0, min(n, last * LANES) - first * LANES), np.uint32)
        bits, mask = np.uint64(SCALE_BITS), np.uint64((1 << SCALE_BITS) - 1)
        for step in range(first, last):
            k = min(LANES, n - step * LANES)
            y = x[:k]
            slot = y & mask
            sym = self.symbol[slot]
            out[(step - first) * LANES:(step - first) * LANES + k] = sym
            y = self.freq[sym] * (y >> bits) + slot - self.start[sym]
            low = np.flatnonzero(y < STATE_LOW)
            y[low] = (y[low] << np.uint64(32)) | words[at:at + len(low)]
            at += len(low)
            x[:k] = y
        return out


def normalise(counts: np.ndarray) -> np.ndarray:
    """Frequencies of at least 1 that sum to 2**SCALE_BITS, in proportion to
    the counts; what rounding leaves over goes to the most frequent id."""
    total = 1 << SCALE_BITS
    spare = total - len(counts)
    exact = counts.astype(np.float64) / max(1, counts.sum()) * spare
    freq = np.floor(exact).astype(np.int64) + 1
    freq[int(np.argmax(counts))] += total - freq.sum()
    return freq


# ---- Spark --------------------------------------------------------------

def sorted_ids(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """file, ord, doc_id, ids: the documents in ascending order of their ids,
    as ranges (``file``) of about the size of the scan's splits, each numbered
    from 0.  Written once, so that texts are tokenised once."""
    ship_package(docs.sparkSession)
    pairs = id_text(docs, id_col, text_col)
    end = END_ID.to_bytes(np.dtype(id_kind(vocabulary_size(path))).itemsize, "little")

    def run(batches):
        tok, file, ord_ = tokenizer(path), TaskContext.get().partitionId(), 0
        for rows, texts in text_slices(batches):
            n = len(texts)
            ids = [x + end for x in tok.encode(texts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([file] * n, pa.int32()), pa.array(range(ord_, ord_ + n), pa.int64()), rows.column(0),
                 pa.array(ids, pa.binary())], names=["file", "ord", "doc_id", "ids"])
            ord_ += n

    spans = max(1, pairs.rdd.getNumPartitions())
    # rows that share an id, or have none, spread over ranges by their place in
    # the scan; the sample for the ranges reads no text
    first = F.col("doc_id").asc_nulls_first()
    ordered = (pairs.withColumn("place", F.monotonically_increasing_id())
               .repartitionByRange(spans, first, "place").sortWithinPartitions(first, "place").drop("place"))
    out = ordered.mapInArrow(run, f"file int, ord bigint, doc_id {id_type(pairs)}, ids binary")
    folder = scratch_path(docs.sparkSession, "ids")
    out.write.option("compression", "lz4").parquet(folder)
    frame = docs.sparkSession.read.parquet(folder)
    frame._scratch = folder
    return frame


def token_counts(ids: DataFrame, vocab: int) -> np.ndarray:
    """How often each id occurs; the result has one row for each id of the
    vocabulary at most."""
    kind = id_kind(vocab)

    def run(batches):
        counts = np.zeros(vocab, np.int64)
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                data = b"".join(batch.column(0).slice(lo, 256).to_pylist())
                counts += np.bincount(np.frombuffer(data, kind), minlength=vocab)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_pydict({"id": pa.array(used, pa.int32()), "n": pa.array(counts[used], pa.int64())})

    rows = (ids.select("ids").mapInArrow(run, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect())
    out = np.zeros(vocab, np.int64)
    for r in rows:
        out[r.id] = r.n
    return out


BLOCK_SCHEMA = ("file int, block bigint, n_docs int, doc_ids array<{id}>, doc_tokens array<bigint>, "
                "first_part boolean, n_tokens bigint, states binary, words binary, checkpoints binary, "
                "ids_crc32 bigint, words_crc32 bigint")
#: Blocks are numbered by their first document's place and the part of it.
PARTS_OF_A_DOCUMENT = 1 << 20


def arrow_schema(id_arrow: pa.DataType) -> pa.Schema:
    return pa.schema([("file", pa.int32()), ("block", pa.int64()), ("n_docs", pa.int32()),
                      ("doc_ids", pa.list_(id_arrow)), ("doc_tokens", pa.list_(pa.int64())),
                      ("first_part", pa.bool_()), ("n_tokens", pa.int64()), ("states", pa.binary()),
                      ("words", pa.binary()), ("checkpoints", pa.binary()), ("ids_crc32", pa.int64()),
                      ("words_crc32", pa.int64())])


def write_tokens(docs: DataFrame, folder: str, path: str, id_col: str = "doc_id", text_col: str = "text") -> Coder:
    """Tokenise the documents and write them into ``folder``; ``file`` and
    ``block`` ascend with the documents' ids.  Returns the coder; its table is
    also written, to ``folder`` + "-table"."""
    spark = docs.sparkSession
    vocab = vocabulary_size(path)
    kind = id_kind(vocab)
    ids_table = sorted_ids(docs, path, id_col, text_col)
    coder = Coder(normalise(token_counts(ids_table, vocab)))
    spark.createDataFrame([(i, int(f)) for i, f in enumerate(coder.freq)], "id int, freq bigint").coalesce(1) \
        .write.parquet(folder + "-table")
    shared = spark.sparkContext.broadcast(coder.freq.astype(np.uint32))  # 4 bytes an id of the vocabulary

    def run(batches):
        code, at, id_arrow = Coder(shared.value), None, None
        ids_, sizes, parts, n, first, file, block = [], [], [], 0, False, 0, 0

        def flush():
            row = code.encode(np.concatenate(parts)) | {
                "file": file, "block": block, "n_docs": len(ids_), "doc_ids": list(ids_), "doc_tokens": list(sizes),
                "first_part": first}
            return pa.RecordBatch.from_pylist([row], schema=arrow_schema(id_arrow))

        for batch in batches:
            id_arrow = batch.schema.field(2).type
            for i in range(batch.num_rows):
                now, doc_id = (batch.column(0)[i].as_py(), batch.column(1)[i].as_py()), batch.column(2)[i].as_py()
                ids = np.frombuffer(batch.column(3)[i].as_buffer(), kind).astype(np.uint32)
                if n and (now != at or n + len(ids) > BLOCK_TOKENS):
                    yield flush()
                    ids_, sizes, parts, n = [], [], [], 0
                for k in range(0, len(ids), BLOCK_TOKENS):
                    if k:
                        yield flush()
                        ids_, sizes, parts, n = [], [], [], 0
                    if not n:
                        file, block, first = now[0], now[1] * PARTS_OF_A_DOCUMENT + k // BLOCK_TOKENS, bool(k)
                    piece = ids[k:k + BLOCK_TOKENS]
                    ids_.append(doc_id)
                    sizes.append(len(piece))
                    parts.append(piece)
                    n += len(piece)
                at = (now[0], now[1] + 1)
        if n:
            yield flush()

    id_name = dict(ids_table.dtypes)["doc_id"]
    ids_table.mapInArrow(run, BLOCK_SCHEMA.format(id=id_name)).write.option("compression", "none").parquet(folder)
    discard(ids_table)
    return coder


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True)


def read_coder(spark: SparkSession, folder: str) -> Coder:
    """The table of a written folder; its size is that of the vocabulary."""
    rows = sorted(tuple(r) for r in spark.read.parquet(folder + "-table").collect())
    return Coder(np.array([f for _, f in rows], np.int64))


def read_documents(spark: SparkSession, folder: str, with_ids: bool = True) -> DataFrame:
    """Decode the files of a folder.  A row for each part of a document that a
    block holds (a document has one part unless it fills several blocks):
    file, block, part, doc_id, n_tokens, crc (of the part's ids), ids."""
    ship_package(spark)
    blocks = spark.read.parquet(folder)
    shared = spark.sparkContext.broadcast(read_coder(spark, folder).freq.astype(np.uint32))
    id_name = dict(blocks.dtypes)["doc_ids"][len("array<"):-1]

    def run(batches):
        code = Coder(shared.value)
        for batch in batches:
            id_arrow = batch.schema.field("doc_ids").type.value_type
            for i in range(batch.num_rows):
                b = batch.slice(i, 1).to_pylist()[0]
                if zlib.crc32(b["words"]) != b["words_crc32"]:
                    raise ValueError(f"file {b['file']}, block {b['block']}: words are damaged")
                data = code.decode(b).astype("<u4").tobytes()
                if zlib.crc32(data) != b["ids_crc32"]:
                    raise ValueError(f"file {b['file']}, block {b['block']}: ids don't have their checksum")
                ends = np.cumsum(b["doc_tokens"]) * 4
                parts = [data[e - 4 * n:e] for n, e in zip(b["doc_tokens"], ends, strict=True)]
                k = len(parts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([b["file"]] * k, pa.int32()), pa.array([b["block"]] * k, pa.int64()),
                    pa.array(range(k), pa.int32()), pa.array([b["first_part"]] + [False] * (k - 1), pa.bool_()),
                    pa.array(b["doc_ids"], id_arrow), pa.array(b["doc_tokens"], pa.int64()),
                    pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                    pa.array(parts if with_ids else [None] * k, pa.binary())],
                    names=["file", "block", "part", "continues", "doc_id", "n_tokens", "crc", "ids"])

    return blocks.mapInArrow(run, f"file int, block bigint, part int, continues boolean, doc_id {id_name}, "
                                  "n_tokens bigint, crc bigint, ids binary")


def crc32_join(crc1: int, crc2: int, len2: int) -> int:
    """crc32 of a + b from those of a and b: shifting crc1 by len2 zero bytes
    is a linear map over GF(2), applied by repeated squaring."""
    def times(matrix, vector):
        total, i = 0, 0
        while vector:
            if vector & 1:
                total ^= matrix[i]
            vector >>= 1
            i += 1
        return total

    matrix = [0xEDB88320] + [1 << i for i in range(31)]  # one zero bit; the fixed polynomial of crc32
    for _ in range(3):
        matrix = [times(matrix, m) for m in matrix]  # one zero byte
    while len2:
        if len2 & 1:
            crc1 = times(matrix, crc1)
        len2 >>= 1
        matrix = [times(matrix, m) for m in matrix]
    return crc1 ^ crc2


def document_checksums(parts: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 for each document of the files.

    Offsets are sums within a file plus the totals of the files before.  A
    file's rows are few numbers each, and files hold a bounded share of the
    input, so the windows are small; the one over files has a row a file."""
    # written, so that the files are decoded once
    rows = materialize(parts.select("file", "block", "part", "continues", "doc_id", "n_tokens", "crc"), "token-parts")
    order = Window.partitionBy("file").orderBy("block", "part")
    rows = (rows.withColumn("doc", F.sum(F.when(F.col("continues"), 0).otherwise(1)).over(order))
            .withColumn("before", F.sum("n_tokens").over(order) - F.col("n_tokens")))
    docs = rows.groupBy("file", "doc").agg(
        F.first("doc_id").alias("doc_id"), F.min("before").alias("before"), F.sum("n_tokens").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("block", "part", "n_tokens", "crc"))).alias("parts"))

    @F.pandas_udf("bigint")
    def joined(lists):
        import pandas as pd

        def fold(parts):
            total = parts[0]["crc"]
            for p in parts[1:]:
                total = crc32_join(total, p["crc"], 4 * p["n_tokens"])
            return total
        return pd.Series([fold(p) for p in lists], dtype="int64")

    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("total"))
    offsets = totals.select("file", (F.sum("total").over(Window.orderBy("file")) - F.col("total")).alias("offset"))
    return docs.join(offsets, "file").select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens",
        F.when(F.size("parts") == 1, F.col("parts")[0]["crc"]).otherwise(joined("parts")).alias("ids_crc32"))


def op1_static_rans(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    folder = scratch_path(spark, "tokens")
    write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(VOCABULARY))
    return document_checksums(read_documents(spark, folder, with_ids=False))
