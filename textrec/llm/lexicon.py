"""BPE encoding and decoding with a minimal acyclic transducer lexicon.

The most frequent words of the corpus (``LEXICON_WORDS``, counted by Spark over
all texts; a bounded report) are encoded once and compiled into a minimal
acyclic automaton: words with a common beginning share states, and so do words
with a common rest.  Every edge holds how many words lie before it, so the sum
along a word's path is the word's number in sorted order, which is where its
ids stand.  The arrays are one file that each executor fetches once and
memory-maps; a worker looks up all new words of a slice together, a character
position at a time.  Words that the automaton doesn't hold go through the exact
merges of the vocabulary's model, so results don't depend on what is in it.

Texts are normalised and split as the vocabulary's file says (NFC, white space
dropped, lower case, pieces of letters, single digits, other signs); a worker
keeps the ids of the pieces it has met.  Texts with control characters, characters beyond Latin
Extended-B or special-token strings are normalised and split by the library's
own components, piece by piece.

Decoding follows the file too: it names no decoder, so tokens are joined by
one space.

Defined cases: null text counts as empty (no ids, empty decoded text); rows,
ids and ties stay as they are; empty tables give an empty lexicon and result."""

from __future__ import annotations

import json
import os
import re
import tempfile
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textrec.llm.common import id_text, id_type, sha256_hex, ship_package, table, text_slices
from textrec.session import discard, materialize

VOCABULARY = "word_bpe_49k.json"
LEXICON_WORDS = 1 << 16
#: Words that a task counts before it hands their counts on.
COUNTED = 300_000
#: Longer words are left to the merges; with it the lexicon's size is bounded.
LEXICON_WORD_BYTES = 64
_PLAIN = re.compile(r"[\t\n\r\x20-\x7e\xa1-ɏ]*")


def byte_alphabet() -> list[str]:
    """The published byte-to-character map of byte-level BPE."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, extra = [""] * 256, 256
    for b in range(256):
        if b in shown:
            out[b] = chr(b)
        else:
            out[b], extra = chr(extra), extra + 1
    return out


class Vocabulary:
    """The vocabulary file: normalising, splitting, exact merges, decoding."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread of many on its executor
        self.library = Tokenizer.from_file(path)
        self.model = self.library.model
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: s for s, i in spec["model"]["vocab"].items()} | {i: s for s, i in self.special.items()}
        self.digits = {i: str(i) for i in self.tokens}
        self.to_char = byte_alphabet()
        self.to_byte = {c: b for b, c in enumerate(self.to_char)}
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(pattern).findall
        self.split_special = re.compile("(" + "|".join(map(re.escape, self.special)) + ")").split

    def merge(self, piece: bytes) -> list[int]:
        """Ids of one piece by the merges of the vocabulary's model."""
        return [t.id for t in self.model.tokenize("".join([self.to_char[b] for b in piece]))]

    def is_plain(self, text: str) -> bool:
        return "<|" not in text and _PLAIN.fullmatch(text) is not None

    def word_pieces(self, word: str) -> list[bytes]:
        """Pieces of a white-space word of a plain text."""
        return [p.encode() for p in self.pieces(word.lower())]

    def text_pieces(self, text: str) -> list[bytes | int]:
        """Pieces of any text, split by the library; special tokens as ids."""
        out: list[bytes | int] = []
        for part in self.split_special(text):
            if part in self.special:
                out.append(self.special[part])
            elif part:
                norm = self.library.normalizer.normalize_str(part)
                for piece, _ in self.library.pre_tokenizer.pre_tokenize_str(norm):
                    out.append(bytes(self.to_byte[c] for c in piece))
        return out

    def decode(self, ids) -> str:
        return " ".join([self.tokens[i] for i in ids])


# ---- automaton ----------------------------------------------------------

def build_automaton(words: list[bytes]) -> dict[str, np.ndarray]:
    """Minimal acyclic automaton of sorted distinct words.  States equal in
    finality and edges are one state; each is registered once all words that
    pass through it are known."""
    register: dict[tuple, int] = {}
    done: list[tuple[bool, tuple]] = []
    path: list[list] = [[False, []]]  # [final, [(label, state)]] of the last word's states
    last = b""

    def close(depth: int) -> None:
        while len(path) > depth + 1:
            final, edges = path.pop()
            key = (final, tuple(edges))
            state = register.get(key)
            if state is None:
                state = register[key] = len(done)
                done.append(key)
            path[-1][1].append((last[len(path) - 1], state))

    for word in words:
        common = 0
        while common < min(len(word), len(last)) and word[common] == last[common]:
            common += 1
        close(common)
        path.extend([False, []] for _ in range(len(word) - common))
        path[-1][0] = True
        last = word
    close(0)
    done.append((path[0][0], tuple(path[0][1])))

    below = np.zeros(len(done), np.int64)  # words from a state on; targets come first
    keys, targets, skips = [], [], []
    for state, (final, edges) in enumerate(done):
        count = int(final)
        for label, target in edges:
            keys.append(state * 256 + label)
            targets.append(target)
            skips.append(count)
            count += int(below[target])
        below[state] = count
    return {"keys": np.array(keys, np.int64), "targets": np.array(targets, np.int32),
            "skips": np.array(skips, np.int32), "final": np.array([f for f, _ in done], np.uint8)}


def write_lexicon(path: str, words: list[bytes], ids: list[list[int]]) -> None:
    """One file: a JSON line with the arrays' places, then the arrays."""
    arrays = build_automaton(words)
    arrays["offsets"] = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int64)
    arrays["ids"] = np.array([i for x in ids for i in x], np.int32)
    places, at = {}, 0
    for name, a in arrays.items():
        places[name] = [str(a.dtype), at, len(a)]
        at += -(-a.nbytes // 8) * 8
    head = json.dumps(places).encode()
    head += b" " * (-(len(head) + 1) % 8) + b"\n"
    with open(path, "wb") as f:
        f.write(head)
        for a in arrays.values():
            f.write(a.tobytes() + b"\0" * (-a.nbytes % 8))


class Lexicon:
    """A memory-mapped lexicon file."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            head = f.readline()
        data = np.asarray(np.memmap(path, np.uint8, "r", offset=0))  # a plain view of the mapped file
        for name, (kind, at, n) in json.loads(head).items():
            start = len(head) + at
            setattr(self, name, data[start:start + n * np.dtype(kind).itemsize].view(kind))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """Each word's number in sorted order, -1 if it isn't in the lexicon."""
        n = len(words)
        number = np.zeros(n, np.int64)
        if not len(self.keys):
            return number - 1
        sizes = np.array([len(w) for w in words])
        state = np.full(n, len(self.final) - 1, np.int64)
        flat = np.frombuffer(b"".join(words), np.uint8)
        starts = np.cumsum(sizes) - sizes
        alive = np.flatnonzero((sizes > 0) & (sizes <= LEXICON_WORD_BYTES))
        number[(sizes == 0) | (sizes > LEXICON_WORD_BYTES)] = -1
        depth = 0
        while len(alive):
            key = state[alive] * 256 + flat[starts[alive] + depth]
            edge = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            found = self.keys[edge] == key
            number[alive[~found]] = -1
            alive, edge = alive[found], edge[found]
            number[alive] += self.skips[edge]
            state[alive] = self.targets[edge]
            depth += 1
            ended = sizes[alive] == depth
            number[alive[ended & (self.final[state[alive]] == 0)]] = -1
            alive = alive[~ended]
        return number

    def ids_of(self, number: int) -> list[int]:
        return self.ids[self.offsets[number]:self.offsets[number + 1]].tolist()


class Encoder:
    """Encodes slices of texts; keeps what it knows of pieces in two generations
    of about ``KEEP`` pieces: what a slice uses is in the younger one, and what
    neither of two generations has used is forgotten."""

    KEEP = 400_000

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.known: dict[str | bytes, tuple[str, str, int]] = {}
        self.older: dict[str | bytes, tuple[str, str, int]] = {}

    def entry(self, ids: list[int]) -> tuple[str, str, int]:
        return " ".join([self.vocabulary.digits[i] for i in ids]), self.vocabulary.decode(ids), len(ids)

    def piece_ids(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids by the lexicon, all pieces together, and by merges for the rest."""
        if self.lexicon is None:
            return [self.vocabulary.merge(p) for p in pieces]
        return [self.lexicon.ids_of(k) if k >= 0 else self.vocabulary.merge(p)
                for p, k in zip(pieces, self.lexicon.numbers(pieces).tolist(), strict=True)]

    def learn(self, pieces: set) -> None:
        """Puts all pieces of a slice into the younger generation."""
        if len(self.known) >= self.KEEP:
            self.older, self.known = self.known, {}
        new = []
        for p in pieces.difference(self.known):
            found = self.older.get(p)
            if found is None:
                new.append(p)
            else:
                self.known[p] = found
        ids = self.piece_ids([p if isinstance(p, bytes) else p.encode() for p in new])
        self.known.update(zip(new, map(self.entry, ids), strict=True))

    def encode(self, texts: list[str]) -> list[tuple[str, str, int]]:
        """(ids joined by spaces, decoded text, number of ids) of each text."""
        voc = self.vocabulary
        plain = [voc.is_plain(t) for t in texts]
        split = [voc.pieces(t.lower()) if p else voc.text_pieces(t) for t, p in zip(texts, plain, strict=True)]
        special = {x for ps, p in zip(split, plain, strict=True) if not p for x in ps if isinstance(x, int)}
        self.learn(set().union(*split) - special)
        known = self.known
        if special:
            known = known | {i: self.entry([i]) for i in special}
        out = []
        for pieces in split:
            entries = [known[p] for p in pieces]
            out.append((" ".join([e[0] for e in entries]), " ".join([e[1] for e in entries]), sum([e[2] for e in entries])))
        return out


_VOCABULARIES: dict[str, Vocabulary] = {}
_ENCODERS: dict[tuple, Encoder] = {}


def vocabulary(path: str) -> Vocabulary:
    """One per worker process."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def encoder(path: str, lexicon_file: str) -> Encoder:
    """One per worker process; the lexicon is the file that Spark fetched."""
    key = (path, lexicon_file)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(vocabulary(path), Lexicon(SparkFiles.get(lexicon_file)))
    return _ENCODERS[key]


# ---- Spark --------------------------------------------------------------

def frequent_words(docs: DataFrame, path: str, n: int = LEXICON_WORDS, text_col: str = "text") -> list[bytes]:
    """Up to n most frequent pieces of all texts, counted in each task first; of
    pieces with one count all or none."""
    def run(batches):
        voc, words, pieces = vocabulary(path), Counter(), Counter()

        def flush():
            for w, k in words.items():
                for p in voc.word_pieces(w):
                    pieces[p] += k
            words.clear()
            rows = [(p, k) for p, k in pieces.items() if len(p) <= LEXICON_WORD_BYTES]
            pieces.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()),
                                               pa.array([r[1] for r in rows], pa.int64())], names=["piece", "n"])

        for _, texts in text_slices(batches):
            for t in texts:
                if voc.is_plain(t):
                    words.update(t.split())
                else:
                    pieces.update(p for p in voc.text_pieces(t) if isinstance(p, bytes))
            if len(words) + len(pieces) > COUNTED:
                yield flush()
        yield flush()

    counts = materialize(
        docs.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "piece binary, n bigint")
            .groupBy("piece").agg(F.sum("n").alias("n")), "piece-counts")
    # how many pieces have each count: as few rows as there are different counts
    left, cut = n, None
    for r in counts.groupBy("n").agg(F.count("*").alias("pieces")).orderBy(F.desc("n")).limit(n).collect():
        if r.pieces > left:
            break
        left, cut = left - r.pieces, r.n
    # pieces with the first count that doesn't fit in whole are left to the merges
    top = [] if cut is None else counts.where(F.col("n") >= cut).select("piece").collect()
    discard(counts)
    return sorted(bytes(r.piece) for r in top)


def ship_lexicon(spark: SparkSession, words: list[bytes], path: str) -> str:
    """Compile the words, hand the file to Spark for the executors, and return
    its name there."""
    voc = vocabulary(path)
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    local = os.path.join(tempfile.mkdtemp(prefix="textrec-"), name)
    write_lexicon(local, words, [voc.merge(w) for w in words])
    spark.sparkContext.addFile(local)
    return name


def build_lexicon(docs: DataFrame, path: str, n: int = LEXICON_WORDS, text_col: str = "text") -> str:
    ship_package(docs.sparkSession)
    return ship_lexicon(docs.sparkSession, frequent_words(docs, path, n, text_col), path)


def digests(docs: DataFrame, path: str, lexicon_file: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256."""
    pairs = id_text(docs, id_col, text_col)

    def run(batches):
        enc = encoder(path, lexicon_file)
        for rows, texts in text_slices(batches):
            found = enc.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), pa.array([n for _, _, n in found], pa.int64()),
                 pa.array([sha256_hex(ids) for ids, _, _ in found]), pa.array([sha256_hex(d) for _, d, _ in found])],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return pairs.mapInArrow(run, f"doc_id {id_type(pairs)}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def encode_documents(docs: DataFrame, path: str, lexicon_file: str, text_col: str = "text") -> DataFrame:
    """The documents with all their columns, and ``token_ids`` array<int> and
    ``decoded`` (under names with underscores added where taken)."""
    from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

    from textrec.llm.common import fresh
    names = [fresh(docs, "token_ids"), fresh(docs, "decoded")]
    schema = StructType([*docs.schema.fields]).add(names[0], ArrayType(IntegerType())).add(names[1], StringType())

    def run(batches):
        enc = encoder(path, lexicon_file)
        for rows, texts in text_slices(batches, text_col):
            found = enc.encode(texts)
            flat = np.array(" ".join([ids for ids, _, n in found if n]).split(), np.int32)
            ends = np.cumsum([0] + [n for _, _, n in found])
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                 pa.array([d for _, d, _ in found], pa.string())], names=[*rows.schema.names, *names])

    return docs.mapInArrow(run, schema)


def op5_transducer_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    path = public_tokenizers.path(VOCABULARY)
    docs = table(spark, sf_dir, "documents")
    return digests(docs, path, build_lexicon(docs, path))
