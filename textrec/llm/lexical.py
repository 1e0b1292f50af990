"""Ranked lexical search for many queries that share their common parts.

The items (queries) are dealt by hash into parts of about ``PART_TERMS`` (item,
term) pairs (more only where one item has more distinct terms), whose plans are
of that size and are sent to every task; each part is one pass over the
documents.

Mining.  Terms that occur in just the same items of a part form a class.  Two
classes or sums that stand together in two or more items are replaced there by
their sum, the most frequent pair first, until no pair is shared.  What
remains is a DAG: classes at the bottom, sums above, items as short lists of
either.

Accumulators.  A pass over the texts writes, for each document, its length and
the counts of the part's terms; sums over that table give the number of
documents, their length and the document frequencies.  A second pass reads the
table in blocks: the contributions of the terms are added into one accumulator
for each class and document of the block, each sum is made once from its two
parts, and items add up theirs.  A block holds so many documents that its
accumulators take ``BLOCK_BYTES``.

Ranking.  A task keeps the best ``k`` documents of each item; those of all tasks
meet in two steps, so that no group grows with the number of tasks.  Scores are
64-bit integers, so any order of adding gives the same.

Defined cases: null and wordless texts have no terms; documents without terms
don't count; rows with one item_id are one item with all their terms; an item
without terms, or none of whose terms occurs, has no results; equal scores are
ranked by ascending doc_id, null last; repeated documents rank side by side;
an empty table gives no rows; other columns are not read."""

from __future__ import annotations

import heapq
import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from textrec.llm.common import id_text, id_type, table, text_slices
from textrec.llm.positional import words_of
from textrec.session import materialize, ship_package

PART_TERMS = 1 << 15
BLOCK_BYTES = 32 << 20
TOP = 10
#: Candidates of an item are first ranked in this many groups.
GROUPS = 64


# --- mining -------------------------------------------------------------------

def mine(items: list[list[str]]) -> tuple[list[list[str]], list[tuple[int, int]], list[list[int]]]:
    """(terms of each class, the two parts of each sum, nodes of each item) of
    items given as distinct terms.  Nodes are numbered classes first, then sums,
    each after its parts."""
    holders: dict[str, list[int]] = defaultdict(list)
    for i, terms in enumerate(items):
        for t in terms:
            holders[t].append(i)
    by_holders: dict[tuple, list[str]] = defaultdict(list)
    for t in sorted(holders):
        by_holders[tuple(holders[t])].append(t)
    signatures = sorted(by_holders, key=lambda s: (-len(s), s))
    classes = [by_holders[s] for s in signatures]
    uses: list[set[int]] = [set() for _ in items]
    for node, s in enumerate(signatures):
        for i in s:
            uses[i].add(node)

    shared = {node for node, s in enumerate(signatures) if len(s) > 1}
    together: dict[tuple[int, int], set[int]] = defaultdict(set)
    for i, nodes in enumerate(uses):
        own = sorted(nodes & shared)
        for x, a in enumerate(own):
            for b in own[x + 1:]:
                together[a, b].add(i)
    queue = [(-len(where), pair) for pair, where in together.items() if len(where) > 1]
    heapq.heapify(queue)
    sums: list[tuple[int, int]] = []
    while queue:
        n, (a, b) = heapq.heappop(queue)
        where = together.get((a, b), ())
        if len(where) < 2:
            continue
        if len(where) != -n:                        # fewer than when it was put down
            heapq.heappush(queue, (-len(where), (a, b)))
            continue
        new = len(classes) + len(sums)
        sums.append((a, b))
        shared.add(new)
        touched = set()
        for i in sorted(where):
            uses[i] -= {a, b}
            for c in uses[i] & shared:
                for old in (a, b):
                    together[min(c, old), max(c, old)].discard(i)
                together[c, new].add(i)
                touched.add((c, new))
            uses[i].add(new)
        del together[a, b]
        for pair in sorted(touched):
            if len(together[pair]) > 1:
                heapq.heappush(queue, (-len(together[pair]), pair))
    return classes, sums, [sorted(u) for u in uses]


_PLAN = pa.schema([("part", pa.int32()), ("node", pa.int32()), ("item_id", pa.int64()), ("terms", pa.list_(pa.string())),
                   ("uses", pa.list_(pa.int32()))])


def query_plans(items: DataFrame, id_col: str = "item_id", text_col: str = "text",
                part_terms: int = PART_TERMS) -> DataFrame:
    """One row a node or item of each part's DAG: (part, node, terms) of a
    class, (part, node, uses) of a sum, (part, item_id, uses) of an item."""
    ship_package(items.sparkSession)
    terms = materialize(_item_terms(items, id_col, text_col).distinct(), "query-terms")
    parts = max(1, -(-terms.count() // part_terms))
    dealt = terms.withColumn("part", F.pmod(F.xxhash64("item_id"), F.lit(parts)).cast("int"))

    def plan(rows: pa.Table) -> pa.Table:
        part = rows["part"][0].as_py()
        asked: dict[int | None, list[str]] = defaultdict(list)
        for item, term in zip(rows["item_id"].to_pylist(), rows["term"].to_pylist(), strict=True):
            asked[item].append(term)
        order = sorted(asked, key=lambda i: (i is None, i or 0))
        classes, sums, uses = mine([sorted(asked[i]) for i in order])
        out = [(part, n, None, t, None) for n, t in enumerate(classes)]
        out += [(part, len(classes) + n, None, None, list(ab)) for n, ab in enumerate(sums)]
        out += [(part, None, i, None, u) for i, u in zip(order, uses, strict=True)]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _PLAN, strict=True)], schema=_PLAN)

    return dealt.groupBy("part").applyInArrow(
        plan, "part int, node int, item_id bigint, terms array<string>, uses array<int>")


def _item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    def split(batches):
        for rows, texts in text_slices(batches):
            ids = rows.column(0).to_pylist()
            pairs = [(i, w.decode("utf-8", "surrogatepass")) for i, t in zip(ids, texts, strict=True) for w in set(words_of(t))]
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in pairs], pa.int64()),
                                                  pa.array([w for _, w in pairs], pa.string())], ["item_id", "term"])
    rows = items.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(split, "item_id bigint, term string")


class Plan:
    """A part's DAG, ready for the tasks: term numbers, classes, sums, items."""

    def __init__(self, rows: list):
        nodes = sorted((r for r in rows if r["node"] is not None), key=lambda r: r["node"])
        asked = sorted((r for r in rows if r["node"] is None), key=lambda r: (r["item_id"] is None, r["item_id"] or 0))
        self.number: dict[bytes, int] = {}
        class_of = []
        for r in nodes:
            for t in r["terms"] or ():
                self.number[t.encode("utf-8", "surrogatepass")] = len(class_of)
                class_of.append(r["node"])
        self.class_of = np.array(class_of, np.int64)
        self.n_nodes = len(nodes)
        self.sums = [(r["node"], *r["uses"]) for r in nodes if r["uses"]]
        self.items = [(r["item_id"], np.array(r["uses"], np.int64)) for r in asked]


# --- documents ------------------------------------------------------------------

def term_counts(docs: DataFrame, number: dict[bytes, int], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n, terms, tfs): a document's length in terms and the counts of
    the numbered terms; documents without any term are left out."""
    def run(batches):
        for rows, texts in text_slices(batches):
            n, terms, tfs, sizes, keep = [], [], [], [0], []
            for place, text in enumerate(texts):
                words = words_of(text)
                if not words:
                    continue
                tf: dict[int, int] = {}
                for w in words:
                    at = number.get(w)
                    if at is not None:
                        tf[at] = tf.get(at, 0) + 1
                keep.append(place)
                n.append(len(words))
                terms.extend(tf)
                tfs.extend(tf.values())
                sizes.append(len(terms))
            if keep:
                offsets = pa.array(sizes, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0).take(pa.array(keep)), pa.array(n, pa.int64()),
                     pa.ListArray.from_arrays(offsets, pa.array(terms, pa.int32())),
                     pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    rows = id_text(docs, id_col, text_col)
    return rows.mapInArrow(run, f"doc_id {id_type(rows)}, n bigint, terms array<int>, tfs array<bigint>")


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class Best:
    """The best k (score, doc) of each item seen so far."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.scores = [np.empty(0, np.int64)] * n_items
        self.docs = [np.empty(0, np.int64)] * n_items
        self.nulls = [np.empty(0, bool)] * n_items

    def add(self, item: int, scores: np.ndarray, docs: np.ndarray, nulls: np.ndarray) -> None:
        held = self.scores[item]
        least = max(1, held[-1] if len(held) >= self.k else 1)
        at = np.flatnonzero(scores >= least)
        if not len(at):
            return
        if len(at) > 4 * self.k:                   # no tie at the k-th place is lost
            at = at[scores[at] >= np.partition(scores[at], -self.k)[-self.k]]
        s = np.concatenate([held, scores[at]])
        d, z = np.concatenate([self.docs[item], docs[at]]), np.concatenate([self.nulls[item], nulls[at]])
        order = np.lexsort((d, z, -s))[:self.k]
        self.scores[item], self.docs[item], self.nulls[item] = s[order], d[order], z[order]


def accumulators(plan: Plan, weights: np.ndarray, m: np.ndarray, sizes: np.ndarray, terms: np.ndarray,
                 tfs: np.ndarray) -> np.ndarray:
    """Partial scores of a block, one row a node and one column a document."""
    doc = np.repeat(np.arange(len(sizes)), sizes)
    parts = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[doc]))
    acc = np.zeros((plan.n_nodes, len(sizes)), np.int64)
    np.add.at(acc, (plan.class_of[terms], doc), parts)
    for node, a, b in plan.sums:
        np.add(acc[a], acc[b], out=acc[node])
    return acc


def candidates(counts: DataFrame, plan: Plan, weights: np.ndarray, n_docs: int, length: int, k: int,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, doc_id, score): the best k documents of each item and task."""
    block = max(1, block_bytes // (8 * max(1, plan.n_nodes)))

    def run(batches):
        best = Best(len(plan.items), k)
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                rows = batch.slice(at, block)
                ids, n, terms, tfs = rows.columns
                sizes = np.diff(terms.offsets.to_numpy())
                m = 10 + (90 * n.to_numpy() * n_docs) // length
                acc = accumulators(plan, weights, m, sizes, terms.flatten().to_numpy(), tfs.flatten().to_numpy())
                nulls = ids.is_null().to_numpy(zero_copy_only=False)
                docs = ids.fill_null(0).to_numpy().astype(np.int64)
                for i, (_, uses) in enumerate(plan.items):
                    best.add(i, acc[uses].sum(axis=0), docs, nulls)
        rows = [(item, None if z else int(d), int(s)) for i, (item, _) in enumerate(plan.items)
                for s, d, z in zip(best.scores[i], best.docs[i], best.nulls[i], strict=True)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)],
                                             ["item_id", "doc_id", "score"])

    return counts.mapInArrow(run, "item_id bigint, doc_id bigint, score bigint")


def rank(found: DataFrame, k: int) -> DataFrame:
    """The best k of each item: first within ``GROUPS`` groups of its candidates."""
    from pyspark.sql import Window
    order = (F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    grouped = found.withColumn("g", F.pmod(F.hash("doc_id"), F.lit(GROUPS)))
    some = grouped.withColumn("r", F.row_number().over(Window.partitionBy("item_id", "g").orderBy(*order))).where(F.col("r") <= k)
    over = Window.partitionBy("item_id").orderBy(*order)
    return (some.select("item_id", "doc_id", "score", F.row_number().over(over).alias("rank")).where(F.col("rank") <= k)
                .select("item_id", "rank", "doc_id", "score"))


def search(docs: DataFrame, items: DataFrame, k: int = TOP, doc_id: str = "doc_id", doc_text: str = "text",
           item_id: str = "item_id", item_text: str = "text", part_terms: int = PART_TERMS,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    plans = materialize(query_plans(items, item_id, item_text, part_terms), "query-plans")
    out = None
    for part in sorted(r["part"] for r in plans.select("part").distinct().collect()):
        plan = Plan(plans.where(F.col("part") == part).collect())
        counts = materialize(term_counts(docs, plan.number, doc_id, doc_text), "query-counts")
        total = counts.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
        df = dict(counts.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count("*")).collect())
        weights = np.array([weight(total["n"], df.get(t, 0)) for t in range(len(plan.number))], np.int64)
        found = candidates(counts, plan, weights, total["n"], total["l"] or 1, k, block_bytes)
        out = found if out is None else out.unionByName(found)
    if out is None:
        return docs.sparkSession.createDataFrame([], "item_id bigint, rank int, doc_id bigint, score bigint")
    return rank(out, k)


def op12_shared_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
