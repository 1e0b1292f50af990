"""The prefix trie against plain Python, over bands and with a tiny queue."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from textrec.llm import prefix_trie as P

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows, group=100, heads=6):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            token = hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()
            own[c].append((turn is not None, turn or 0, role, token, text))
    turns = {c: [(x[2], x[4]) for x in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, mine in turns.items():
        h = zlib.crc32(str(c).encode()) % heads
        rebuilt[c] = turns.get(c - c % group, [])[:h] + mine[h:]
    members = defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    out = []
    totals = {}
    for node in sorted(members, key=len, reverse=True):
        own_saved = (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
        kids = children[node]
        totals[node] = (sum(totals[k][0] for k in kids) or 1, own_saved + sum(totals[k][1] for k in kids))
        ends = ",".join(str(c) for c in sorted(c for c in members[node] if len(rebuilt[c]) == len(node)))
        out.append((min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]), len(kids),
                    *totals[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def trie(df, **more):
    turns = P.numbered_turns(df)
    return sorted([tuple(r) for r in P.build(P.rebuild(turns), **more).select(*COLUMNS).collect()], key=str)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(3)
    out = []
    for c in list(range(60)) + [100, 101, 105, 230, 231, 999]:          # 200 and 900 are absent
        for t in range(rnd.randint(1, 8)):
            out.append((c, t, rnd.choice(["user", "user", "assistant", None]), rnd.choice(["a", "bb", "ccc é😀", "", None])))
    out += [(40, None, "user", "null turn"), (41, 1, "user", "tie b"), (41, 1, "user", "tie a"), (41, 1, None, "tie a"),
            (42, 0, "user", "same"), (42, 0, "user", "same"), (None, 0, "user", "no id"), (50, 99, "user", "x" * 100_000)]
    out += [(c, t, "user", "copy") for c in range(300, 340) for t in range(6)]       # a group of copies
    out += [(700, t, "user", f"turn {t}") for t in range(1500)]                       # a long conversation
    return out


@pytest.fixture(scope="module")
def df(spark, rows):
    return spark.createDataFrame([(*r, "key", 1, b"") for r in rows],
                                 "conv_id bigint, turn bigint, role string, text string, key string, depth int, token binary"
                                 ).repartition(5)


@pytest.mark.parametrize("shard_convs, memory", [(4096, 1 << 17), (4, 7), (2, 1)])
def test_equals_plain_python(rows, df, shard_convs, memory):
    assert trie(df, shard_convs=shard_convs, memory=memory) == brute(rows)


def test_empty_and_turnless(spark, df):
    assert trie(df.limit(0)) == []
    # conversations with one turn each take none of it when h is larger and the base is absent
    rows = [(c, 0, "user", "t") for c in (107, 111, 112, 113, 114)]
    got = trie(spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string"))
    assert got == brute(rows)
    assert any(r[1] == 0 and r[-1] != P.NO_ENDS for r in got)


def test_long_lists_of_ends_are_joined_in_order(spark):
    rows = [(c, b"k" * 16, True) for c in range(5000)] + [(c, b"j" * 16, True) for c in range(3)]
    df = spark.createDataFrame(rows, "conv_id bigint, key binary, ends boolean").repartition(7)
    got = {bytes(r.key): r.ends_sha256 for r in P.end_digests(df, chunk_bytes=50).collect()}
    assert got[b"k" * 16] == hashlib.sha256(",".join(map(str, range(5000))).encode()).hexdigest()
    assert got[b"j" * 16] == hashlib.sha256(b"0,1,2").hexdigest()


def test_queue_spills_in_order():
    rnd = random.Random(1)
    queue = P.SpillingQueue(memory=10)
    sent = [(rnd.randint(0, 20), bytes([rnd.randint(0, 3)]) * 16, i, i) for i in range(500)]
    for m in sent:
        queue.push(m)
    assert queue.runs
    got = [m for level in range(21) for b in range(4) for m in queue.take(level, bytes([b]) * 16)]
    assert got == sorted(sent) and not len(queue)
