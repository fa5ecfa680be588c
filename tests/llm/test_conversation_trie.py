"""The conversation trie against brute force."""

import hashlib
import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidemark.llm import conversation_trie

SCHEMA = "conv_id long, turn long, role string, text string"
CLASH = "place depth k1 k2 p1 p2 e1 e2 level light t1 t2 top n h base digest node first".split()


def brute(rows, rebuild=True):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append(((turn is not None, turn or 0, digest), (role, text)))
    own = {c: [t for _, t in sorted(v)] for c, v in own.items()}
    if rebuild:
        h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
        own = {c: own.get(c - int(math.fmod(c, 5)), [])[: h[c]] + v[h[c] :] for c, v in own.items()}
    members, kids = {}, {}
    for c, turns in own.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    for node in members:
        if node:
            kids.setdefault(node[:-1], []).append(node)
    out, leaves, saved = [], {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = kids.get(node, [])
        leaves[node] = sum(leaves[k] for k in below) if below else 1
        saved[node] = sum(saved[k] for k in below) + ((len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0)
        ends = ",".join(str(c) for c in sorted(members[node]) if len(own[c]) == len(node))
        up = min(members[node[:-1]]) if node else None
        out.append((min(members[node]), len(node), up, len(members[node]), len(below), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(rng, n, deep, kinds):
    rows = []
    for c in range(n):
        for turn in range(rng.choice([1, 2, 5, deep])):
            rows.append((c, turn if rng.random() < 0.95 else None, "user" if turn % 2 == 0 else None, f"é{rng.randrange(kinds)}" if rng.random() < 0.8 else None))
    return rows


@pytest.mark.parametrize(("bucket", "kinds", "deep"), [(4096, 2, 6), (2, 1, 9), (3, 3, 12)])
def test_against_brute_force(spark, monkeypatch, bucket, kinds, deep):
    monkeypatch.setattr(conversation_trie, "BUCKET", bucket)
    rows = conversations(random.Random(bucket), 150, deep, kinds)
    rows += [(7, 1, "user", "tie"), (7, 1, "user", "tie"), (None, 0, "user", "x"), (-3, 4, "a", ""), (10**12, None, "", "a\0b")]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(1) for c in CLASH})
    turns = conversation_trie.ordered(df)
    got = conversation_trie.trie(*conversation_trie.rebuilt(turns)).drop("node").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    plain = conversation_trie.trie(turns).collect()
    assert sorted((tuple(r)[:-1] for r in plain), key=str) == brute(rows, rebuild=False)
    assert len({r["node"] for r in plain}) == len(plain)


def test_empty_and_turnless(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert conversation_trie.trie(*conversation_trie.rebuilt(conversation_trie.ordered(none))).count() == 0
    alone = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 >= 2)
    df = spark.createDataFrame([(alone, 0, "user", "gone"), (alone, 1, "user", "too")], SCHEMA)
    rows = conversation_trie.trie(*conversation_trie.rebuilt(conversation_trie.ordered(df))).collect()
    want = hashlib.sha256(str(alone).encode()).hexdigest()
    assert [tuple(r)[:8] for r in rows] == [(alone, 0, None, 1, 0, 1, 0, want)]


def test_a_long_conversation_and_its_copies(spark, monkeypatch):
    monkeypatch.setattr(conversation_trie, "BUCKET", 64)
    rows = [(c, i, "user", f"turn {i}" if i < 1000 - c else f"own {c}") for c in (1, 2, 3) for i in range(1000)]
    got = conversation_trie.trie(conversation_trie.ordered(spark.createDataFrame(rows, SCHEMA))).drop("node").collect()
    assert sorted(map(tuple, got), key=str) == brute(rows, rebuild=False)
