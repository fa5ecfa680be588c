"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import periodic_runs

CLASH = "start length period runs n_words collapsed rid i p w".split()


def brute(w):
    """Every (start, length, period): stretches of equal words p apart, the smallest p for each place."""
    n, out = len(w), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            if w[i] == w[i + p]:
                s = i
                while i + p < n and w[i] == w[i + p]:
                    i += 1
                if i + p - s >= max(6, 4 * p):
                    out.setdefault((s, i + p), p)
            i += 1
    return sorted((s, e - s, p) for (s, e), p in out.items())


def made_words(rng):
    k, w = rng.choice([1, 2, 3, 5]), []
    for _ in range(rng.randint(0, 7)):
        block = [rng.randrange(k) for _ in range(rng.randint(1, 7))]
        w += (block * rng.randint(1, 8))[: rng.randint(1, 50)]
    return w


def test_runs_against_brute_force():
    rng = random.Random(3)
    texts = [np.array(made_words(rng), np.int32) for _ in range(1500)]
    for w in texts:
        assert periodic_runs.runs(w) == brute(w.tolist())
    assert periodic_runs.runs_of(texts) == [brute(w.tolist()) for w in texts]


@pytest.mark.parametrize("w", [[0] * 5, [0] * 6, [0, 1] * 3 + [0], [0, 1] * 4, [0, 0, 1] * 4, [0, 1, 2] * 4 + [0, 1], [0] * 6 + [1] * 6])
def test_smallest_lengths(w):
    assert periodic_runs.runs(np.array(w, np.int32)) == brute(w)


def test_long_texts_are_linear_enough():
    for w in (np.zeros(60_000, np.int32), np.repeat(np.arange(10_000, dtype=np.int32), 6), np.arange(200_000, dtype=np.int32) % 7_001):
        found = periodic_runs.runs(w)
        assert found[0].start == 0 and found[-1].start + found[-1].length == len(w)


def expected(doc_id, text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    n, h = len(w), zlib.crc32(str(doc_id).encode() if doc_id is not None else b"")
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    runs = brute(w)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (
        doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
        digest("".join(f"{s},{n},{p}\n" for s, n, p in runs)), digest(" ".join(x for i, x in enumerate(w) if i not in gone)),
    )


def test_query_columns_on_odd_rows(spark):
    rng = random.Random(4)
    texts = [" ".join("abcdé"[k] for k in made_words(rng)) for _ in range(120)]
    texts += [None, "", " \n\t ", "one", "x " * 3000, "a b c \x1c\x1c " * 9, "漢字 🙂\n" * 7]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[5]), (None, texts[5]), (7, texts[7])]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in CLASH})
    got = [tuple(r) for r in periodic_runs.run_digests(df, periodic_runs.planted).collect()]
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted((expected(*r) for r in rows), key=key)
    assert periodic_runs.run_digests(df.limit(0)).count() == 0


def test_runs_and_collapsed_text(spark):
    d = spark.createDataFrame([(1, "so it goes " * 5 + "then it ends"), (2, None)], "doc_id long, text string")
    one, none = periodic_runs.run_table(d).orderBy("doc_id").collect()
    assert one["n_words"] == 18 and [tuple(r) for r in one["runs"]] == [(0, 15, 3)] and one["collapsed"] == "so it goes then it ends"
    assert (none["n_words"], none["runs"], none["collapsed"]) == (0, [], "")
