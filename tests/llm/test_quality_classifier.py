"""Multiple-instance learning: features and gradients against plain versions, held-out accuracy, odd rows."""

import random
import re
import zlib

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import quality_classifier as qc

ODD = [None, "", " \n\t ", "one", "x " * 3000, "Äpfel — 漢字 🙂!!\n\nline|two", "A\x1cb\0c"]


def plain_features(text):
    data = text.encode()
    found = list(re.finditer(rb"[^\x20\x09-\x0D]+", data))
    out = []
    for i in range(0, len(found), qc.WORDS):
        words = [m[0] for m in found[i : i + qc.WORDS]]
        end = found[i + qc.WORDS].start() if i + qc.WORDS < len(found) else len(data) + 1
        part = (data + b"\n")[found[i].start() : end]
        shares = [sum(qc._CLASS_OF[b] == k for b in part) / len(part) for k in range(len(qc._CLASSES) + 1)]
        n = len(words)
        last = [qc._CLASS_OF[w[-1]] for w in words]
        out.append([
            *shares, np.log1p(n) / np.log1p(qc.WORDS), min(sum(map(len, words)) / n / 10, 5), sum(a == b for a, b in zip(words, words[1:])) / n,
            sum(a == b for a, b in zip(words, words[2:])) / n, len(set(words)) / n, sum(65 <= w[0] <= 90 for w in words) / n,
            sum(1 < k < len(qc._CLASSES) - 1 and k not in (3, 4) for k in last) / n, sum(len(w) == 1 for w in words) / n,
        ])
    return np.array(out).reshape(-1, qc.FEATURES)


def test_features_against_a_plain_version():
    rng = random.Random(1)
    texts = [t or "" for t in ODD] + [" ".join(rng.choice(["a", "a", "Bc", "d!", "é.", "|", "#5", "THE"]) for _ in range(rng.randint(0, 300))) for _ in range(30)]
    x, owner = qc.passages([t.encode() for t in texts])
    for k, t in enumerate(texts):
        assert np.allclose(x[owner == k], plain_features(t)), t


def test_gradients():
    rng = np.random.default_rng(2)
    x, owner, y = rng.normal(size=(9, 5)), np.array([0, 0, 0, 1, 2, 2, 2, 2, 2]), np.array([1.0, 0, 1])
    p = {k: rng.normal(size=s) for k, s in {"W": (5, 4), "b": (4,), "V": (4, 3), "U": (4, 3), "w": (3,), "c": (4,), "d": ()}.items()}

    def loss(p):
        h = np.tanh(x @ p["W"] + p["b"])
        _, z = qc._pooled((np.tanh(h @ p["V"]) * qc._sigmoid(h @ p["U"])) @ p["w"], h, owner, 3)
        s = qc._sigmoid(z @ p["c"] + p["d"])
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    for k, g in qc._gradients(p, x, owner, y).items():
        for at in np.ndindex(p[k].shape):
            hi, lo = ({n: v.copy() for n, v in p.items()} for _ in "ab")
            hi[k][at] += 1e-5
            lo[k][at] -= 1e-5
            assert abs((loss(hi) - loss(lo)) / 2e-5 - np.asarray(g)[at]) < 1e-6


def corpus(n, rng):
    """Good texts, and texts with one bad passage somewhere: only attention can tell where."""
    word = lambda: "".join(rng.choice("aeioustrnl") for _ in range(rng.randint(2, 9)))
    rows = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(5, 600))]
        bad = rng.random() < 0.4
        if bad:
            at = rng.randrange(len(words))
            words[at : at + 80] = [w.upper() + "!!" for w in words[at : at + 80]] if rng.random() < 0.5 else [words[at]] * 80
        rows.append((i, " ".join(words), 0 if bad else 1))
    return rows


def test_held_out_accuracy_and_attention(spark):
    rows = corpus(900, random.Random(3))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, q if zlib.crc32(str(i).encode()) % 4 != 2 else 1 - q) for i, _, q in rows], "doc_id long, quality int")
    model = qc.train(docs, labels)  # held-out labels are wrong here: they must not matter
    got = {r["doc_id"]: r for r in qc.score(docs, model).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    right = sum((got[i]["score"] >= qc.CUT) == (q == 1) for i, _, q in held)
    assert len(held) > 150 and right / len(held) > 0.96
    again = qc.train(docs.repartition(5), labels.repartition(3))
    assert np.allclose([r["score"] for r in sorted(qc.score(docs, again).collect())], [got[i]["score"] for i, _, _ in rows], atol=1e-9)


def test_long_texts_in_pieces(monkeypatch):
    rows = corpus(200, random.Random(4))
    model = qc.fit([qc._bag(t.encode()) for _, t, _ in rows], np.array([q for *_, q in rows]))
    texts = [" ".join(t for _, t, _ in rows[k : k + 9]).encode() for k in range(0, 180, 9)] + [b"", b"z" * 9000]
    monkeypatch.setattr(qc, "PIECE", 2000)
    got, n, top, weight = qc._judged(model, texts)
    for k, t in enumerate(texts):
        x = np.concatenate([qc.passages([p])[0] for p in qc._pieces(t)])
        assert b"".join(qc._pieces(t)) == t and n[k] == len(x)
        h, e = model.encoded(x if len(x) else np.zeros((1, qc.FEATURES)))
        a, z = qc._pooled(e, h, np.zeros(len(e), int), 1)
        assert np.isclose(got[k], model.scored(z)[0]) and top[k] == e.argmax() and np.isclose(weight[k], a.max())


def test_odd_rows_and_tables(spark):
    docs = spark.createDataFrame([*enumerate(ODD), (4, ODD[4]), (None, "one")], "doc_id long, text string").withColumns({c: F.lit(1) for c in ("score", "l_id", "l_label", "bag")})
    labels = spark.createDataFrame([(0, 1), (1, 0), (3, 1), (3, 1), (4, None), (5, 0), (None, 1), (99, 1)], "doc_id long, quality int")
    for model in (qc.train(docs, labels), qc.train(docs, labels.limit(0)), qc.train(docs.limit(0), labels), qc.train(docs, labels, rows=1)):
        got = qc.score(docs, model).collect()
        assert len(got) == len(ODD) + 2 and all(0 <= r["score"] <= 1 for r in got)
        assert qc.score(docs.limit(0), model).count() == 0
    assert qc.train(docs, labels.limit(0)).share == 0.5
