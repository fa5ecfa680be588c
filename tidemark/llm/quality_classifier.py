"""Document quality by attention-based multiple-instance learning.

A document is a bag of passages of ``WORDS`` words; only the document has a label.  Every
passage of the whole text is encoded as shares of byte classes, lengths and repetitions, and by a
learned layer.  Gated attention (Ilse, Tomczak and Welling, 2018) weighs the passages:

    h = tanh(x W + b),  a = softmax(((h V) tanh * sigmoid(h U)) w),  score = sigmoid(sum(a h) c + d)

and all of it is learned together from the labels, by Adam on the driver: from at most ``TRAIN_ROWS`` labelled
documents, those first in the order of a hash of their id, and at most ``BAG`` passages of each, evenly
spread over its text.  That bounds what is fitted, whatever the tables hold; scoring reads every passage of every
document.  Softmax weights are summed up batch by batch, so a text of any length needs the memory of a piece of it.

Labels come only from rows whose ``crc32`` of the id as text leaves 0, 1 or 3 modulo 4; those with 2 are held out.
Neither labels nor ids, languages or sources are inputs of a score.

Defined results: a text without words (null, empty, blank) is a bag of one passage of zeros.  A null
id is hashed as the empty text.  Of several labels of one id the mean decides, 1 from one half on; null labels are
ignored.  Without labels of both kinds every score is the share of label 1, or 0.5 without any.  Repeated rows keep a
row each; an empty table gives no rows.  Only the columns named here are read; others may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import slices

#: Words of a passage.
WORDS = 64
#: Labelled documents that the model is fitted to, and passages of each, at most.
TRAIN_ROWS, BAG = 4096, 64
#: Bytes of a text that are encoded at a time.
PIECE = 1 << 20
#: A score from which a document counts as good.
CUT = 0.7
#: Learned dimensions of a passage and of its attention; rounds over the training bags, and bags of a step.
HIDDEN, GATE, ROUNDS, STEP = 16, 8, 60, 64

_CLASSES = ["A-Z", "a-z", "0-9", r"\.", ",", "!?", ":;", r"\-'\"", "()\\[\\]{}", "#$%&*<>@^~_=+/\\\\", "|", r"\n", r"\x20\x09\x0B-\x0D", r"\x80-\xff"]
_CLASS_OF = np.array([next((k for k, c in enumerate(_CLASSES) if re.match(f"[{c}]", chr(b))), len(_CLASSES)) for b in range(256)], np.int64)
_BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_MARK = np.random.default_rng(1).integers(1, 1 << 63, 256, np.uint64)
_N_CLASSES = len(_CLASSES) + 1
FEATURES = _N_CLASSES + 8


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of some texts, and the number of the text that each belongs to."""
    sizes = np.array([len(t) + 1 for t in texts], np.int64)
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    begins = np.cumsum(sizes) - sizes
    blank = _BLANK[data]
    starts = np.flatnonzero(~blank & np.append(True, blank[:-1]))
    if not len(starts):
        return np.zeros((0, FEATURES)), np.zeros(0, np.int64)
    ends = np.flatnonzero(~blank & np.append(blank[1:], True)) + 1
    text = np.searchsorted(begins, starts, "right") - 1
    first = np.searchsorted(text, np.arange(len(texts)))
    nth = np.arange(len(starts)) - first[text]
    heads = np.flatnonzero(nth % WORDS == 0)
    owner, passage = text[heads], np.cumsum(nth % WORDS == 0) - 1
    n, count = len(heads), np.bincount(passage)
    # Bytes: from a passage's first word up to the next passage's, or to the end of the text.
    limit = np.minimum(np.append(starts[heads[1:]], len(data)), begins[owner] + sizes[owner])
    size = limit - starts[heads]
    edge = np.zeros(len(data) + 1, np.int64)
    edge[starts[heads]] += 1
    place = np.cumsum(edge[:-1]) - 1
    inside = np.flatnonzero(place >= 0)
    inside = inside[inside < limit[place[inside]]]
    shares = np.bincount(place[inside] * _N_CLASSES + _CLASS_OF[data[inside]], minlength=n * _N_CLASSES).reshape(n, _N_CLASSES) / size[:, None]
    # Words: equal words have equal sums over their marked bytes.
    in_word = np.arange(len(data)) - np.repeat(np.append(0, starts), np.diff(np.concatenate([[0], starts, [len(data)]])))
    value = np.add.reduceat(np.where(blank, np.uint64(0), _MARK[data] * (2 * in_word + 1).astype(np.uint64)), starts)
    mean = lambda x: np.bincount(passage, x, n) / count
    again = lambda k: np.append(np.zeros(k, bool), (value[k:] == value[:-k]) & (passage[k:] == passage[:-k]))[: len(value)]
    order = np.lexsort((value, passage))
    new = np.append(True, (value[order][1:] != value[order][:-1]) | (passage[order][1:] != passage[order][:-1]))
    length = ends - starts
    last = _CLASS_OF[data[ends - 1]]
    extra = [
        np.log1p(count) / np.log1p(WORDS), np.minimum(mean(length) / 10, 5), mean(again(1)), mean(again(2)), np.bincount(passage[order], new, n) / count,
        mean(_CLASS_OF[data[starts]] == 0), mean((last > 1) & (last != 3) & (last != 4) & (last < len(_CLASSES) - 1)), mean(length == 1),
    ]
    return np.column_stack([shares, *extra]), owner


def _pieces(data: bytes) -> Iterator[bytes]:
    """A text in pieces of about ``PIECE`` bytes, cut at white space where there is any."""
    at = 0
    while at < len(data) or at == 0:
        cut = re.compile(rb"[\x20\x09-\x0D]").search(data, at + PIECE, at + 2 * PIECE) if at + PIECE < len(data) else None
        end = cut.start() if cut else min(at + 2 * PIECE, len(data)) if at + PIECE < len(data) else len(data)
        yield data[at:end]
        if end == len(data):
            return
        at = end


@dataclass(frozen=True)
class Model:
    """Weights, and the mean and spread of the features; without weights, a constant share."""

    share: float
    mean: np.ndarray | None = None
    spread: np.ndarray | None = None
    weights: dict[str, np.ndarray] | None = None

    def encoded(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The representation of each passage and its attention before the softmax."""
        h = np.tanh((x - self.mean) / self.spread @ self.weights["W"] + self.weights["b"])
        return h, (np.tanh(h @ self.weights["V"]) * _sigmoid(h @ self.weights["U"])) @ self.weights["w"]

    def scored(self, z: np.ndarray) -> np.ndarray:
        return _sigmoid(z @ self.weights["c"] + self.weights["d"])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def _pooled(e: np.ndarray, h: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Attention weights within each bag, and each bag's weighted sum of ``h``.  Every bag has a passage."""
    top = np.full(n, -np.inf)
    np.maximum.at(top, owner, e)
    a = np.exp(e - top[owner])
    a /= np.bincount(owner, a, n)[owner]
    return a, np.stack([np.bincount(owner, a * h[:, j], n) for j in range(h.shape[1])], axis=1)


def fit(bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
    """A model of bags of features and their labels, 0 or 1."""
    y = np.asarray(labels, float)
    share = float(y.mean()) if len(y) else 0.5
    if not len(y) or not 0 < share < 1:
        return Model(share)
    flat = np.concatenate(bags)
    mean, spread = flat.mean(axis=0), flat.std(axis=0) + 1e-3
    rng = np.random.default_rng(seed)
    shape = {"W": (flat.shape[1], HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "U": (HIDDEN, GATE), "w": (GATE,), "c": (HIDDEN,)}
    p = {k: rng.normal(0, 1 / np.sqrt(s[0]), s) if k != "b" else np.zeros(s) for k, s in shape.items()}
    p["d"] = np.array(np.log(share / (1 - share)))
    m, v, t = {k: np.zeros_like(x) for k, x in p.items()}, {k: np.zeros_like(x) for k, x in p.items()}, 0
    bags = [(b - mean) / spread for b in bags]
    for _ in range(ROUNDS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), STEP):
            chosen = order[at : at + STEP]
            x = np.concatenate([bags[k] for k in chosen])
            owner = np.repeat(np.arange(len(chosen)), [len(bags[k]) for k in chosen])
            grads = _gradients(p, x, owner, y[chosen])
            t += 1
            for k, g in grads.items():
                g = g + 1e-4 * p[k]
                m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
                p[k] = p[k] - 0.01 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    return Model(share, mean, spread, p)


def _gradients(p: dict, x: np.ndarray, owner: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
    """Of the mean cross entropy of some bags, by the chain rule through the attention."""
    n = len(y)
    h = np.tanh(x @ p["W"] + p["b"])
    tv, su = np.tanh(h @ p["V"]), _sigmoid(h @ p["U"])
    a, z = _pooled((tv * su) @ p["w"], h, owner, n)
    dz_out = (_sigmoid(z @ p["c"] + p["d"]) - y) / n
    dz = dz_out[:, None] * p["c"]
    da = (dz[owner] * h).sum(axis=1)
    de = a * (da - np.bincount(owner, a * da, n)[owner])
    dg = de[:, None] * p["w"]
    dv, du = dg * su * (1 - tv * tv), dg * tv * su * (1 - su)
    dh = (a[:, None] * dz[owner] + dv @ p["V"].T + du @ p["U"].T) * (1 - h * h)
    return {
        "c": z.T @ dz_out, "d": dz_out.sum(), "w": (tv * su).T @ de, "V": h.T @ dv, "U": h.T @ du, "W": x.T @ dh, "b": dh.sum(axis=0),
    }


def _bag(data: bytes) -> np.ndarray:
    """Features of ``BAG`` passages of a text at most, evenly spread; of one of zeros if it has none."""
    found = np.concatenate([passages([piece])[0] for piece in _pieces(data)])
    if not len(found):
        return np.zeros((1, FEATURES))
    return found if len(found) <= BAG else found[np.linspace(0, len(found) - 1, BAG).round().astype(int)]


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> Model:
    """A model of the labels that are not held out.  At most ``rows`` bags reach the driver."""
    known = labels.where(labels["quality"].isNotNull() & ~held_out(labels["doc_id"])).groupBy(labels["doc_id"].alias("l_id"))
    known = known.agg((F.avg(labels["quality"]) >= 0.5).cast("int").alias("l_label"))
    turn = F.xxhash64("l_id")
    known = known.orderBy(turn, "l_id").limit(rows)
    schema = "l_id long, l_label int, l_turn long, bag binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 3)):
            bags = [_bag((t.as_py() or "").encode()).astype(np.float32).tobytes() for t in batch.column(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(bags, pa.binary())], names=["l_id", "l_label", "l_turn", "bag"])

    texts = docs.select(docs["doc_id"].cast("long").alias("d_id"), docs["text"].alias("d_text"))
    met = texts.join(F.broadcast(known), F.expr("d_id = l_id"))
    met = met.select("l_id", "l_label", F.xxhash64("l_id", "d_text").alias("l_turn"), "d_text").mapInArrow(run, schema)
    got = met.orderBy("l_turn", "l_id").limit(rows).toArrow()
    bags = [np.frombuffer(b.as_py(), np.float32).reshape(-1, FEATURES).astype(float) for b in got.column("bag")]
    return fit(bags, np.asarray(got.column("l_label"), float))


def _judged(model: Model, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: score, passages, the passage with the largest attention (from 0), and its weight."""
    n = len(texts)
    top, total, count, at = np.full(n, -np.inf), np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    z = np.zeros((n, HIDDEN))

    def add(x: np.ndarray, owner: np.ndarray, size: np.ndarray) -> None:
        """Softmax sums go on from one piece of a text to its next."""
        nonlocal top, total, z, at
        h, e = model.encoded(x)
        new = top.copy()
        np.maximum.at(new, owner, e)
        shrink = np.exp(np.where(np.isneginf(top), -np.inf, top - new))
        w = np.exp(e - new[owner])
        total = total * shrink + np.bincount(owner, w, n)
        z = z * shrink[:, None] + np.stack([np.bincount(owner, w * h[:, j], n) for j in range(HIDDEN)], axis=1)
        first = np.searchsorted(owner, owner)
        best = np.flatnonzero((e == new[owner]) & (new[owner] > top[owner]))[::-1]
        at[owner[best]] = size[owner[best]] + best - first[best]
        top = new

    def counted(x: np.ndarray, owner: np.ndarray) -> None:
        nonlocal count
        if model.weights is not None and len(x):
            add(x, owner, count)
        count = count + np.bincount(owner, minlength=n)

    short = [k for k, t in enumerate(texts) if len(t) <= PIECE]
    x, owner = passages([texts[k] for k in short]) if short else (np.zeros((0, FEATURES)), np.zeros(0, np.int64))
    counted(x, np.array(short, np.int64)[owner])
    for k, t in enumerate(texts):
        if len(t) > PIECE:
            for piece in _pieces(t):
                x, owner = passages([piece])
                counted(x, np.full(len(x), k))
    if model.weights is None:
        return np.full(n, model.share), count, at, np.where(count > 0, 1.0, 0.0)
    empty = np.flatnonzero(count == 0)
    if len(empty):
        add(np.zeros((len(empty), FEATURES)), empty, count)
    return model.scored(z / total[:, None]), count, at, 1 / total


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, n_passages``, and the passage that counts most: ``top_passage`` (from 0) and its ``top_weight``."""
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("score", T.DoubleType()), T.StructField("n_passages", T.LongType()),
        T.StructField("top_passage", T.LongType()), T.StructField("top_weight", T.DoubleType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            found = _judged(model, [(t.as_py() or "").encode() for t in batch.column(1)])
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(x) for x in found]], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op12 over ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "n_passages", "top_passage", "top_weight")
