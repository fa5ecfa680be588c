"""SentencePiece encoding and decoding, with a max-plus scan for giant documents.

A segmentation is a path through a lattice whose nodes are pieces at places in
the text.  A chunk of text is a max-plus matrix: its rows are the last pieces that
can end at or before the chunk's start, its columns those at its end, its entries
the best path weight between them.  Chunks are read independently.  As matrices
combine associatively, ``FAN`` neighbours at a time become one, level by level, until
one is left for a document; on the way back down, each block whose first and last
piece are known fixes those at the boundaries of its ``FAN`` parts.  Then each chunk
backtraces its own path.  No task ever holds more than ``FAN`` matrices of a document.

Arc weights depend on the model:

* unigram models: the score of the piece.  The best path is the model's encoding.
* BPE models: 0 if the two neighbouring pieces are what the model makes of their
  concatenation, else minus infinity: the matrices are Boolean.  A sequence is the BPE encoding of a text
  exactly if all its neighbours agree in this way, so the only finite path is the
  model's encoding.  (Adding up the scores of a BPE model would not give it.)

Where no piece can cross a place (before a word-start mark that follows another
character) all rows of a matrix agree from there on, and the matrix has rank one.
So the lattice is walked at the ends of a chunk only, and the library encodes what
lies in between, as it does texts of up to ``GIANT`` characters, which are one chunk.
Text without such places is walked whole, in Python.

Defined results: null and empty texts have no tokens and decode to the empty
string.  A text with the mark for a space (U+2581) has ``round_trip`` false: the model
does not tell the two apart.  Rows are encoded one by one, null and repeated ids and repeated rows
included.  An empty table gives no rows.  Only ``doc_id`` and ``text`` are read by
name; other columns may have any.  The ids of one text have to fit in a row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import slices
from tidemark.session import BROADCAST_BYTES, broadcast_within, materialise

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
#: Characters from which on a document is giant, and of a chunk.
GIANT, CHUNK = 32_768, 8_192
#: Matrices that are combined at a time.
FAN = 16
#: Neighbouring pieces whose weight a worker remembers: a few MB.
CACHE = 20_000
#: Bytes of text that a worker encodes at a time; ids take some 10 times that while they are lists.
SLICE_BYTES = 1 << 20
MARK = "▁"
START = (0, 0)  # the node before the first piece


class Pieces:
    """The lattice over one vocabulary.

    ``encode`` gives the ids of a text piece by piece without any prefix; it is
    asked about two neighbouring pieces at most, or words.  ``scores`` makes the
    lattice a unigram one.
    """

    def __init__(self, ids: dict[str, int], encode, scores: dict[str, float] | None = None, unknown=None, floor: float = -100.0):
        self.ids, self.encode, self.scores, self.floor = ids, encode, scores, floor
        self.longest = max(map(len, ids))
        self.unknown = unknown or (lambda c: [0])
        self.known: dict[tuple[str, str], float] = {}

    def tokens(self, piece: str) -> list[int]:
        return [self.ids[piece]] if piece in self.ids else self.unknown(piece)

    def weight(self, before: str, piece: str) -> float:
        """Of the arc from ``before`` (empty at a fresh start) to ``piece``."""
        if self.scores is not None:
            return self.scores.get(piece, self.floor)
        key = (before, piece)
        if key not in self.known:
            if len(self.known) > CACHE:
                self.known.clear()
            want = (self.tokens(before) if before else []) + self.tokens(piece)
            self.known[key] = 0.0 if self.encode(before + piece) == want else -np.inf
        return self.known[key]

    def ending(self, s: str, end: int, least: int = 0) -> list[int]:
        """Starts, from ``least`` on, of the pieces that end at ``end``."""
        found = [a for a in range(max(least, end - self.longest), end) if s[a:end] in self.ids]
        return found if end - 1 < least or s[end - 1 : end] in self.ids else [*found, end - 1]

    def walk(self, s: str, lo: int, hi: int, entry: dict) -> dict:
        """Best paths from each of ``entry``'s nodes to all nodes that end in ``(lo, hi]``.

        Nodes are ``(end, start)``.  The result maps a node to ``{source: (weight, node before)}``.
        """
        at: dict[int, list] = {}
        for node, sources in entry.items():
            at.setdefault(node[0], []).append((node, sources))
        out: dict = {}
        for end in range(lo + 1, hi + 1):
            for a in self.ending(s, end):
                best: dict = {}
                for before, sources in at.get(a, ()):
                    w = self.weight(s[before[1] : before[0]], s[a:end])
                    if w == -np.inf:
                        continue
                    for source, (v, _) in sources.items():
                        if source not in best or v + w > best[source][0]:
                            best[source] = (v + w, before)
                if best:
                    out[end, a] = best
                    at.setdefault(end, []).append(((end, a), best))
        return out


def _syncs(s: str, lo: int, hi: int) -> list[int]:
    """The first and last place in ``[lo, hi]`` that no piece crosses."""
    ok = lambda p: 0 < p < len(s) and s[p] == MARK and s[p - 1] != MARK
    first = next((p for p in range(lo, hi + 1) if ok(p)), None)
    return [] if first is None else [first, next(p for p in range(hi, first - 1, -1) if ok(p))]


def entries(m: Pieces, s: str, b: int) -> list[tuple[int, int]]:
    """The nodes that can be the last one at or before ``b``; the start of a text is a single one."""
    if b == 0:
        return [START]
    return [(end, a) for end in range(max(1, b - m.longest + 1), b + 1) for a in m.ending(s, end)]


def matrix(m: Pieces, s: str, b: int, last: bool) -> list[list]:
    """``[entry, exit, weight]`` of the chunk ``s[b:]``; ``s[:b]`` is what precedes it.

    Nodes are given as ``[distance to the boundary, length]``.
    """
    e = len(s)
    src = {n: {i: (0.0, None)} for i, n in enumerate(entries(m, s, b))}
    names = list(src)
    sync = _syncs(s, b, e - m.longest)
    ends = lambda node: node[0] == e if last else node[0] > e - m.longest
    rel = lambda node, at: [at - node[0], node[0] - node[1]]
    if not sync:
        out = m.walk(s, b, e, src)
        return [[rel(names[i], b), rel(n, e), w] for n, to in out.items() if ends(n) for i, (w, _) in to.items()]
    head = m.walk(s, b, sync[0], src)
    at = [to for n, to in (*src.items(), *head.items()) if n[0] == sync[0]]
    c = {i: max(to[i][0] for to in at if i in to) for i in {i for to in at for i in to}}
    # All paths share the stretch between the syncs, so its weight is left out.
    tail = m.walk(s, sync[1], e, {(sync[1], sync[1]): {0: (0.0, None)}})
    r = {n: to[0][0] for n, to in tail.items() if ends(n)}
    return [[rel(names[i], b), rel(n, e), w + v] for i, w in c.items() for n, v in r.items()]


def combine(a: list[list], b: list[list]) -> list[list]:
    """The max-plus product."""
    by: dict = {}
    for i, j, w in b:
        by.setdefault(tuple(i), []).append((tuple(j), w))
    best: dict = {}
    for i, j, w in a:
        for k, v in by.get(tuple(j), ()):
            key = (tuple(i), k)
            best[key] = max(best.get(key, -np.inf), w + v)
    return [[list(i), list(k), w] for (i, k), w in best.items()]


def folded(matrices: list[list[list]]) -> list[list]:
    """The product of neighbouring matrices, by halves."""
    while len(matrices) > 1:
        pairs = [combine(*matrices[i : i + 2]) for i in range(0, len(matrices) - 1, 2)]
        matrices = pairs + matrices[2 * len(pairs) :]
    return matrices[0]


def best_exit(m: list[list]) -> list[int]:
    """Where the best path through a whole document ends."""
    return max(m, key=lambda x: x[2])[1]


def boundaries(matrices: list[list[list]], entry: list[int] = (0, 0), exit_: list[int] | None = None) -> list[list[int]]:
    """The nodes at every boundary on the best path from ``entry`` to ``exit_`` (the best one if not given)."""
    at, steps = {tuple(entry): 0.0}, []
    for m in matrices:
        new: dict = {}
        for i, j, w in m:
            i, j = tuple(i), tuple(j)
            if i in at and (j not in new or at[i] + w > new[j][0]):
                new[j] = (at[i] + w, i)
        steps.append(new)
        at = {j: w for j, (w, _) in new.items()}
    node = tuple(exit_) if exit_ is not None else max(at, key=lambda j: at[j])
    out = [node]
    for new in reversed(steps):
        node = new[node][1]
        out.append(node)
    return [list(n) for n in reversed(out)]


def trace(m: Pieces, s: str, b: int, entry: list[int], exit_: list[int], words) -> list[int]:
    """Ids of the chunk's own pieces: after the entry node, up to and with the exit node."""
    e = len(s)
    first, final = (b - entry[0], b - entry[0] - entry[1]), (e - exit_[0], e - exit_[0] - exit_[1])

    def back(out: dict, node: tuple, stop: tuple) -> list[int]:
        pieces = []
        while node != stop:
            pieces.append(s[node[1] : node[0]])
            node = out[node][0][1]
        return list(chain.from_iterable(m.tokens(p) for p in reversed(pieces)))

    src = {first: {0: (0.0, None)}}
    sync = _syncs(s, b, e - m.longest)
    if not sync:
        return back(m.walk(s, b, e, src), final, first)
    head = m.walk(s, b, sync[0], src) | ({first: src[first]} if first[0] == sync[0] else {})
    at = max((n for n in head if n[0] == sync[0]), key=lambda n: head[n][0][0])
    fresh = (sync[1], sync[1])
    tail = m.walk(s, sync[1], e, {fresh: {0: (0.0, None)}})
    return back(head, at, first) + words(s[sync[0] + 1 : sync[1]].replace(MARK, " ")) * (sync[0] < sync[1]) + back(tail, final, fresh)


class Encoder:
    """The library's model and its lattice."""

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        special = [i for i in range(sp.get_piece_size()) if sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)]
        skip = set(special)
        ids = {sp.id_to_piece(i): i for i in range(sp.get_piece_size()) if i not in skip}
        if any(MARK in p.lstrip(MARK) or "\n" in p for p in ids):
            raise ValueError("a piece crosses a word start: this vocabulary has no places to cut at")
        byte = [sp.piece_to_id(f"<0x{x:02X}>") for x in range(256)]
        # A line feed is in no piece, so what follows it is encoded as if on its own, without a word start.
        plain = lambda u: sp.encode("\n" + u.replace(MARK, " "))[2:]
        self.pieces = Pieces(ids, plain, unknown=lambda c: [byte[x] for x in c.encode()])

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(x, np.int32) for x in self.sp.encode(texts, num_threads=1)] if texts else []

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.sp.decode(ids, num_threads=1) if ids else []


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def marked(text: str) -> str:
    """The text as the model sees it."""
    return MARK + text.replace(" ", MARK)


def _lists(values: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum([len(v) for v in values], dtype=np.int64)]).astype(np.int32)
    flat = np.concatenate(values) if values else np.empty(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32()))


def _whole(docs: DataFrame, model: str) -> DataFrame:
    """``docs`` with ``ids`` and ``round_trip``, text by text."""
    schema = T.StructType([*docs.schema.fields, T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("round_trip", T.BooleanType())])
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for batch in batches:
            for part in slices(batch, at, SLICE_BYTES):
                texts = [t or "" for t in part.column(at).to_pylist()]
                ids = enc.encode(texts)
                back = enc.decode([x.tolist() for x in ids])
                same = pa.array([x == y for x, y in zip(texts, back, strict=True)])
                yield pa.RecordBatch.from_arrays([*part.columns, _lists(ids), same], names=schema.names)

    return docs.mapInArrow(run, schema)


def _chunks(rows: DataFrame, model: str, chunk: int) -> DataFrame:
    """``uid`` (a number for each row of ``rows``), ``k`` and ``s`` with ``b`` characters of context, per chunk.

    The first chunk also has ``doc_id``, ``n_chars`` and a ``digest`` of the text.
    """
    overlap = 2 * encoder(model).pieces.longest
    s = F.concat(F.lit(MARK), F.replace(F.col("text"), F.lit(" "), F.lit(MARK)))
    each = rows.select("doc_id", F.length("text").cast("long").alias("n_chars"), F.sha2("text", 256).alias("digest"), s.alias("s"), F.monotonically_increasing_id().alias("uid"))
    each = each.withColumn("n", F.ceil(F.length("s") / chunk).cast("int"))
    cut = each.select("*", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("k"))
    left = F.least(F.lit(overlap), F.col("k") * chunk)
    once = [F.when(F.col("k") == 0, F.col(c)).alias(c) for c in ("doc_id", "n_chars", "digest")]
    cut = cut.select(
        "uid", "k", "n", (F.col("k") == F.col("n") - 1).alias("last"), left.cast("int").alias("b"),
        F.substring("s", F.col("k") * chunk - left + 1, F.lit(chunk) + left).alias("s"), *once,
    )
    return materialise(cut.repartition("uid", "k"), "chunks")


def _ends(matrices: DataFrame, levels: int, fan: int) -> DataFrame:
    """``uid, k, ends``: the nodes at both ends of every chunk, from ``uid, k, m``: up the tree, and down again."""

    def ordered(table: pa.Table) -> tuple[pa.Table, list]:
        t = table.sort_by("k")
        return t, [json.loads(x) for x in t.column("m").to_pylist()]

    def up(table: pa.Table) -> pa.Table:
        t, ms = ordered(table)
        return pa.table({"uid": t.column("uid")[:1], "k": pa.array([t.column("k")[0].as_py() // fan], pa.int32()), "m": [json.dumps(folded(ms))]})

    def down(table: pa.Table) -> pa.Table:
        t, ms = ordered(table)
        nodes = boundaries(ms, *json.loads(t.column("ends")[0].as_py()))
        pairs = [json.dumps(x) for x in zip(nodes, nodes[1:], strict=False)]
        return pa.table({"uid": t.column("uid"), "k": t.column("k"), "ends": pa.array(pairs)})

    block = (F.col("k") / fan).cast("int")
    tree = [matrices]
    for _ in range(levels):
        made = tree[-1].groupBy("uid", block.alias("block")).applyInArrow(up, "uid long, k int, m string")
        tree.append(materialise(made, "matrices"))
    ends = tree[-1].select("uid", "k", F.udf(lambda m: json.dumps([START, best_exit(json.loads(m))]))("m").alias("ends"))
    for below in reversed(tree[:-1]):
        known = ends.select(F.col("uid").alias("u_"), F.col("k").alias("k_"), "ends")
        parts = below.join(known, (F.col("uid") == F.col("u_")) & (block == F.col("k_"))).select("uid", "k", "m", "ends")
        ends = parts.groupBy("uid", block.alias("block")).applyInArrow(down, "uid long, k int, ends string")
    return ends


def _giant(rows: DataFrame, model: str, chunk: int, fan: int, max_broadcast: int) -> DataFrame:
    """``doc_id, n_chars, ids, round_trip`` of every row of ``rows``, chunk by chunk."""
    cut = _chunks(rows, model, chunk)
    most = cut.agg(F.max("n")).first()[0] or 1  # chunks of the longest text
    levels = next(h for h in range(1, 64) if fan**h >= most)

    def matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = encoder(model).pieces
        for batch in (part for whole in batches for part in slices(whole, 4, SLICE_BYTES)):
            uid, k, last, b, s = (batch.column(i) for i in range(5))
            made = [json.dumps(matrix(m, *x)) for x in zip(s.to_pylist(), b.to_pylist(), last.to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([uid, k, pa.array(made, pa.string())], names=["uid", "k", "m"])

    def traces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        words = lambda text: enc.encode([text])[0].tolist()
        for batch in (part for whole in batches for part in slices(whole, 3, SLICE_BYTES)):
            b, s, ends = (batch.column(i).to_pylist() for i in (2, 3, 4))
            ids = [np.array(trace(enc.pieces, x, y, *json.loads(z), words), np.int32) for x, y, z in zip(s, b, ends, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), _lists(ids)], names=["uid", "k", "ids"])

    small = materialise(cut.select("uid", "k", "last", "b", "s").mapInArrow(matrices, "uid long, k int, m string"), "matrices")
    ends = materialise(_ends(small, levels, fan), "ends").withColumnsRenamed({"uid": "u_", "k": "k_"})
    parts = cut.join(broadcast_within(ends, max_broadcast), (F.col("uid") == F.col("u_")) & (F.col("k") == F.col("k_")))
    parts = parts.select("uid", "k", "b", "s", "ends").mapInArrow(traces, "uid long, k int, ids array<int>")
    ids = parts.groupBy("uid").agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"])).alias("ids"))
    first = cut.where("k = 0").select(F.col("uid").alias("u_"), "doc_id", "n_chars", "digest")
    back = decode(ids.join(first, F.col("uid") == F.col("u_")).select("doc_id", "n_chars", "digest", "ids"), model)
    return back.select("doc_id", "n_chars", "ids", (F.sha2("decoded", 256) == F.col("digest")).alias("round_trip"))


def decode(df: DataFrame, model: str = MODEL, column: str = "ids") -> DataFrame:
    """``df`` with ``decoded``, the text of the ids in ``column``."""
    schema = T.StructType([*df.schema.fields, T.StructField("decoded", T.StringType())])
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for batch in batches:
            for i in range(0, batch.num_rows, 100):
                part = batch.slice(i, 100)
                back = enc.decode([x or [] for x in part.column(at).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(back, pa.string())], names=schema.names)

    return df.mapInArrow(run, schema)


def encode(docs: DataFrame, model: str = MODEL, giant: int = GIANT, chunk: int = CHUNK, fan: int = FAN, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, n_chars, n_tokens, ids, round_trip`` for every row of ``docs``."""
    rows = docs.select("doc_id", "text")
    n = F.coalesce(F.length("text"), F.lit(0)).cast("long")
    short = _whole(rows.where(n <= giant), model).select("doc_id", n.alias("n_chars"), "ids", "round_trip")
    out = short.unionByName(_giant(rows.where(n > giant), model, chunk, fan, max_broadcast))
    return out.select("doc_id", "n_chars", F.size("ids").cast("long").alias("n_tokens"), "ids", "round_trip")


def query(spark, sf_dir: str) -> DataFrame:
    """op1 over ``documents``."""
    return encode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
