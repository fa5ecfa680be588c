"""Periodic runs of words, found by probing harmonic grids.

A run is a stretch of consecutive words that repeats with a smallest period ``q`` (words
``q`` apart are equal), is at least ``max(6, 4 * q)`` words long, and that no word next to
it extends.  For each period ``p`` only words at the grid points ``0, p, 2p, ...`` are
compared, ``n / p`` of them, so all periods together take ``n log n`` probes.  A run of
period ``p`` holds four grid points in a row, hence three equal pairs ``jp, (j+1)p`` in a
row, and all words between them agree one period on: grid points that pass at a few places
in between, too, are extended to both sides by comparing chunks of growing length.
Periods are tried in ascending order; grid points inside a run already found whose period
divides ``p`` would only find it again and are skipped.  What is left is new, and its
period the smallest: a shorter one would divide it and have been found.

Words are runs of characters other than space and ``\\t \\n \\v \\f \\r``.  They become numbers,
so a text takes its bytes, some bytes a word, and each different word once.  The texts of a
batch of ``SLICE_BYTES`` are probed together.

Defined results: a null, empty or blank text has no words and no runs.  Rows are handled
one by one: repeated rows and ids keep a row each; a null id is hashed as the empty
text.  Of runs of equal length the first is reported, then the one of smaller period.
Runs of different periods may overlap; a word goes if any run repeats it.  Very long texts
are handled alone in their batch.  An empty table gives no rows.  Only ``doc_id`` and
``text`` are read by name; other columns may have any.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.batches import slices

#: A run has at least this many words, and this many periods.
SHORTEST, PERIODS = 6, 4
#: Bytes of a text whose words are cut at a time.
PIECE = 1 << 20
_BLANK = re.compile(rb"[\x20\x09-\x0D]")


class Run(NamedTuple):
    start: int
    length: int
    period: int


def numbered(data: bytes, known: dict[bytes, int]) -> np.ndarray:
    """The words of a text as numbers; ``known`` holds each word's number and takes new ones."""
    parts, at = [], 0
    while at < len(data):
        cut = _BLANK.search(data, min(at + PIECE, len(data)))
        end = cut.start() if cut else len(data)
        words = data[at:end].split()
        parts.append(np.fromiter((known.setdefault(w, len(known)) for w in words), np.int32, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.int32)


def _agreeing(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading items of two arrays of one length agree."""
    at, chunk = 0, 16
    while at < len(a):
        differ = a[at : at + chunk] != b[at : at + chunk]
        first = int(differ.argmax())
        if differ[first]:
            return at + first
        at, chunk = at + chunk, chunk * 2
    return len(a)


def runs(w: np.ndarray, longest_text: int | None = None) -> list[Run]:
    """All runs of ``w``, by start and period; of at most ``longest_text`` words each, if that is known."""
    n, found = len(w), []
    by_period: dict[int, list[tuple[int, int]]] = {}  # period to (start, end), by start
    widest: dict[int, int] = {}
    for p in range(1, (n if longest_text is None else longest_text) // PERIODS + 1):
        grid = w[::p]
        same = grid[1:] == grid[:-1]
        hits = np.flatnonzero(same[:-2] & same[1:-1] & same[2:]) * p
        if not len(hits):
            continue
        for inside in {p // 2, p // 3, p + p // 2, 2 * p - 1} - {0}:
            hits = hits[w[hits + inside] == w[hits + inside + p]]
        inner = [by_period[q] for q in by_period if p % q == 0 and widest[q] > p]
        new: list[tuple[int, int]] = []
        k = 0
        while k < len(hits):
            i = int(hits[k])
            end = max((_end_of(spans, i, i + p) for spans in inner), default=0)
            if not end:
                right = i + p + _agreeing(w[i : n - p], w[i + p :])
                start = i - _agreeing(w[:i][::-1], w[p : i + p][::-1])
                end = right
                if right - start >= max(SHORTEST, PERIODS * p):
                    new.append((start, right))
            # A grid point is in the same stretch as long as its next one is.
            k = max(k + 1, int(np.searchsorted(hits, end - p)))
        if new:
            by_period[p] = new
            widest[p] = max(e - s for s, e in new)
            found += [Run(s, e - s, p) for s, e in new]
    return sorted(found, key=lambda r: (r.start, r.period))


def _end_of(spans: list[tuple[int, int]], first: int, last: int) -> int:
    """The end of the span that holds the places ``first`` and ``last``, or 0."""
    k = bisect_left(spans, (first + 1,)) - 1
    return spans[k][1] if k >= 0 and last < spans[k][1] else 0


def runs_of(texts: list[np.ndarray]) -> list[list[Run]]:
    """The runs of each text.

    The texts lie behind one another with a number of its own after each, so that no run
    crosses it, and share one grid per period: its points need not start at a text's first word.
    """
    ends = np.cumsum([len(w) + 1 for w in texts])
    whole = np.concatenate([x for k, w in enumerate(texts) for x in (w, np.array([-1 - k], np.int32))])
    out: list[list[Run]] = [[] for _ in texts]
    for r in runs(whole, max(map(len, texts))):
        k = int(np.searchsorted(ends, r.start, "right"))
        out[k].append(r._replace(start=r.start - (int(ends[k]) - len(texts[k]) - 1)))
    return out


def repeated(n: int, found: list[Run]) -> np.ndarray:
    """Whether each of ``n`` words is in some run after its first period."""
    edge = np.zeros(n + 1, np.int32)
    for r in found:
        edge[r.start + r.period] += 1
        edge[r.start + r.length] -= 1
    return np.cumsum(edge[:-1]) > 0


def planted(w: np.ndarray, doc_id: int | str | None) -> np.ndarray:
    """The words with which the query works: a tenth of the documents repeat from some place on."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(w)
    if h % 10 or not n:
        return w
    g = h // 10
    a = g % n
    period = 1 + (n - a) // (3 + g % 8)
    return np.concatenate([w[:a], w[a + np.arange(n - a) % period]])


def _joined(w: np.ndarray, words: list[bytes]) -> Iterator[bytes]:
    """The words joined by single spaces, in pieces."""
    for at in range(0, len(w), PIECE):
        yield (b" " if at else b"") + b" ".join([words[k] for k in w[at : at + PIECE].tolist()])


def _mapped(docs: DataFrame, schema: T.StructType, kinds: list[pa.DataType], rewrite, made) -> DataFrame:
    """``made(words, runs, texts of the words)`` of every row, as the columns after ``doc_id``.

    ``rewrite(words, doc_id)``, if any, changes the numbered words first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            known: dict[bytes, int] = {}
            texts = [numbered((t.as_py() or "").encode(), known) for t in batch.column(1)]
            if rewrite:
                texts = [rewrite(w, k.as_py()) for w, k in zip(texts, batch.column(0), strict=True)]
            words = list(known)
            rows = [made(w, found, words) for w, found in zip(texts, runs_of(texts), strict=True)]
            arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _collapsed(w: np.ndarray, found: list[Run], words: list[bytes]) -> Iterator[bytes]:
    """The text without what its runs repeat, words joined by single spaces, in pieces."""
    return _joined(w[~repeated(len(w), found)] if found else w, words)


def run_table(docs: DataFrame, rewrite=None) -> DataFrame:
    """``doc_id, n_words``, ``runs array<struct<start, length, period>>`` and the ``collapsed`` text per document."""
    fields = [T.StructField(n, T.LongType()) for n in Run._fields]
    schema = T.StructType([
        docs.schema["doc_id"], T.StructField("n_words", T.LongType()),
        T.StructField("runs", T.ArrayType(T.StructType(fields))), T.StructField("collapsed", T.StringType()),
    ])
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in Run._fields]))

    def made(w: np.ndarray, found: list[Run], words: list[bytes]):
        return len(w), [r._asdict() for r in found], b"".join(_collapsed(w, found, words)).decode()

    return _mapped(docs, schema, [pa.int64(), kind, pa.string()], rewrite, made)


def run_digests(docs: DataFrame, rewrite=None) -> DataFrame:
    """The longest run of each document, how many there are, and digests of all runs and of the collapsed text."""
    longs = ["n_runs", "start", "length", "period", "exponent_milli"]
    texts = ["runs_sha256", "collapsed_sha256"]
    schema = T.StructType(
        [docs.schema["doc_id"], *[T.StructField(n, T.LongType()) for n in longs], *[T.StructField(n, T.StringType()) for n in texts]]
    )

    def made(w: np.ndarray, found: list[Run], words: list[bytes]):
        best = min(found, key=lambda r: (-r.length, r.start, r.period), default=None)
        listed, kept = hashlib.sha256(), hashlib.sha256()
        for r in found:
            listed.update(b"%d,%d,%d\n" % r)
        for piece in _collapsed(w, found, words):
            kept.update(piece)
        top = (*best, 1000 * best.length // best.period) if best else (None,) * 4
        return len(found), *top, listed.hexdigest(), kept.hexdigest()

    return _mapped(docs, schema, [pa.int64()] * len(longs) + [pa.string()] * len(texts), rewrite, made)


def query(spark, sf_dir: str) -> DataFrame:
    """op11 over ``documents``, a tenth of which repeat from some word on (:func:`planted`)."""
    return run_digests(spark.read.parquet(f"{sf_dir}/documents.parquet"), planted)


#: A stretch of equal words p apart, cut where one differs, is periodic and maximal; of stretches that
#: begin and end alike, the one of smallest period is the run.  Only places of equal words meet.
SQL = rf"""
WITH t AS (SELECT list_reduce(list_prepend(x, range(0, 8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v, x
  FROM (SELECT unnest(range(0, 256)) AS x)
), crc AS (SELECT list(v ORDER BY x) AS tab FROM t
), d0 AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), d1 AS (SELECT d0.*, len(ws) AS n, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8))) AS h FROM d0, crc
), d2 AS (SELECT *, h // 10 AS g, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n ELSE n END AS a FROM d1
), d AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS q FROM d2
), w AS (SELECT rid, n, i, CASE WHEN i >= a THEN ws[a + (i - a) % q + 1] ELSE ws[i + 1] END AS word FROM d, unnest(range(0, n)) AS u(i)
), eq AS (SELECT x.rid, x.i, y.i - x.i AS p FROM w x JOIN w y ON x.rid = y.rid AND x.word = y.word AND y.i > x.i AND {PERIODS} * (y.i - x.i) <= x.n
), st AS (SELECT rid, p, min(i) AS s, max(i) + p + 1 AS e FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, p ORDER BY i) AS island FROM eq) GROUP BY rid, p, island
), r AS (SELECT rid, s, e, min(p) AS p FROM st WHERE e - s >= greatest({SHORTEST}, {PERIODS} * p) GROUP BY rid, s, e
), gone AS (SELECT DISTINCT rid, unnest(range(s + p, e)) AS i FROM r
), kept AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS t FROM w ANTI JOIN gone USING (rid, i) GROUP BY rid
), per AS (SELECT rid, count(*) AS n_runs, arg_min(struct_pack(s := s, l := e - s, p := p), struct_pack(l := s - e, s := s, p := p)) AS b,
    string_agg(s || ',' || (e - s) || ',' || p || chr(10), '' ORDER BY s, p) AS t FROM r GROUP BY rid)
SELECT d.doc_id, coalesce(per.n_runs, 0) AS n_runs, per.b.s AS "start", per.b.l AS length, per.b.p AS period, 1000 * per.b.l // per.b.p AS exponent_milli,
  sha256(coalesce(per.t, '')) AS runs_sha256, sha256(coalesce(kept.t, '')) AS collapsed_sha256
FROM d LEFT JOIN per USING (rid) LEFT JOIN kept USING (rid)
"""
