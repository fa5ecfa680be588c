"""Token counts of sections, from one encoding of the whole document.

A document is encoded once.  Every token has a span of bytes in the text, and so
has every section; an interval join attributes the tokens.  A token that crosses a
boundary goes to one section by an explicit rule:

* ``first``: the section of its first byte (the default),
* ``last``: the section of its last byte,
* ``most``: the section with most of its bytes, the earlier one if tied.

So the counts of a document's sections add up to its tokens under every rule.
Sections are the lines of the text, each with its line feed, unless ``spans``
names a column ``array<struct<start int, end int>>`` of character spans, in order
and not overlapping.  Tokens outside all spans are counted nowhere.

Defined results: null and empty texts have no sections; an empty table gives no rows.
Rows are counted one by one, null and repeated ids and repeated rows included.  Batches
are cut by bytes; a very long text is encoded whole, alone in its batch, and needs some
50 bytes a token.  Only ``doc_id``, ``text`` and the span column are read by name;
other columns may have any.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.batches import slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
RULES = ("first", "last", "most")
#: Rows a batch of output has at most before it is sent on.
BATCH = 50_000


@lru_cache(maxsize=2)
def _encoding(path: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    size = np.zeros(max(ranks.values()) + 1, np.int64)
    for token, rank in ranks.items():
        size[rank] = len(token)
    return tiktoken.Encoding("counts", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}), size


def token_ends(text: str, path: str = VOCABULARY) -> np.ndarray:
    """The byte offset at which each token of ``text`` ends."""
    enc, size = _encoding(path)
    return np.cumsum(size[np.array(enc.encode_ordinary(text), np.int64)])


def attribute(ends: np.ndarray, starts: np.ndarray, stops: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and how many of them cross into or out of it.

    Sections are ``[starts, stops)`` in bytes, sorted and disjoint.
    """
    if not len(ends) or not len(starts):
        return np.zeros(len(starts), np.int64), np.zeros(len(starts), np.int64)
    begins = np.append(0, ends[:-1])

    def holding(at: np.ndarray) -> np.ndarray:
        i = np.searchsorted(starts, at, "right") - 1
        return np.where((i >= 0) & (at < stops[np.maximum(i, 0)]), i, -1)

    first, last = holding(begins), holding(ends - 1)
    home = {"first": first, "last": last, "most": first}[rule].copy()
    if rule == "most":
        for t in np.flatnonzero(first != last):
            lo, hi = np.searchsorted(stops, begins[t], "right"), np.searchsorted(starts, ends[t], "left")
            share = np.minimum(stops[lo:hi], ends[t]) - np.maximum(starts[lo:hi], begins[t])
            home[t] = lo + share.argmax() if len(share) else -1
    inside = np.maximum(home, 0)
    crossing = (home >= 0) & ((begins < starts[inside]) | (ends > stops[inside]))
    count = lambda x: np.bincount(home[x], minlength=len(starts))
    return count(home >= 0), count(crossing)


def _lines(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    cut = np.flatnonzero(np.frombuffer(data, np.uint8) == 10) + 1
    bounds = np.unique(np.concatenate([[0], cut, [len(data)]]))
    return bounds[:-1], bounds[1:]


def _chars(data: bytes) -> np.ndarray:
    """The byte offset of every character, and the end."""
    return np.append(np.flatnonzero(np.frombuffer(data, np.uint8) & 0xC0 != 0x80), len(data))


def section_counts(docs: DataFrame, spans: str | None = None, rule: str = "first", path: str = VOCABULARY) -> DataFrame:
    """``doc_id, section`` (from 0), ``start, end`` (characters), ``n_tokens, n_crossing, doc_tokens``."""
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    names = ["section", "start", "end", "n_tokens", "n_crossing", "doc_tokens"]
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), *[T.StructField(n, T.LongType()) for n in names]])

    def flush(source: pa.Array, rows: list[int], parts: list[list[np.ndarray]]) -> pa.RecordBatch:
        columns = [pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in parts]
        return pa.RecordBatch.from_arrays([source.take(pa.array(rows, pa.int64())), *columns], names=schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for whole in batches for part in slices(whole, 1)):
            given = batch.column(2).to_pylist() if spans else None
            rows, parts = [], [[] for _ in names]
            for i, value in enumerate(batch.column(1)):
                text = value.as_py()
                if not text:
                    continue
                data = text.encode()
                at = None if text.isascii() else _chars(data)
                if given is None:
                    starts, stops = _lines(data)
                else:
                    se = np.array([(x["start"], x["end"]) for x in given[i] or []], np.int64).reshape(-1, 2)
                    starts, stops = (se[:, k] if at is None else at[np.clip(se[:, k], 0, len(text))] for k in (0, 1))
                ends = token_ends(text, path)
                n, crossing = attribute(ends, starts, stops, rule)
                char = (lambda x: x) if at is None else (lambda x, at=at: np.searchsorted(at, x))
                whole = np.full(len(n), len(ends))
                for out, x in zip(parts, (np.arange(len(n)), char(starts), char(stops), n, crossing, whole), strict=True):
                    out.append(x)
                rows += [i] * len(n)
                if len(rows) >= BATCH:
                    yield flush(batch.column(0), rows, parts)
                    rows, parts = [], [[] for _ in names]
            yield flush(batch.column(0), rows, parts)

    return docs.select("doc_id", "text", *([spans] if spans else [])).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    """op3 over ``documents``: tokens of every line."""
    return section_counts(spark.read.parquet(f"{sf_dir}/documents.parquet"))
