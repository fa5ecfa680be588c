"""Features of a GeoJSON collection, read by many tasks.

A document is one JSON value, which Spark's JSON reader gives to one task.  Here Spark's text reader cuts it after every ``}``,
in splits of bytes.  Where a split begins in the document (within a text or not, how deep in brackets) depends on
all bytes before it; but what a split changes about that can be told without knowing it, once for a beginning outside a text and
once for one within.  These summaries, a row a split, put together from first to last give each split's beginning.
Then each split finds the features that begin in it; what a split cuts off a feature is joined to it by key, the only rows that move.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.messages import to_s3a

#: The place of a feature that its split does not end: behind all others.
CUT = 1 << 60
_OPEN, _SHUT = "[{", "]}"


def _outside(fragment: str, text: bool) -> tuple[list[str], bool]:
    """The parts of a fragment that lie outside texts, and whether its end lies within one."""
    if "\\" in fragment:
        pieces = fragment.split("\\\\")
        fragment = "".join(p.replace('\\"', "") for p in pieces)
    parts = fragment.split('"')
    return parts[1::2] if text else parts[0::2], text ^ (len(parts) % 2 == 0)


def _change(parts: list[str]) -> tuple[int, int]:
    """By how much parts outside texts change the depth, and the least that it is on the way."""
    depth = least = 0
    for p in parts:
        shut = p.count("]") + p.count("}")
        if shut:
            for c in p:
                depth += (c in _OPEN) - (c in _SHUT)
                least = min(least, depth)
        else:
            depth += p.count("[") + p.count("{")
    return depth, least


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per split and beginning: by how much the depth changes, the least it is, the end's state, bytes, and the least before its last bracket."""
    state: dict[int, list] = {}
    for batch in batches:
        for block, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ways = state.setdefault(block, [[0, 0, False, 0, 0], [0, 0, True, 0, 0]])
            for way in ways:
                parts, way[2] = _outside(value, way[2])
                depth, least = _change(parts)
                way[4] = way[1] = min(way[1], way[0] + least)
                way[0] += depth - (not way[2])  # the bracket after the fragment
                way[1] = min(way[1], way[0])
                way[3] += len(value.encode()) + 1
    rows = [(block, begun, *way) for block, ways in state.items() for begun, way in enumerate(ways)]
    yield pa.RecordBatch.from_pydict({n: [r[k] for r in rows] for k, n in enumerate(_SUMMARY.names)}, schema=_SUMMARY)


_SUMMARY = pa.schema([("block", pa.int64()), ("begun", pa.int32()), ("depth", pa.int64()), ("least", pa.int64()), ("text", pa.bool_()), ("bytes", pa.int64()), ("real", pa.int64())])
_FEATURE = pa.schema([("block", pa.int64()), ("nth", pa.int64()), ("piece", pa.int64()), ("feature", pa.string())])


def _begins(rows: list, size: int, path: str) -> dict[int, tuple[int, bool, int]]:
    """Of each split: depth, whether it begins within a text, and the split with the feature that it begins within."""
    ways = {(r["block"], r["begun"]): r for r in rows}
    blocks = sorted({b for b, _ in ways})
    # The reader does not tell whether a bracket follows the last fragment; the file's size does.
    ended = sum(ways[b, 0]["bytes"] for b in blocks) == size
    depth, text, home, out = 0, False, 0, {}
    for block in blocks:
        way, real = ways[block, int(text)], ended or block != blocks[-1]
        out[block] = depth, text, home
        # A split that lies within one feature hands on where that begins.
        if not (depth >= 3 and depth + way["least"] >= 3):
            home = block
        if depth + way["least" if real else "real"] < 0:
            raise ValueError(f"{path} is no JSON document: a bracket too many")
        depth, text = depth + way["depth"] + (not real and not way["text"]), way["text"]
    if not out or depth or text:
        raise ValueError(f"{path} is no JSON document: it ends within {'a text' if text else 'brackets'}")
    return out


def _start(value: str, depth: int, text: bool) -> int | None:
    """Where in a fragment a feature begins: a ``{`` two brackets deep that is an item of an array."""
    if depth > 2 or text and depth >= 2:
        return None
    if depth == 2:
        bare = value.lstrip(", \t\r\n")
        return len(value) - len(bare) if bare.startswith("{") else None
    before, at = "", 0
    while at < len(value):
        c = value[at]
        if text:
            at += c == "\\"
            text = c != '"'
        elif c == '"':
            text = True
        elif c == "{" and depth == 2 and before in "[,":
            return at
        elif c in _OPEN or c in _SHUT:
            depth += 1 if c in _OPEN else -1
        if not c.isspace():
            before = c
        at += 1
    return None


def features(spark: SparkSession, path: str) -> DataFrame:
    """``ordinal`` (in the order of the document) and ``feature``, the JSON text of each feature.

    A document that is cut off or whose brackets do not match is an error.
    """
    path = to_s3a(path)
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    size = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(place).getLen()
    raw = spark.read.option("lineSep", "}").text(path).select(F.col("_metadata.file_block_start").alias("block"), "value")
    ddl = "block long, begun int, depth long, least long, text boolean, bytes long, real long"
    begins = _begins(raw.mapInArrow(_summaries, ddl).collect(), size, path)  # two rows a split

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: dict[int, list] = {}  # of each split: depth, text, key of the feature that is being read, its pieces, features so far
        for batch in batches:
            done = []
            for block, value in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if block not in at:
                    depth, text, home = begins[block]
                    at[block] = [depth, text, (home, CUT) if depth >= 3 else None, [], 0]
                s = at[block]
                start = _start(value, s[0], s[1]) if s[2] is None else None
                if start is not None:
                    s[2], s[3] = (block, s[4]), []
                if s[2] is not None:
                    s[3].append((value[start or 0 :]) + "}")
                parts, s[1] = _outside(value, s[1])
                s[0] += _change(parts)[0] - (not s[1])
                if s[2] is not None and s[0] <= 2 and not s[1]:
                    done.append((*s[2], block, "".join(s[3])))
                    s[4] += s[2][1] != CUT
                    s[2] = None
            yield _rows(done)
        yield _rows([(s[2][0], CUT, block, "".join(s[3])) for block, s in at.items() if s[2] is not None])

    rows = raw.mapInArrow(found, "block long, nth long, piece long, feature string")
    cut = rows.where(F.col("nth") == CUT).groupBy("block", "nth").agg(F.sort_array(F.collect_list(F.struct("piece", "feature"))).alias("p"))
    cut = cut.select("block", "nth", F.array_join(F.col("p.feature"), "").alias("feature"))
    whole = rows.where(F.col("nth") < CUT).select("block", "nth", "feature").unionByName(cut)
    return whole.select(F.struct("block", "nth").alias("ordinal"), "feature")


def _rows(done: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({n: [r[k] for r in done] for k, n in enumerate(_FEATURE.names)}, schema=_FEATURE)
