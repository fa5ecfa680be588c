"""A prefix trie of conversations, summed up along heavy paths.

A conversation is a sequence of turns; each distinct sequence of its first ``d`` turns is a
node of depth ``d``, below the textless root.  Node names are not compared as texts: a turn
is digested with its place (SHA-256 of role and text, then two 64-bit hashes of place and
digest), and a prefix is the exclusive or of its turns' hashes, 128 bits, which a running
aggregate gives (``scans.running``).  Two different prefixes of one depth are confused with
probability 2**-128 a pair.

Sums over subtrees use the heavy-path decomposition: of a node's children the one with most
members (then with the least member) is heavy and continues its path, the others begin paths of
their own.  Passing a light edge at least halves the members, so a path lies below at most log2(members)
others.  Each path's own values are summed once; then, from the lowest paths up, a path's
total is added to the node it hangs from, one round for each level; and a suffix sum along
each path's array gives every node its subtree.  Paths are found by a running aggregate along the
conversations: the last light node above a turn is its path's top.

Hot keys: conversations and paths are cut into buckets of ``BUCKET`` places; counts are partial
aggregates; the joins on a node that many conversations share have one row for it on the other
side and can be split.  The ids that end at one node are hashed as a stream, in order, without being gathered.

Defined results: turns are ordered by number, null first; turns of one number by the digest of role
and text, so repeated rows are turns, too.  Null roles and texts are empty.  Rows without a ``conv_id`` belong to
no conversation and are left out.  An empty table has no root.  A text of any length is one digest.
Other columns may have any names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scans import Fold, running
from tidemark.session import counted, materialise

#: Places of a conversation or of a path that one task handles at a time.
BUCKET = 4096
#: Turns that a conversation takes over from the first of its five, at most.
SHARED = 8
_EMPTY = hashlib.sha256().hexdigest()


def ordered(turns: DataFrame) -> DataFrame:
    """``conv_id, place`` (from 0), ``digest, n_bytes`` (of the text) of every turn."""
    role, text = (F.coalesce(turns[c], F.lit("")) for c in ("role", "text"))
    digest = F.unhex(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256))
    rows = turns.where(turns["conv_id"].isNotNull()).select(
        turns["conv_id"].cast("long").alias("conv_id"), turns["turn"].cast("long").alias("turn"), digest.alias("digest"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    bucket = F.coalesce(F.expr(f"turn div {BUCKET}"), F.lit(-(1 << 62)))
    order = [F.col("turn").asc_nulls_first(), F.col("digest")]
    out = running(rows, ["conv_id"], bucket, order, {"place": Fold(F.sum, F.lit(1))})
    return out.select("conv_id", (F.col("place") - 1).alias("place"), "digest", "n_bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The query's conversations from :func:`ordered` ones, and their ids: a conversation may be left without turns.

    Conversation ``c`` begins with the first ``h`` turns of ``c - c % 5`` (the sign of ``c``) and goes on with its own after its first ``h``.
    """
    own = turns.groupBy("conv_id").agg(F.count("*").alias("n"))
    h = F.crc32(F.col("conv_id").cast("string")) % (SHARED + 1)
    base = F.col("conv_id") - F.col("conv_id") % 5
    sizes = own.select(F.col("conv_id").alias("b_id"), F.col("n").alias("b_n"))
    convs = own.select("conv_id", h.alias("h"), base.alias("base")).join(sizes, F.col("base") == F.col("b_id"), "left")
    convs = convs.select("conv_id", "base", "h", F.least("h", F.coalesce("b_n", F.lit(0))).alias("taken"))
    first = turns.where((F.col("conv_id") % 5 == 0) & (F.col("place") < SHARED)).withColumnRenamed("conv_id", "base")
    heads = convs.where("taken > 0").select("conv_id", "base", "taken").join(first, "base").where("place < taken")
    less = convs.where("taken < h").select("conv_id", (F.col("h") - F.col("taken")).alias("less"))
    tails = turns.where(F.col("place") >= h).join(less, "conv_id", "left")
    tails = tails.withColumn("place", F.col("place") - F.coalesce("less", F.lit(0)))
    names = ["conv_id", "place", "digest", "n_bytes"]
    return heads.select(*names).unionByName(tails.select(*names)), own.select("conv_id")


def _places(turns: DataFrame) -> DataFrame:
    """``conv_id, depth``, the node ``k1, k2``, its parent ``p1, p2`` and ``n_bytes`` of every turn."""
    depth = F.col("place") + 1
    rows = turns.select("conv_id", depth.alias("depth"), *[F.xxhash64(F.lit(i), depth, F.col("digest")).alias(f"e{i}") for i in (1, 2)], "n_bytes")
    rows = running(rows, ["conv_id"], F.expr(f"(depth - 1) div {BUCKET}"), [F.col("depth")], {f"k{i}": Fold(F.bit_xor, F.col(f"e{i}")) for i in (1, 2)})
    parents = [F.col(f"k{i}").bitwiseXOR(F.col(f"e{i}")).alias(f"p{i}") for i in (1, 2)]
    return rows.select("conv_id", "depth", "k1", "k2", *parents, "n_bytes")


def _nodes(places: DataFrame, ids: DataFrame) -> DataFrame:
    """A row per node: ``conv_id, depth, k1, k2, p1, p2, n_bytes, n_convs, parent_conv_id, n_children, light``."""
    inner = places.groupBy("k1", "k2").agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), *[F.any_value(c).alias(c) for c in ("depth", "p1", "p2", "n_bytes")]
    )
    zero = F.lit(0).cast("long")
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs")).where("n_convs > 0")
    none = F.lit(None).cast("long")
    root = root.select(zero.alias("k1"), zero.alias("k2"), "conv_id", "n_convs", zero.alias("depth"), none.alias("p1"), none.alias("p2"), zero.alias("n_bytes"))
    nodes = inner.select(root.columns).unionByName(root)
    best = F.max(F.struct("n_convs", (-F.col("conv_id")).alias("m"), "k1", "k2"))
    above = nodes.where("depth > 0").groupBy("p1", "p2").agg(F.count("*").alias("c_n"), best.alias("c_best"))
    above = above.select(F.col("p1").alias("a1"), F.col("p2").alias("a2"), "c_n", "c_best.k1", "c_best.k2").withColumnsRenamed({"k1": "c1", "k2": "c2"})
    nodes = nodes.join(above, F.expr("k1 = a1 AND k2 = a2"), "left").drop("a1", "a2")
    parents = nodes.where("c_n > 0").select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"), F.col("c1").alias("s1"), F.col("c2").alias("s2"))
    nodes = nodes.withColumn("n_children", F.coalesce("c_n", F.lit(0))).drop("c_n", "c1", "c2")
    nodes = nodes.join(parents, F.expr("p1 = q1 AND p2 = q2"), "left")
    return nodes.withColumn("light", F.expr("s1 IS NULL OR k1 <> s1 OR k2 <> s2")).drop("q1", "q2", "s1", "s2")


def _with_paths(places: DataFrame, nodes: DataFrame) -> DataFrame:
    """Nodes with their path's top ``t1, t2`` and ``level``: how many light edges lie above."""
    info = nodes.where("depth > 0").drop("depth", "p1", "p2", "n_bytes").withColumnsRenamed({"conv_id": "first", "k1": "i1", "k2": "i2"})
    rows = places.join(info, F.expr("k1 = i1 AND k2 = i2")).drop("i1", "i2")
    tops = {"top": Fold(F.max, F.when(F.col("light"), F.struct("depth", "k1", "k2"))), "lights": Fold(F.sum, F.col("light").cast("int"))}
    rows = running(rows, ["conv_id"], F.expr(f"(depth - 1) div {BUCKET}"), [F.col("depth")], tops).where("conv_id = first")
    zero = F.lit(0).cast("long")
    names = ["conv_id", "depth", "k1", "k2", "p1", "p2", "n_bytes", "n_convs", "parent_conv_id", "n_children"]
    rows = rows.select(*names, F.coalesce("top.k1", zero).alias("t1"), F.coalesce("top.k2", zero).alias("t2"), F.col("lights").alias("level"))
    root = nodes.where("depth = 0").select(*names, zero.alias("t1"), zero.alias("t2"), zero.alias("level"))
    return rows.unionByName(root).withColumns({"leaves": F.expr("if(n_children = 0, 1L, 0L)"), "saved": F.expr("(n_convs - 1) * n_bytes")})


SUMS = ("leaves", "saved")


def _hanging(nodes: DataFrame, deepest: int) -> DataFrame:
    """What hangs from each node by light edges: ``g1, g2`` and sums.  One round for each level of paths."""
    sums = [F.sum(c).alias(c) for c in SUMS]
    top = F.min(F.struct("depth", "p1", "p2", "level")).alias("top")
    paths = nodes.where("level > 0").groupBy("t1", "t2").agg(top, *sums).select("t1", "t2", "top.p1", "top.p2", "top.level", *SUMS)
    holders = nodes.where("n_children > 1").select(F.col("k1").alias("g1"), F.col("k2").alias("g2"), F.col("t1").alias("u1"), F.col("t2").alias("u2"))
    paths = materialise(paths.join(holders, F.expr("p1 = g1 AND p2 = g2")).drop("g1", "g2"), "paths")  # u: the path that it hangs from
    out, below = None, None
    for level in range(deepest, 0, -1):
        at = paths.where(F.col("level") == level)
        if below is not None:
            gain = below.groupBy("u1", "u2").agg(*[F.sum(c).alias(f"g_{c}") for c in SUMS]).withColumnsRenamed({"u1": "b1", "u2": "b2"})
            at = at.join(gain, F.expr("t1 = b1 AND t2 = b2"), "left").withColumns({c: F.expr(f"{c} + coalesce(g_{c}, 0)") for c in SUMS}).select(paths.columns)
            at = materialise(at, "paths")
        below, out = at, at if out is None else out.unionByName(at)
    if out is None:
        out = paths
    return out.groupBy(F.col("p1").alias("g1"), F.col("p2").alias("g2")).agg(*[F.sum(c).alias(f"g_{c}") for c in SUMS])


def _ends(places: DataFrame, ids: DataFrame) -> DataFrame:
    """``e1, e2, ends_sha256``: the conversations that end at a node, for nodes with any."""
    last = places.groupBy("conv_id").agg(F.max_by(F.struct("k1", "k2"), "depth").alias("k"))
    last = ids.join(last, "conv_id", "left").select(*[F.coalesce(f"k.k{i}", F.lit(0).cast("long")).alias(f"e{i}") for i in (1, 2)], "conv_id")

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest = None, hashlib.sha256()
        for batch in batches:
            a, b, c = (np.asarray(x) for x in batch.columns)
            cuts = np.flatnonzero((a[1:] != a[:-1]) | (b[1:] != b[:-1])) + 1
            done = []
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(a)], strict=True):
                if i == j:
                    continue
                listed = b",".join(b"%d" % x for x in c[i:j].tolist())
                if key == (a[i], b[i]):
                    digest.update(b"," + listed)
                    continue
                if key is not None:
                    done.append((*key, digest.hexdigest()))
                key, digest = (int(a[i]), int(b[i])), hashlib.sha256(listed)
            yield _batch(done)
        if key is not None:
            yield _batch([(*key, digest.hexdigest())])

    def _batch(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [(), (), ()]
        return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, (pa.int64(), pa.int64(), pa.string()), strict=True)], names=["e1", "e2", "ends_sha256"])

    dealt = last.repartition("e1", "e2").sortWithinPartitions("e1", "e2", "conv_id")
    return dealt.mapInArrow(stream, "e1 long, e2 long, ends_sha256 string")


def trie(turns: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """A row per node of the trie of :func:`ordered` turns; ``ids`` names all conversations, if some may have no turns.

    ``conv_id`` (least member), ``depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``,
    and the node's name ``node`` (its hash in hexadecimal digits, 32 of them).
    """
    places = materialise(_places(turns), "places")
    ids = places.select("conv_id").distinct() if ids is None else ids
    nodes, deepest = counted(_with_paths(places, _nodes(places, ids)), "nodes", total="max(level)")
    nodes = nodes.join(_hanging(nodes, deepest), F.expr("k1 = g1 AND k2 = g2"), "left")
    nodes = nodes.withColumns({c: F.expr(f"{c} + coalesce(g_{c}, 0)") for c in SUMS})
    back = F.expr(f"-(depth div {BUCKET})")
    nodes = running(nodes, ["t1", "t2"], back, [F.col("depth").desc()], {f"n_{c}": Fold(F.sum, F.col(c)) for c in SUMS})
    nodes = nodes.join(_ends(places, ids), F.expr("k1 = e1 AND k2 = e2"), "left")
    node = F.lower(F.concat(*[F.lpad(F.hex(k), 16, "0") for k in ("k1", "k2")]))
    return nodes.select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("n_saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"), node.alias("node"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    """op13 over the rebuilt ``conversations``."""
    turns = materialise(ordered(spark.read.parquet(f"{sf_dir}/conversations.parquet")), "turns")
    again, ids = rebuilt(turns)
    return trie(again, ids).drop("node")


SQL = """
WITH t AS (SELECT list_reduce(list_prepend(x, range(0, 8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS v, x
  FROM (SELECT unnest(range(0, 256)) AS x)
), crc AS (SELECT list(v ORDER BY x) AS tab FROM t
), own AS (SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST,
    sha256(CAST(strlen(coalesce(role, '')) AS VARCHAR) || ':' || coalesce(role, '') || coalesce(text, ''))) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), c AS (SELECT own.*, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8))) % 9 AS h FROM own, crc
), re AS (SELECT c.conv_id, list_concat(coalesce(b.ts[1:c.h], []), c.ts[c.h + 1:]) AS ts FROM c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5
), pre AS (SELECT conv_id, d, len(ts) AS n, CASE WHEN d = 0 THEN '' ELSE sha256(CAST(ts[1:d] AS VARCHAR) || '|' || array_to_string(list_transform(ts[1:d], lambda x: strlen(x.r) || ',' || strlen(x.t)), ';')) END AS k,
    CASE WHEN d > 0 THEN strlen(ts[d].t) ELSE 0 END AS b, d = len(ts) AS last FROM re, unnest(range(0, len(ts) + 1)) AS u(d)
), links AS (SELECT DISTINCT p.k AS k, q.k AS up, p.d - q.d AS far FROM pre p JOIN pre q ON p.conv_id = q.conv_id AND q.d <= p.d
), nodes AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, max(b) AS b, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (last), '') AS ends FROM pre GROUP BY k, d
), kids AS (SELECT up AS k, count(*) AS n_children FROM links WHERE far = 1 GROUP BY up
), subs AS (SELECT l.up AS k, count(*) FILTER (kids.k IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.b) AS saved FROM links l JOIN nodes n ON n.k = l.k LEFT JOIN kids ON kids.k = l.k GROUP BY l.up)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(kids.n_children, 0) AS n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM nodes n JOIN subs s ON s.k = n.k LEFT JOIN kids ON kids.k = n.k LEFT JOIN links l ON l.k = n.k AND l.far = 1 LEFT JOIN nodes p ON p.k = l.up
"""
