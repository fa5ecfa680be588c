"""Near-duplicate detection by one-permutation MinHash.

1. Each text becomes its set of distinct two-word shingles, as 64-bit hashes.
   Rows with equal sets collapse to one node.
2. One-permutation hashing cuts the hash range into ``BINS`` bins and keeps the
   least hash of each.  An empty bin copies the value of a bin picked by a hash
   of (bin, attempt), the optimal densification of Shrivastava (ICML 2017).
3. ``ROWS`` bins make a band.  Nodes that agree on a band share a bucket, and each
   bucket links its members to one of them only: a star.  Its centre is the node that
   meets most others over all its buckets, so of many copies the one with least of
   its own, which nearly all others are similar to.
4. Star edges are confirmed on the full sets and joined to components.
5. A star can miss a link between two members that its centre does not reach.  So
   the nodes of buckets that still hold several components are joined once more,
   by their rarest shingles (``_rest``): an equi join that loses no link and in
   which members of one component hardly meet.

Two documents of similarity exactly 0.8 share no band with probability
(1 - 0.8**ROWS)**BANDS, 2.6e-5; at 0.9 it is 1e-9.

Words: A-Z lower-cased, split at ASCII white space.  A text with one word is one
shingle.  Defined results: every row is a document of its own, also where ids
repeat.  A component's id is the least id of its rows; null ids do not count, and a
component without any other id has a null one.  A row is kept if its id is the
component's (null if that is null).  A null or empty text has an empty set and is
linked with nothing: its component is its own id.  Empty tables give empty results;
other columns may have any name.  A very long text is hashed in pieces; its set, 8
bytes a shingle, has to fit in a worker's memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import slices
from tidemark.operators.components import connected_components
from tidemark.session import BROADCAST_BYTES, broadcast_within, counted, dealt, materialise

ROWS, BANDS = 4, 20
BINS = ROWS * BANDS
PERCENT = 80
SHINGLE = 2
#: Words whose hashes a worker remembers, and the longest of them in bytes: some 10 MB.
CACHE, CACHED = 50_000, 64
#: So many shingles are as much to handle as a row.
SHINGLES_ROW = 16
#: Bytes of a text that are split into words at a time.
PIECE = 1 << 20

_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def _mix(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64: a bijection that spreads all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= CACHED:
            if len(self) >= CACHE:
                self.clear()
            self[word] = h
        return h


def _hashes(text: bytes, seen: dict) -> np.ndarray:
    """One hash a word."""
    parts, at = [], 0
    while at < len(text):
        cut = _SPACE.search(text, at + PIECE)
        end = cut.start() if cut else len(text)
        words = text[at:end].lower().split()  # of bytes: A-Z and the six ASCII white-space characters only
        parts.append(np.fromiter(map(seen.__getitem__, words), np.uint64, len(words)))
        at = end
    return np.concatenate(parts) if parts else np.empty(0, np.uint64)


def shingle_set(text: bytes | None, seen: dict, width: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of one text."""
    h = _hashes(text or b"", seen)
    if not len(h):
        return h
    width = min(width, len(h))
    x = np.full(len(h) - width + 1, width, np.uint64)
    for k in range(width):
        x = _mix(x * np.uint64(0x9E3779B97F4A7C15) + h[k : len(h) - width + 1 + k])
    return np.unique(x)


def _edges(bins: int) -> np.ndarray:
    return np.array([(k << 64) // bins for k in range(bins)], np.uint64)


def _probes(bins: int, tries: int = 16) -> np.ndarray:
    k = np.arange(bins * tries * bins, dtype=np.uint64) + np.uint64(0x5851F42D4C957F2D)
    return (_mix(k) % np.uint64(bins)).astype(np.int64).reshape(bins, tries * bins)


def signature(shingles: np.ndarray, edges: np.ndarray, probes: np.ndarray) -> np.ndarray:
    """One value a bin.  The set is sorted, so a bin's least hash is the first at or after its edge."""
    first = np.searchsorted(shingles, edges)
    full = first < np.append(first[1:], len(shingles))
    source = np.arange(len(edges))
    empty = np.flatnonzero(~full)
    if len(empty):
        hit = full[probes[empty]]
        at = hit.argmax(axis=1)
        source[empty] = probes[empty, at]
        for k in empty[~hit.any(axis=1)]:  # never met in practice: walk on from the bin
            source[k] = next(j % len(edges) for j in range(k, k + len(edges)) if full[j % len(edges)])
    # A copied value is told apart from a bin's own one by the bin it came from, which the value itself shows.
    return shingles[first[source]]


def band_keys(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    by = sig.reshape(-1, rows)
    x = np.arange(len(by), dtype=np.uint64)
    for k in range(rows):
        x = _mix(x * np.uint64(0x9E3779B97F4A7C15) + by[:, k])
    return x.view(np.int64)


def _binary(column: pa.Array) -> list:
    return column.cast(pa.large_binary()).to_pylist()


def _keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``t_hash`` of the text, and the text: id and hash stand for a row and its copies."""
    return docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("t_hash"), "text")


def signatures(docs: DataFrame) -> DataFrame:
    """``doc_id, t_hash, n_shingles, set_id`` (128-bit digest of the set, null if empty) and ``bands`` per row."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("t_hash", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("set_id", T.BinaryType()),
            T.StructField("bands", T.ArrayType(T.LongType())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, edges, probes = _Words(), _edges(BINS), _probes(BINS)
        for batch in (part for whole in batches for part in slices(whole, 2)):
            n, ids, keys = [], [], []
            for text in _binary(batch.column(2)):
                s = shingle_set(text, seen)
                n.append(len(s))
                ids.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                keys.append(band_keys(signature(s, edges, probes)) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=schema.names,
            )

    return _keyed(docs).mapInArrow(run, schema)


def _nodes(sigs: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """One row for each distinct set of the ``rows`` of ``sigs``, and how many: ``node`` (a number), ``set_id``, its least ``id``, a row ``r`` that has it, ``n`` and ``bands``.

    Numbers are given once and written, so that all that follows sees the same.
    """
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t_hash")
    found = sigs.where("n_shingles > 0").groupBy("set_id").agg(
        F.min("doc_id").alias("id"), F.min(row).alias("r"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands")
    )
    return counted(found.withColumn("node", F.monotonically_increasing_id()), "nodes", rows)


def sets_of(docs: DataFrame, wanted: DataFrame, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """``(node, shingles)``, once a node.  ``wanted`` has ``node`` and its row, ``r_id`` and ``r_hash``."""
    schema = T.StructType([T.StructField("node", T.LongType()), T.StructField("shingles", T.ArrayType(T.LongType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, done = _Words(), set()
        for batch in (part for whole in batches for part in slices(whole, 1)):
            node = batch.column(0).to_pylist()
            fresh = [i for i, x in enumerate(node) if x not in done and not done.add(x)]  # the input may repeat rows
            texts = batch.column(1).take(pa.array(fresh, pa.int64()))
            sets = [shingle_set(t, seen).view(np.int64) for t in _binary(texts)]
            yield pa.RecordBatch.from_arrays([pa.array([node[i] for i in fresh], pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=schema.names)

    same = F.col("doc_id").eqNullSafe(F.col("r_id")) & (F.col("t_hash") == F.col("r_hash"))
    rows = _keyed(docs).join(broadcast_within(wanted, max_broadcast), same).select("node", "text")
    made = materialise(rows.mapInArrow(run, schema), "sets")
    return made.dropDuplicates(["node"]) if made.count() > wanted.count() else made


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs ``(a, b)`` whose full sets are similar enough."""
    left, right = (sets.select(F.col("node").alias(f"id_{x}"), F.col("shingles").alias(f"s_{x}")) for x in "ab")
    both = pairs.join(left, F.col("a") == F.col("id_a")).join(right, F.col("b") == F.col("id_b"))
    inter = F.size(F.array_intersect("s_a", "s_b"))
    x = both.select("a", "b", inter.alias("i"), F.size("s_a").alias("na"), F.size("s_b").alias("nb"))
    return x.where(100 * F.col("i") >= percent * (F.col("na") + F.col("nb") - F.col("i"))).select("a", "b")


def _close(n: str, o: str) -> Column:
    """Sets of too different sizes cannot be similar."""
    return 100 * F.least(n, o) >= PERCENT * F.greatest(n, o)


def _rest(left: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of nodes with different labels ``l`` among ``left`` (``node, n, l``), with all similar ones among them.

    The prefix filter of set-similarity joins.  Shingles are ordered by how many of
    these nodes have them, the rarest first, then by value.  Sets of n <= o shingles
    that are similar share at least ``need`` of them.  So the first that they share,
    in that order, is among the first n - need + 1 of the smaller and the first
    o - need + 1 of the larger, and ``need`` is at least 8/9 n and 4/5 o.  Nodes are
    joined on shingles in such places.  Shingles of one node or one label are left
    out.  Of each shingle's commonest label, usually one large component, no two
    nodes are compared: it is on one side of the join at most.
    """
    p = PERCENT
    work = (left.agg(F.sum("n")).first()[0] or 0) // SHINGLES_ROW
    each = sets.join(left, "node").select("node", "n", "l", F.explode("shingles").alias("h"))
    often = materialise(each.groupBy(F.col("h").alias("h_")).agg(F.count("*").alias("df")).where("df > 1"), "often", work)
    shared = each.join(often, F.col("h") == F.col("h_"))
    ranked = shared.groupBy("node").agg(F.first("n").alias("n"), F.first("l").alias("l"), F.sort_array(F.collect_list(F.struct("df", "h"))).alias("s"))
    ahead = F.col("n") - F.size("s")  # shingles of this node only come first
    room = F.expr(f"n - ({p} * n + 99) div 100 + 1") - ahead
    first = F.slice("s", F.lit(1), F.greatest(room, F.lit(0)).cast("int"))
    places, found = counted(ranked.select("node", "n", "l", ahead.alias("k"), F.posexplode(first).alias("i", "x")).select(
        "node", "n", "l", (F.col("k") + F.col("i") + 1).alias("p"), F.col("x.h").alias("h")
    ), "prefixes", work)
    labels = places.groupBy("h", "l").agg(F.count("*").alias("c")).groupBy(F.col("h").alias("h_"))
    main = labels.agg(F.max(F.struct("c", "l"))["l"].alias("main"), F.count("*").alias("labels")).where("labels > 1")
    main = materialise(main, "main", found // SHINGLES_ROW)
    posts = places.join(main, F.col("h") == F.col("h_")).select("node", "n", "l", "p", "h", (F.col("l") == F.col("main")).alias("m"))
    posts = materialise(posts, "postings", found)
    x, y = (posts.select("h", *[F.col(c).alias(f"{c}{i}") for c in ("node", "n", "l", "p", "m")]) for i in "ab")
    x = x.where(F.expr(f"pa <= na - ({2 * p} * na + {99 + p}) div {100 + p} + 1"))
    need = F.expr(f"({p} * (na + nb) + {99 + p}) div {100 + p}")
    fit = (F.col("la") != F.col("lb")) & (F.col("na") <= F.col("nb")) & _close("na", "nb") & (F.least(F.expr("na - pa"), F.expr("nb - pb")) + 1 >= need)
    pair = F.greatest("nodea", "nodeb").alias("a"), F.least("nodea", "nodeb").alias("b")
    met = [v.join(w, v["h"] == w["h"]).where(fit).select(*pair) for v, w in ((x.where("NOT ma"), y), (x.where("ma"), y.where("NOT mb")))]
    return met[0].unionByName(met[1]).distinct()


def _labelled(docs: DataFrame, max_broadcast: int = BROADCAST_BYTES) -> tuple[DataFrame, int]:
    """Per row of ``docs``: ``doc_id, t_hash, n_shingles``, its component's ``group`` (null without words) and ``component_id``; and how many rows."""
    sigs, n_rows = counted(signatures(docs), "signatures")
    nodes, n_nodes = _nodes(sigs, n_rows)
    rows = nodes.select("node", "n", F.explode("bands").alias("key"))
    # Written apart, here and below, so that a join on a bucket that many nodes share can be split.
    several = materialise(rows.groupBy(F.col("key").alias("key_")).agg(F.count("*").alias("members")).where("members > 1"), "several", n_nodes)
    buckets, met_in = counted(rows.join(several, F.col("key") == F.col("key_")).drop("key_"), "buckets", n_nodes)
    met = buckets.groupBy(F.col("node").alias("node_")).agg(F.sum("members").alias("met"))
    ranked = buckets.join(met, F.col("node") == F.col("node_")).groupBy(F.col("key").alias("key_"))
    centre = materialise(ranked.agg(F.max(F.struct("met", "node", "n")).alias("c")).select("key_", F.col("c.node").alias("c_node"), F.col("c.n").alias("c_n")), "centres", met_in)
    wanted = nodes.join(buckets.select("node").distinct(), "node", "left_semi").select("node", F.col("r.doc_id").alias("r_id"), F.col("r.t_hash").alias("r_hash"))
    sets = sets_of(docs, materialise(wanted, "wanted", n_nodes), max_broadcast)
    star = buckets.join(centre, F.col("key") == F.col("key_")).where((F.col("node") != F.col("c_node")) & _close("n", "c_n"))
    star = star.select(F.col("node").alias("a"), F.col("c_node").alias("b"), (F.col("n") + F.col("c_n")).alias("both")).distinct()
    stars, shingles = counted(star, "stars", met_in, "sum(both)")
    links, n_links = counted(confirmed(stars, sets), "links", shingles // SHINGLES_ROW)
    comp, n_comp = counted(connected_components(links, "a", "b", n_links), "components", n_links)

    # What stars leave: nodes of one bucket, in different components.
    labelled = buckets.join(comp.withColumnRenamed("node", "of"), F.col("node") == F.col("of"), "left").select("key", "node", "n", F.coalesce("component", "node").alias("l"))
    open_ = labelled.groupBy(F.col("key").alias("key_")).agg(F.min("l").alias("lo"), F.max("l").alias("hi")).where("lo <> hi").select("key_")
    left = materialise(labelled.join(open_, F.col("key") == F.col("key_"), "left_semi").select("node", "n", "l").distinct(), "open", met_in)
    pairs, n_pairs = counted(_rest(left, sets).join(stars, ["a", "b"], "left_anti"), "pairs")
    most = left.agg(F.max("n")).first()[0] or 0
    more, n_more = counted(confirmed(pairs, sets), "links", 2 * most * n_pairs // SHINGLES_ROW)
    if n_more:
        known = comp.select(F.col("node").alias("a"), F.col("component").alias("b"))
        comp, n_comp = counted(connected_components(known.unionByName(more), "a", "b", n_comp + n_more), "components", n_comp + n_more)

    # A component is named by the least id of its nodes.
    member = comp.join(nodes.select(F.col("node").alias("of"), "id"), F.col("node") == F.col("of"))
    least = materialise(member.groupBy(F.col("component").alias("c_")).agg(F.min("id").alias("least")), "least", n_comp)
    member = member.join(least, F.col("component") == F.col("c_")).select(F.col("node").alias("of"), "component", "least")
    named = nodes.select("set_id", "node", "id").join(materialise(member, "members", n_comp), F.col("node") == F.col("of"), "left").select(
        F.col("set_id").alias("set_of"), F.coalesce("component", "node").alias("group"), F.when(F.col("of").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id")
    )
    columns = ["doc_id", "t_hash", "n_shingles", "group", "component_id"]
    out = dealt(sigs.where("n_shingles > 0").join(named, F.col("set_id") == F.col("set_of")).select(*columns), n_rows)
    alone = sigs.where("n_shingles = 0").withColumns({"group": F.lit(None).cast("long"), "component_id": F.col("doc_id")})
    return out.unionByName(alone.select(*columns)), n_rows


def near_components(docs: DataFrame, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_shingles, component_id, kept``."""
    kept = F.col("component_id").eqNullSafe(F.col("doc_id"))
    return _labelled(docs, max_broadcast)[0].select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def keep_one(docs: DataFrame, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with one row of each component, its columns unchanged; rows without words all stay.

    The row that stays has the component's id and, where several have it, the least
    hash of its text.  Of rows that agree in id and text any one stays.  Rows are told
    apart by id and text, so another text under the same id stays if it is no copy.
    What goes is broadcast if it is small, so that the texts stay where they are.
    """
    labelled, n_rows = _labelled(docs, max_broadcast)
    each = labelled.where("n_shingles > 0").groupBy("doc_id", "t_hash").agg(F.first("group").alias("group"), F.count("*").alias("rows"))
    each = materialise(each, "rows", n_rows)
    first = each.groupBy(F.col("group").alias("g_")).agg(F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "t_hash")).alias("w"))
    marked = each.join(materialise(first, "first", n_rows), F.col("group") == F.col("g_"))
    stays = (F.col("t_hash") == F.col("w.t_hash")) & F.col("doc_id").eqNullSafe(F.col("w.doc_id"))
    marked = materialise(marked.select(F.col("doc_id").alias("_tm_id"), F.col("t_hash").alias("_tm_hash"), stays.alias("stays"), "rows").where("NOT stays OR rows > 1"), "repeated", n_rows)
    hashed = F.xxhash64(F.coalesce(docs["text"], F.lit("")))

    def of(rows: DataFrame, which: str, how: str) -> DataFrame:
        keys = broadcast_within(marked.where(which).select("_tm_id", "_tm_hash"), max_broadcast)
        return rows.join(keys, docs["doc_id"].eqNullSafe(keys["_tm_id"]) & (hashed == keys["_tm_hash"]), how)

    if marked.where("stays").isEmpty():
        return of(docs, "NOT stays", "left_anti")
    once = of(docs, "stays", "left_semi").withColumn("_tm_hash", hashed).dropDuplicates(["doc_id", "_tm_hash"]).drop("_tm_hash")
    return of(docs, "true", "left_anti").unionByName(once)


def query(spark, sf_dir: str) -> DataFrame:
    """op2 over ``documents``."""
    return near_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH RECURSIVE w AS (
  SELECT row_number() OVER () AS rid, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws
  FROM documents
), sh AS (
  SELECT DISTINCT rid, s FROM (
    SELECT rid, CASE WHEN len(ws) = 1 THEN ws[1] ELSE ws[p] || ' ' || ws[p + 1] END AS s
    FROM (SELECT rid, ws, unnest(range(1, greatest(len(ws) - 1, 1) + 1)) AS p FROM w WHERE len(ws) > 0))
), n AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid
), i AS (
  SELECT a.rid AS a, b.rid AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.rid <> b.rid GROUP BY ALL
), e AS (
  SELECT a, b FROM i JOIN n x ON x.rid = a JOIN n y ON y.rid = b WHERE 100 * i >= 80 * (x.n + y.n - i)
), r AS (
  SELECT rid AS a, rid AS b FROM w UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a
), c AS (SELECT a, min(doc_id) AS c FROM r JOIN w ON rid = b GROUP BY a)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, c AS component_id, w.doc_id IS NOT DISTINCT FROM c AS kept
FROM w LEFT JOIN n ON n.rid = w.rid JOIN c ON c.a = w.rid
"""
