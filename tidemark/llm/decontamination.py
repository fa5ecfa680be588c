"""Benchmark decontamination by windows of normalised words.

The benchmark becomes a set of word windows, broadcast as a hash table.  One
scan of the documents hashes the start of every window of every text, probes the
table, and confirms each hit on the words themselves.  Hits become spans, item lists and a
verdict; documents or spans can then be removed.

Words: A-Z lower-cased, then runs of ASCII letters, digits and any character
above U+007F.  A window is 13 consecutive item words; an item with fewer, but
some, is one window.

The table is broadcast up to ``BROADCAST_BYTES``, as measured.  A larger benchmark is
cut into blocks of that size by hash, and the documents are scanned once a block, so
the broadcast stays bounded whatever the benchmark's size or the length of its words.

Defined results: null or empty texts have no words and are clean.  Null or
wordless items have no windows; a null item id counts as the empty string.
Repeated rows of ``documents`` are judged each; repeated items add nothing.
Empty tables on either side give clean documents or no rows.  A text's words and
their hashes have to fit in a row's memory; no text is cut.  Only ``doc_id`` and
``text`` (``item_id`` and ``text``) are read by name, so other columns of either
table can have any name.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions.columns import let
from tidemark.session import BROADCAST_BYTES, ROW_BYTES, broadcast_within, materialise

N = 13
#: Windows are looked up by the hash of their first words, then compared whole.
ANCHOR = 4
BREAK = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: Column) -> Column:
    """Normalised words.  One regular expression splits; only words beyond ASCII need the slow mapping of A-Z."""
    parts = F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\A" + BREAK, ""), BREAK)
    full = lambda w: F.when(F.element_at(w, -1) == "", F.slice(w, 1, F.size(w) - 1)).otherwise(w)
    norm = lambda x: F.when(F.octet_length(x) == F.length(x), F.lower(x)).otherwise(F.translate(x, UPPER, LOWER))
    return F.transform(let(parts, full), norm)


def windows(bench: DataFrame) -> DataFrame:
    """``item_id`` (string), ``n`` words and ``win`` (their text), one row per distinct pair."""
    w = bench.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item_id"), _words(F.col("text")).alias("w"))
    starts = let(F.col("w"), lambda x: F.when(F.size(x) > 0, F.sequence(F.lit(0), F.greatest(F.size(x) - N, F.lit(0)))))
    w = w.select("item_id", "w", F.explode_outer(starts).alias("p")).where("p IS NOT NULL")
    part = F.slice("w", F.col("p") + 1, F.lit(N))
    return w.select("item_id", F.size(part).alias("n"), F.array_join(part, " ").alias("win")).distinct()


def _probe(docs: DataFrame, table: DataFrame, anchor: int, mark: bool) -> DataFrame:
    """Occurrences of the windows in ``table``, found by their first ``anchor`` words.

    With ``mark``, each document also gives one row with ``n`` 0 and its number of
    words as ``p``, so that texts are read and split once.
    """

    def hashed(w: Column) -> Column:
        first = F.transform(w, lambda x, i: F.xxhash64(x, *[F.get(w, i + k) for k in range(1, anchor)]))
        return F.struct(w.alias("w"), (F.concat(first, F.array(F.lit(0).cast("long"))) if mark else first).alias("h"))

    rows = docs.select(
        F.col("doc_id").alias("k_id"),
        F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("k_hash"),
        let(_words(F.col("text")), hashed).alias("x"),
    ).select("k_id", "k_hash", "x.w", "x.h")
    # The outer form keeps Catalyst from testing the array's size in a filter, which would build it twice.
    rows = rows.select("k_id", "k_hash", "w", F.posexplode_outer("h").alias("p", "h"))
    lead = F.slice(F.split("win", " "), 1, anchor)
    t = table.select(F.xxhash64(*[F.get(lead, k) for k in range(anchor)]).alias("t_h"), "n", "win")
    if mark:
        t = t.unionByName(docs.sparkSession.range(1).select(F.lit(0).cast("long").alias("t_h"), F.lit(0).alias("n"), F.lit("").alias("win")))
    text = F.array_join(F.slice("w", F.col("p") + 1, F.greatest("n", F.lit(1))), " ")
    same = (F.col("h") == F.col("t_h")) & F.when(F.col("n") == 0, F.col("p") == F.size("w")).otherwise(text == F.col("win"))
    return rows.join(F.broadcast(t), same).select("k_id", "k_hash", "p", "n", "win")


def hits(docs: DataFrame, bench: DataFrame, max_broadcast: int = BROADCAST_BYTES) -> tuple[DataFrame, DataFrame]:
    """Confirmed occurrences ``(k_id, k_hash, p, n, win)``, and the benchmark's windows.

    ``(k_id, k_hash)`` stands for a document: its id and its text's hash.  A row
    with ``n`` 0 is the document itself, ``p`` its number of words.  The table is
    written once, since spans, items and documents are all read from it.
    """
    wins = windows(bench)
    wins = materialise(wins, "windows")
    table, parts = wins.select("n", "win").distinct(), []
    taken = F.sum(F.octet_length("win") + F.lit(ROW_BYTES))
    size = {r["n"]: r["b"] for r in table.groupBy("n").agg(taken.alias("b")).collect()}  # 13 rows at most
    for anchor in sorted({min(n, ANCHOR) for n in size} or {ANCHOR}, reverse=True):
        own = table.where(F.least("n", F.lit(ANCHOR)) == anchor)
        blocks = max(1, -(-sum(b for n, b in size.items() if min(n, ANCHOR) == anchor) // max_broadcast))
        for b in range(blocks):
            part = own.where(F.pmod(F.xxhash64("win"), F.lit(blocks)) == b) if blocks > 1 else own
            parts.append(_probe(docs, part, anchor, mark=not parts))
    return materialise(reduce(DataFrame.unionByName, parts), "hits"), wins


def _same(a: DataFrame, b: DataFrame, how: str = "inner") -> DataFrame:
    """Join on the document key; ids may be null."""
    b = b.withColumnsRenamed({"k_id": "j_id", "k_hash": "j_hash"})
    return a.join(b, a["k_id"].eqNullSafe(b["j_id"]) & (a["k_hash"] == b["j_hash"]), how).drop("j_id", "j_hash")


def judged(docs: DataFrame, bench: DataFrame, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """Per row of ``docs``: its key, counts, items, hit spans ``[a, z)`` in words, and the verdict."""
    found, wins = hits(docs.select("doc_id", "text"), bench, max_broadcast)
    base = found.where("n = 0").select("k_id", "k_hash", F.col("p").cast("long").alias("n_words"))
    # A repeated row repeats its document's hits; one of each is enough.
    found = found.where("n > 0").distinct()
    key = ["k_id", "k_hash"]
    # Overlapping hits: each adds the words past the furthest end so far.
    before = Window.partitionBy(*key).orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    spot = found.groupBy(*key, "p").agg(F.max(F.col("p") + F.col("n")).alias("z"))
    span = spot.withColumn("a", F.greatest("p", F.coalesce(F.max("z").over(before), F.col("p")))).where("a < z")
    spans = span.groupBy(*key).agg(
        F.sum(F.col("z") - F.col("a")).cast("long").alias("n_hit"), F.sort_array(F.collect_list(F.struct("a", "z"))).alias("spans")
    )
    items = found.select(*key, "win").distinct().join(wins.select("win", "item_id"), "win").select(*key, "item_id").distinct()
    items = items.groupBy(*key).agg(F.count("*").alias("n_items"), F.sort_array(F.collect_list("item_id")).alias("items"))
    out = _same(base, _same(spans, items), "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    sha = F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256)
    bad = (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    return out.select(
        *key, "n_words", n("n_hit"), n("n_items"), "items", sha.alias("items_sha256"), "spans", F.coalesce(bad, F.lit(False)).alias("contaminated")
    )


def _keyed(docs: DataFrame, found: DataFrame, how: str) -> DataFrame:
    on = docs["doc_id"].eqNullSafe(found["k_id"]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == found["k_hash"])
    return docs.join(found, on, how)


def remove_documents(docs: DataFrame, bench: DataFrame, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` without the contaminated ones, with the same columns.

    Documents are matched by id and text, so a repeated id is judged text by text.
    Few keys are broadcast, so that the texts stay where they are.
    """
    gone = judged(docs, bench, max_broadcast).where("contaminated").select("k_id", "k_hash").distinct()
    return _keyed(docs, broadcast_within(materialise(gone, "contaminated"), max_broadcast), "left_anti")


def remove_spans(docs: DataFrame, bench: DataFrame, max_broadcast: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with every hit word, and what separates it from the next, cut from the text."""
    found = judged(docs, bench, max_broadcast).where("n_hit > 0").select("k_id", "k_hash", F.col("spans").alias("_tm_spans"))
    out = _keyed(docs, found.dropDuplicates(["k_id", "k_hash"]), "left")
    text = F.coalesce(docs["text"], F.lit(""))
    word = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

    def rebuild(words: Column, gaps: Column) -> Column:
        hit = lambda i: F.exists("_tm_spans", lambda s: (i >= s["a"]) & (i < s["z"]))
        kept = F.transform(words, lambda x, i: F.when(hit(i), F.lit("")).otherwise(F.concat(x, F.coalesce(F.get(gaps, i + 1), F.lit("")))))
        return F.concat(F.get(gaps, F.lit(0)), F.array_join(kept, ""))

    words = F.regexp_extract_all(text, F.lit(word), F.lit(0))
    clean = let(words, lambda w: let(F.split(text, word, -1), lambda g: rebuild(w, g)))
    new = F.when(F.col("_tm_spans").isNull(), docs["text"]).otherwise(clean)
    return out.select(*[new.alias(c) if c == "text" else docs[c] for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op5 over ``documents`` against the whole ``benchmark``."""
    docs, bench = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    out = judged(docs, bench)
    return out.select(F.col("k_id").alias("doc_id"), "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


SQL = rf"""
WITH b AS (
  SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[p:p + least(len(w), 13) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS p FROM b WHERE len(w) > 0)
), ln AS (SELECT DISTINCT n FROM bw), d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), dw AS (
  SELECT rid, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, ln WHERE len(w) >= n)
), hit AS (
  SELECT DISTINCT rid, p, dw.n, win FROM dw SEMI JOIN bw USING (win)
), pos AS (
  SELECT rid, count(DISTINCT q) AS n_hit FROM (SELECT rid, unnest(range(p, p + n)) AS q FROM hit) GROUP BY rid
), it AS (
  SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items
  FROM (SELECT DISTINCT rid, item_id FROM hit JOIN bw USING (win)) GROUP BY rid
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN it USING (rid)
"""
