"""URL filtering by rules and by a ratio of character language models.

Rules come first: a rule ``host/path`` fits its host and all subdomains if the
URL's path starts with the rule's path; the longest fitting rule decides.

All other URLs are judged by two variable-order Markov models, one of accepted
and one of rejected URLs.  They read all that follows the scheme, query and fragment
included, in lower case.  Counts over every labelled URL of the table, for contexts of up
to ``ORDER`` characters, are smoothed by Witten-Bell interpolation from each order
to the next shorter one.  A URL's score is its log-likelihood under the rejected
model minus that under the accepted one, per character.

The threshold is calibrated on held-out hosts: hosts are dealt into two folds by
hash, and every labelled URL is scored by models that were counted on the other fold.
The cut has the best balanced accuracy over all of these scores.

Labels come from two sources.  A host of the table is rejected if one of its parts is
a word of ``SEEDS``, has no label if it contains one of the longer ones otherwise, and is
accepted if not; a URL without a label counts for neither model.  Beside them stands a list of labelled URLs (``labelled``),
``VARIANTS`` of each word, in which unwanted words are joined with others, spelt with
digits or doubled, as no part of a host equals a seed.  So a host that no seed names is
judged by what its characters have in common with those that one does, and a harmless
host with a seed among its parts can be allowed.

The alphabet has ``len(ALPHABET) + 2`` symbols, so a model has at most
40**(ORDER + 1) numbers whatever the table's size: a table of ratios has 10 MB, and the
counts that reach the driver, of two models and two folds, 10 million numbers at most.

Defined results: a null URL, or one without ``://``, has an empty host and path,
fits no rule and is allowed: nothing speaks against it.  A URL with ``://`` and no
host has an accepted label and is judged by the models.  A score equal to the cut is
allowed.  Scores beyond 10 either way count as 10 in the calibration.  Rows are judged
one by one, null and repeated ids and repeated rows included; an empty table gives no
rows.  Only ``page_id`` and ``url`` are read by name; other columns may have any.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.batches import slices
from tidemark.session import materialise

#: (rule, verdict).
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Words that mark unwanted hosts in the labels.
SEEDS = (
    "ad", "ads", "adult", "adserver", "bet", "bets", "betting", "bingo", "casino", "cheap", "click", "farm", "free", "gambling",
    "loan", "loans", "lottery", "payday", "pharma", "pills", "poker", "popup", "porn", "promo", "slots", "spam", "track",
    "tracker", "tracking", "viagra", "warez", "win", "xxx",
)
ALPHABET = "abcdefghijklmnopqrstuvwxyz0./-_%~:?=&#"
ORDER = 3
S = 40  # symbols: the alphabet, others, and the ends
EDGE, OTHER = 39, 38
BINS = 400
#: Labelled URLs of the list for each word.
VARIANTS, SEED = 24, 5
#: Letters of a seed from which on a host that only contains it has no label.
CONTAINED = 4
#: Bytes of URLs that a worker handles at a time; each character takes some 50 while it is counted.
SLICE_BYTES = 1 << 20
#: Harmless words for the list.
NEUTRAL = (
    "archive", "bakery", "bridge", "city", "cloud", "data", "forest", "forum", "garden", "guide", "harbour", "health", "history", "journal",
    "kitchen", "letter", "library", "market", "museum", "music", "nature", "news", "paper", "river", "school", "science", "sport", "stone",
    "studio", "summer", "theatre", "travel", "weather", "window", "winter",
)
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://[^/?#]*([^?#]*)", 1)


def whole(url: Column) -> Column:
    """What the models read: all after the scheme."""
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)\A.*?://(.*)\z", 1))


def rule(h: Column, p: Column, rules=RULES) -> Column:
    """The longest rule that fits, or null."""
    out = F.lit(None).cast("string")
    for text, _ in sorted(rules, key=lambda x: len(x[0])):
        at, _, rest = text.partition("/")
        fits = ((h == at) | h.endswith("." + at)) & p.startswith("/" + rest)
        out = F.when(fits, F.lit(text)).otherwise(out)
    return out


def rejected(h: Column, seeds=SEEDS) -> Column:
    """The default label: null where a longer seed is only contained, digits read as the letters they look like."""
    part = F.arrays_overlap(F.split(h, r"[.\-]"), F.array(*map(F.lit, seeds)))
    plain = F.translate(h, "431057", "aeiost")
    within = plain.rlike("|".join(w for w in seeds if len(w) >= CONTAINED))
    return F.when(part, True).when(within, F.lit(None)).otherwise(False)


def labelled(variants: int = VARIANTS, seeds=SEEDS) -> list[tuple[str, bool]]:
    """URLs without their scheme, and whether they are rejected."""
    rng, out = random.Random(SEED), []
    digits = str.maketrans("aeiost", "431057")
    for words, bad in ((seeds, True), (NEUTRAL, False)):
        for w in words:
            for k in range(variants):
                mate = rng.choice((*NEUTRAL, *(seeds if bad else ())))
                shape = (w + mate, mate + w, w.translate(digits) + mate, f"{w}{rng.randint(1, 999)}", w + w[-1] + mate, f"{mate}{w}s")[k % 6]
                front, end = rng.choice(("", "", "www.", "m.", "blog.")), rng.choice(("com", "org", "net", "info"))
                tail = rng.choice(("", "?page=2", ".html", "#top", "/"))
                out.append((f"{front}{shape}.example.{end}/{rng.choice(('en', 'de', 'fr', 'es'))}/{rng.randint(1, 9999)}{tail}", bad))
    return out


def _codes(text: str) -> np.ndarray:
    """The text's symbols between edges; digits are one symbol."""
    table = _codes.table
    raw = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    return np.concatenate([np.full(ORDER, EDGE, np.int64), table[np.minimum(raw, 255)], [EDGE]])


_codes.table = np.full(256, OTHER, np.int64)
for _i, _c in enumerate(ALPHABET):
    _codes.table[ord(_c)] = _i
for _c in "123456789":
    _codes.table[ord(_c)] = ALPHABET.index("0")


def _grams(text: str) -> np.ndarray:
    c = _codes(text)
    return ((c[:-3] * S + c[1:-2]) * S + c[2:-1]) * S + c[3:]


def counts(urls: DataFrame) -> DataFrame:
    """``(fold, rejected, gram, n)`` over all of ``urls`` (``text``, ``rejected``, ``fold``, ``n``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in slices(batch, 0, SLICE_BYTES)):
            texts, bad, fold, n = (b.column(i).to_pylist() for i in range(4))
            for side in ((f, x) for f in (0, 1) for x in (False, True)):
                mine = [i for i in range(len(texts)) if (fold[i], bad[i]) == side]
                if not mine:
                    continue
                grams = [_grams(texts[i]) for i in mine]
                weight = np.repeat([n[i] for i in mine], [len(g) for g in grams])
                ids, inverse = np.unique(np.concatenate(grams), return_inverse=True)
                total = np.bincount(inverse, weights=weight).astype(np.int64)
                kind = [pa.array([x] * len(ids), t) for x, t in zip(side, (pa.int32(), pa.bool_()), strict=True)]
                yield pa.RecordBatch.from_arrays([*kind, pa.array(ids), pa.array(total)], names=["fold", "rejected", "gram", "n"])

    each = urls.select("text", "rejected", "fold", "n").mapInArrow(run, "fold int, rejected boolean, gram long, n long")
    return each.groupBy("fold", "rejected", "gram").agg(F.sum("n").alias("n"))


def smoothed(full: np.ndarray) -> np.ndarray:
    """Log probabilities, by context and symbol, from the counts of all (ORDER + 1)-grams."""
    p = np.full(S, 1 / S)
    for order in range(ORDER + 1):
        c = full.reshape(-1, S ** (order + 1)).sum(axis=0).reshape(-1, S).astype(np.float64)
        total, kinds = c.sum(axis=1, keepdims=True), (c > 0).sum(axis=1, keepdims=True)
        shorter = np.tile(p.reshape(-1, S), (len(c) // max(1, p.size // S), 1))
        with np.errstate(invalid="ignore", divide="ignore"):
            p = np.where(total > 0, (c + kinds * shorter) / (total + kinds), shorter)
    return np.log(p.ravel()).astype(np.float32)


def score(texts: list[str], ratio: np.ndarray) -> np.ndarray:
    return np.array([float(ratio[_grams(t)].mean()) if t else 0.0 for t in texts])


def _scored(df: DataFrame, tables) -> DataFrame:
    """``df`` with ``score``: by the table of its ``fold``, or by the only one."""
    schema = T.StructType([*df.schema.fields, T.StructField("score", T.DoubleType())])
    at = df.columns.index("text")
    by = df.columns.index("fold") if "fold" in df.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (part for batch in batches for part in slices(batch, at, SLICE_BYTES)):
            texts = b.column(at).to_pylist()
            which = b.column(by).to_pylist() if by is not None else [0] * len(texts)
            found = [score([t], tables.value[k])[0] for t, k in zip(texts, which, strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.float64())], names=schema.names)

    return df.mapInArrow(run, schema)


def threshold(hist: np.ndarray) -> float:
    """The cut between accepted and rejected scores (rows of ``hist``, ``BINS`` bins from -10 to 10) with the best balanced accuracy."""
    rate = hist / hist.sum(axis=1, keepdims=True)
    below = np.concatenate([[[0.0], [0.0]], np.cumsum(rate, axis=1)], axis=1)
    quality = (below[0] + 1 - below[1])[: BINS + 1]
    best = np.flatnonzero(np.isclose(quality, quality.max()))
    return float(best.mean() * (20 / BINS) - 10)


def train(urls: DataFrame, extra: list[tuple[str, bool]] | None = None) -> tuple[np.ndarray, float]:
    """The table of log ratios and the calibrated threshold.

    ``urls`` has ``text``, ``host`` and ``rejected``; ``extra`` is the list of labelled
    URLs.  Equal texts are added up first, so a URL with a third of all rows costs one.
    """
    spark = urls.sparkSession
    extra = labelled() if extra is None else extra
    more = spark.createDataFrame([(t, t.split("/")[0], x) for t, x in extra], "text string, host string, rejected boolean")
    fold = F.pmod(F.xxhash64("host"), F.lit(2)).cast("int").alias("fold")
    both = urls.where("text <> '' AND rejected IS NOT NULL").select("text", "host", "rejected").unionByName(more).select("text", "rejected", fold)
    own = materialise(both.groupBy("text", "rejected", "fold").agg(F.count("*").alias("n")), "urls")
    rows = counts(own).toArrow()  # at most 4 * S ** (ORDER + 1) rows of 21 bytes
    full = np.zeros((2, 2, S ** (ORDER + 1)), np.int64)
    full[rows["fold"].to_numpy(), rows["rejected"].to_numpy().astype(int), rows["gram"].to_numpy()] = rows["n"].to_numpy()
    ratio = lambda c: smoothed(c[1]) - smoothed(c[0])
    apart = spark.sparkContext.broadcast([ratio(full[1]), ratio(full[0])])  # each fold is scored by the other's
    bins = F.floor((F.greatest(F.least("score", F.lit(10.0)), F.lit(-10.0)) + 10) * (BINS / 20)).cast("int")
    found = _scored(own, apart).groupBy("rejected", bins.alias("bin")).agg(F.sum("n").alias("n")).collect()
    hist = np.zeros((2, BINS + 1))
    for r in found:
        hist[int(r["rejected"]), r["bin"]] += r["n"]
    return ratio(full.sum(axis=0)), threshold(hist)


def judge(pages: DataFrame, rules=RULES, seeds=SEEDS) -> DataFrame:
    """``page_id, host, path, rule, verdict, score`` for every row."""
    rows = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"), whole(F.col("url")).alias("text"))
    ratio, cut = train(rows.select("text", "host", rejected(F.col("host"), seeds).alias("rejected")), labelled(seeds=seeds))
    spark: SparkSession = pages.sparkSession
    out = _scored(rows, spark.sparkContext.broadcast([ratio])).withColumn("rule", rule(F.col("host"), F.col("path"), rules))
    by_rule = F.create_map(*[F.lit(x) for pair in rules for x in pair])[F.col("rule")]
    own = F.when((F.col("text") != "") & (F.col("score") > cut), "block").otherwise("allow")
    return out.select("page_id", "host", "path", "rule", F.coalesce(by_rule, own).alias("verdict"), "score")


def query(spark, sf_dir: str) -> DataFrame:
    """op8 over ``pages``."""
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet")).drop("score")
