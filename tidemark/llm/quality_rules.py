"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger stores the measurements
and one failure bit per rule; a policy is a versioned mask over those bits, so
changing a policy or asking what a rule costs never reads the texts again.

Words are runs of characters other than the six ASCII white-space characters
(space, tab, line feed, vertical tab, form feed, carriage return).

Defined results: a null or empty text has no words, all counts are 0 and it
fails ``few_words``.  A measure equal to a threshold passes.  Rows are judged one by
one, so repeated or null ids and repeated rows keep a row each.  An empty table gives an
empty ledger.  Time and memory grow with a text's length and no text is too long to
judge, but for what a row can hold.  The ledger has its own columns
only: further columns of the input, whatever their names, are not carried.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import let

WINDOW = 5
WHITE = r"[\x20\x09-\x0D]+"

#: Rule name to bit position.  Positions are stored in ledgers: append, never renumber.
RULES = {
    "few_words": 0,
    "repeated_windows": 1,
    "symbols": 2,
    "word_length": 3,
    "repeated_lines": 4,
    "capitals": 5,
    "exclamations": 6,
}


@dataclass(frozen=True)
class Policy:
    """A named, versioned choice of rules."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(1 << RULES[r] for r in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_windows"))
DEFAULT = Policy("web-1", tuple(RULES))


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WHITE), lambda w: w != "")


def _windows(words: Column, n: Column, build) -> Column:
    starts = F.when(n >= WINDOW, F.sequence(F.lit(0), n - WINDOW)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, build)


def _covered(words: Column, n: Column) -> Column:
    """Words inside windows whose text occurs again in the same document.

    Windows are compared by their text.  Their starts are sorted, and each start
    adds the words up to the next start, a full window at most.
    """
    keyed = _windows(words, n, lambda i: F.struct(F.array_join(F.slice(words, i + 1, WINDOW), " ").alias("k"), i.alias("p")))

    def starts(s: Column) -> Column:
        last = F.size(s) - 1
        same = lambda i, j: F.get(s, i)["k"] == F.get(s, j)["k"]
        marked = F.transform(
            s,
            lambda x, i: F.when(((i > 0) & same(i, i - 1)) | ((i < last) & same(i, i + 1)), x["p"]),
        )
        return F.sort_array(F.filter(marked, lambda p: p.isNotNull()))

    def total(p: Column) -> Column:
        steps = F.transform(
            p, lambda x, i: F.when(i == F.size(p) - 1, F.lit(WINDOW)).otherwise(F.least(F.get(p, i + 1) - x, F.lit(WINDOW)))
        )
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    return let(let(F.sort_array(keyed), starts), total)


def _repeat_words(words: Column, n: Column) -> Column:
    """Equal windows have equal hashes, so without equal hashes there is nothing to cover."""
    hashes = _windows(words, n, lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WINDOW)]))
    return let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(_covered(words, n)),
    )


def measurements(text: Column) -> Column:
    """A struct with the measurements of one text."""
    text = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    marks = F.regexp_replace(text, r"[^#*$%&|<>!A-Z]+", "")
    count = lambda s, drop: F.length(F.regexp_replace(s, drop, "")).cast("long")

    def of_words(w: Column) -> Column:
        n = F.size(w)
        return F.struct(
            n.cast("long").alias("n_words"),
            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
            _repeat_words(w, n).alias("n_repeat_words"),
        )

    def of_lines(x: Column) -> Column:
        return F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
        )

    def of_marks(m: Column) -> Column:
        return F.struct(
            count(m, "[!A-Z]+").alias("n_symbols"),
            count(m, "[^A-Z]+").alias("n_capitals"),
            count(m, "[^!]+").alias("n_exclamations"),
        )

    whole = F.struct(let(_words(text), of_words).alias("w"), let(lines, of_lines).alias("l"), let(marks, of_marks).alias("m"))
    return whole


def ledger(docs: DataFrame, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per document: ``carry``, the measurements and ``fail_bits``.

    Whole numbers are compared by cross-multiplication, so that no rounding can
    move a document over a threshold.
    """
    m = docs.select(*[F.col(c) for c in carry], measurements(F.col("text")).alias("_m"))
    m = m.select(*carry, "_m.w.*", "_m.l.*", "_m.m.*")
    fails = {
        "few_words": F.col("n_words") < 10,
        "repeated_windows": 100 * F.col("n_repeat_words") > 20 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
        "repeated_lines": 2 * F.col("n_dup_lines") > F.col("n_lines"),
        "capitals": 2 * F.col("n_capitals") > F.col("word_chars"),
        "exclamations": 5 * F.col("n_exclamations") > F.col("n_words"),
    }
    bits = sum((F.when(fails[r], F.lit(1 << b)).otherwise(F.lit(0)) for r, b in RULES.items()), F.lit(0))
    return m.withColumn("fail_bits", bits.cast("int"))


def passes(policy: Policy) -> Column:
    """Whether a ledger row passes ``policy``."""
    return F.col("fail_bits").bitwiseAND(F.lit(policy.mask)) == 0


def ablation(led: DataFrame, policies: tuple[Policy, ...] = (BASE, DEFAULT)) -> DataFrame:
    """Per policy and rule: documents failing it, failing only it, and kept without it.

    The ledger is folded to one row per distinct bitmask first (2**rules rows at
    most); everything else is arithmetic on that histogram.
    """
    hist = led.groupBy("fail_bits").agg(F.count("*").alias("n"))
    table = F.explode(
        F.array(
            *[
                F.struct(F.lit(p.version).alias("policy"), F.lit(r).alias("rule"), F.lit(p.mask).alias("mask"), F.lit(1 << RULES[r]).alias("bit"))
                for p in policies
                for r in p.rules
            ]
        )
    )
    x = hist.select("fail_bits", "n", table.alias("t")).select("n", F.expr("fail_bits & t.mask").alias("seen"), "t.*")
    count = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0)).cast("long")
    return x.groupBy("policy", "rule").agg(
        count(F.expr("seen & bit") != 0).alias("n_failed"),
        count(F.col("seen") == F.col("bit")).alias("n_failed_only"),
        count(F.col("seen") == 0).alias("n_kept"),
        count(F.expr("seen & ~bit") == 0).alias("n_kept_without"),
    )


def apply_policy(docs: DataFrame, policy: Policy = DEFAULT) -> DataFrame:
    """The rows of ``docs`` that pass, with the same columns.

    Everything is row-local: no shuffle, and the measurements never leave the row.
    """
    inner = docs.withColumn("_tm_row", F.struct(*[docs[c] for c in docs.columns]))
    led = ledger(inner.select("_tm_row", F.col("_tm_row.text").alias("text")), carry=("_tm_row",))
    return led.where(passes(policy)).select("_tm_row.*")


def query(spark, sf_dir: str) -> DataFrame:
    """op9 over ``documents``: measurements and both verdicts per document."""
    led = ledger(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    failed = ~passes(BASE)
    return led.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        (~failed & passes(DEFAULT)).alias("kept"),
        "fail_bits",
        F.lit(DEFAULT.version).alias("policy"),
    )


def ablation_query(spark, sf_dir: str) -> DataFrame:
    """What each rule of each policy costs, over ``documents``."""
    return ablation(ledger(spark.read.parquet(f"{sf_dir}/documents.parquet")))


LEDGER_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d
), g AS (
  SELECT rid, p, array_to_string(ws[p:p + 4], ' ') AS k
  FROM (SELECT rid, ws, unnest(range(1, len(ws) - 3)) AS p FROM w WHERE len(ws) >= 5)
), c AS (
  SELECT rid, p, count(*) OVER (PARTITION BY rid, k) AS n FROM g
), s AS (
  SELECT rid, p, lead(p) OVER (PARTITION BY rid ORDER BY p) AS q FROM c WHERE n > 1
), r AS (
  SELECT rid, sum(least(coalesce(q - p, 5), 5)) AS n FROM s GROUP BY rid
), m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(t, '[^A-Z]+', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(length(regexp_replace(t, '[^!]+', '', 'g')) AS BIGINT) AS n_exclamations,
    CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN r USING (rid)
), led AS (
  SELECT *, CAST((CASE WHEN n_words < 10 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END)
    + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END)
    + (CASE WHEN word_chars < 2 * n_words OR word_chars > 15 * n_words THEN 8 ELSE 0 END)
    + (CASE WHEN 2 * n_dup_lines > n_lines THEN 16 ELSE 0 END)
    + (CASE WHEN 2 * n_capitals > word_chars THEN 32 ELSE 0 END)
    + (CASE WHEN 5 * n_exclamations > n_words THEN 64 ELSE 0 END) AS INTEGER) AS fail_bits FROM m
)
"""

SQL = (
    LEDGER_SQL
    + f"""
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed,
  fail_bits = 0 AS kept, fail_bits, '{DEFAULT.version}' AS policy FROM led
"""
)
_TABLE = ", ".join(f"('{p.version}', '{r}', {p.mask}, {1 << RULES[r]})" for p in (BASE, DEFAULT) for r in p.rules)
ABLATION_SQL = (
    LEDGER_SQL
    + f""", t(policy, rule, mask, bit) AS (VALUES {_TABLE})
SELECT policy, rule, CAST(count(*) FILTER (WHERE fail_bits & bit <> 0) AS BIGINT) AS n_failed,
  CAST(count(*) FILTER (WHERE fail_bits & mask = bit) AS BIGINT) AS n_failed_only,
  CAST(count(*) FILTER (WHERE fail_bits & mask = 0) AS BIGINT) AS n_kept,
  CAST(count(*) FILTER (WHERE fail_bits & mask & ~bit = 0) AS BIGINT) AS n_kept_without
FROM led, t GROUP BY policy, rule
"""
)
