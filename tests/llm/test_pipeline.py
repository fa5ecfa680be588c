"""The corpus pipeline as a whole, against a plain version of its five stages."""

import random
import re

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.test_operators import CLASH, brute_components, brute_hits, brute_quality
from tests.llm.test_secrets import plain_scan
from tidemark.llm import decontamination, near_dedup, quality_rules, secret_scan, sentencepiece_scan

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def passes(t):
    t = t or ""
    n, chars, symbols, dup, repeat = brute_quality(t)
    lines = len([x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)])
    capitals, shouts = len(re.findall("[A-Z]", t)), t.count("!")
    fails = n < 10 or 100 * repeat > 20 * n or 10 * symbols > n or chars < 2 * n or chars > 15 * n or 2 * dup > lines or 2 * capitals > chars or 5 * shouts > n
    return not fails


def hashes(spark, rows):
    """Texts to the hashes that decide between rows of one id."""
    df = spark.createDataFrame([(t,) for _, t in rows if t is not None], "t string").distinct()
    return {r["t"]: r["h"] for r in df.select("t", F.xxhash64("t").alias("h")).collect()}


def one_of_each(rows, order):
    of, out = brute_components([t for _, t in rows]), {}
    for k, (i, t) in enumerate(rows):
        key = of[k][1] if of[k][0] else ("alone", k)
        mine = (i is None, i or 0, order.get(t, 0), t)
        out[key] = min(out.get(key, mine), mine)
    return [(None if none else i, t) for none, i, _, t in out.values()]


def redacted(t, forest):
    out, at = "", 0
    for _, start, length, _, p in plain_scan(t, forest):
        if p > secret_scan.CUT:
            out += t[at:start] + secret_scan.MASK
            at = start + length
    return out + t[at:]


def plain(rows, bench, order):
    sp, forest = sentencepiece_scan.encoder(sentencepiece_scan.MODEL).sp, secret_scan._default_forest()
    rows = one_of_each([r for r in rows if passes(r[1])], order)
    rows = [r for r in rows if not brute_hits(r[1], bench)[3]]
    rows = [(i, redacted(t, forest)) for i, t in rows]
    return sorted(((i, len(t), tuple(sp.encode(t)), True) for i, t in rows), key=str)


def fixture():
    rng = random.Random(21)
    word = lambda: "".join(rng.choice("abcdefghilmnoprstu") for _ in range(rng.randint(2, 9)))
    prose = lambda n: " ".join(word() for _ in range(n))
    items = [(k, prose(n)) for k, n in enumerate((14, 30, 13, 6))] + [(None, None), (9, "")]
    texts = [prose(rng.randint(20, 120)) for _ in range(25)]
    rows = list(enumerate(texts))
    for k in range(12):  # near copies
        words = texts[k].split()
        words[rng.randrange(len(words))] = word()
        rows.append((100 + k, " ".join(words)))
    rows += [(200, texts[0].upper().lower()), (201, texts[1]), (None, texts[2]), (3, texts[3]), (3, prose(40)), (None, prose(30)), (4, texts[4] + " extra")]
    rows += [(300, None), (301, ""), (302, " \n\t "), (303, "too short"), (304, "x " * 50), (305, prose(40).upper()), (306, "#$% " + "a$ " * 30)]
    rows += [(400, items[0][1]), (401, prose(10) + " " + items[1][1] + " " + prose(5)), (402, items[2][1] + " " + prose(600)), (403, items[3][1].upper() + " " + prose(9))]
    token = "".join(rng.choice("0123456789abcdef") for _ in range(40))
    rows += [(500, prose(20) + f' token = "{token}" ' + prose(20)), (501, prose(30) + f" commit {token} " + prose(10))]
    rows += [(600, prose(8000)), (601, "漢字かな交じり文です。 " + prose(30) + " ünï 🙂\nnext line " + prose(9))]
    return rows, items


def tables(spark, path, rows, items):
    extra = lambda df: df.withColumns({c: F.lit(1) for c in CLASH if c not in df.columns})
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).transform(extra)
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").transform(extra).write.parquet(f"{path}/benchmark.parquet")
    return docs


def test_pipeline_against_the_plain_version(spark, tmp_path):
    rows, items = fixture()
    tables(spark, tmp_path, rows, items)
    assert max(len(t or "") for _, t in rows) > sentencepiece_scan.GIANT
    out = corpus_pipeline.run(spark, str(tmp_path))
    got = sorted(((r["doc_id"], r["n_chars"], tuple(r["ids"]), r["round_trip"]) for r in out.collect()), key=str)
    want = plain(rows, [("" if k is None else k, x) for k, x in items], hashes(spark, rows))
    assert got == want
    ids = [g[0] for g in got]
    assert ids.count(3) == 2 and ids.count(None) == 1  # another text under the same id, and under none, stays


def test_stages_keep_the_columns_and_stand_alone(spark, tmp_path):
    rows, items = fixture()
    docs = tables(spark, tmp_path, rows, items)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_duplicates", "decontamination", "secrets", "sentencepiece"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.schema == docs.schema or out.dtypes == docs.dtypes
    cases = {
        "quality": (quality_rules.apply_policy, [r for r in rows if passes(r[1])]),
        "decontamination": (lambda d: decontamination.remove_documents(d, spark.read.parquet(f"{tmp_path}/benchmark.parquet")), [r for r in rows if not brute_hits(r[1], [("" if k is None else k, x) for k, x in items])[3]]),
        "near_duplicates": (near_dedup.keep_one, None),
    }
    for name, (f, want) in cases.items():
        got = [(r["doc_id"], r["text"]) for r in f(docs).collect()]
        want = one_of_each(rows, hashes(spark, rows)) if want is None else want
        assert sorted(got, key=str) == sorted(want, key=str), name


def test_pipeline_of_empty_tables(spark, tmp_path):
    tables(spark, tmp_path, [(1, None)], [(None, None)])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
