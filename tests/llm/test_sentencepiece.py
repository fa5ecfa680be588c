import random

import pytest

from tidemark.llm import sentencepiece_scan as S


@pytest.fixture(scope="module")
def enc():
    return S.encoder(S.MODEL)


def chunked(pieces, s, size, words):
    cuts = list(range(0, len(s), size))
    ctx = 2 * pieces.longest
    parts = [(s[max(0, b - ctx) : b + size], min(b, ctx), b + size >= len(s)) for b in cuts]
    mats = [S.matrix(pieces, *p) for p in parts]
    nodes = S.boundaries(mats)
    assert S.best_exit(S.folded(mats)) == nodes[-1] and nodes == S.boundaries(mats, S.START, S.best_exit(S.folded(mats)))
    got = []
    for (t, b, _), i, j in zip(parts, nodes, nodes[1:]):
        got += S.trace(pieces, t, b, i, j, words)
    return got, mats


def texts():
    rng = random.Random(5)
    bits = ["the", " and", "  ", "tion", "é", "ß", "\n", "漢字", "🙂", "aaaa", "123", "!!", " ", "x", "▁", "ing of", "https://a.b/c?d=e"]
    return ["".join(rng.choice(bits) for _ in range(n)) for n in (60, 200, 700, 900)] + ["a" * 500, "ab" * 300, "漢" * 300, " " * 300]


@pytest.mark.parametrize("size", [70, 97, 256])
def test_chunks_give_the_library_encoding(enc, size):
    words = lambda t: enc.encode([t])[0].tolist()
    for t in texts():
        got, _ = chunked(enc.pieces, S.marked(t), size, words)
        assert got == enc.sp.encode(t)


def test_whole_texts_give_the_library_encoding(enc):
    many = [*texts(), "", " ", "  a  b ", "\n", "a\n b"]
    assert [x.tolist() for x in enc.encode(many)] == [enc.sp.encode(t) for t in many]


def test_matrices_combine_associatively(enc):
    words = lambda t: enc.encode([t])[0].tolist()
    _, mats = chunked(enc.pieces, S.marked(texts()[3]), 100, words)
    key = lambda m: sorted(map(str, m))
    a, b, c = mats[:3]
    assert key(S.combine(S.combine(a, b), c)) == key(S.combine(a, S.combine(b, c)))


def test_unigram_scores_give_the_best_path():
    rng = random.Random(3)
    vocab = {"a", "b", "c", "ab", "bc", "abc", "ca", "cab", "bb"}
    ids = {p: i for i, p in enumerate(sorted(vocab))}
    scores = {p: -rng.random() * (1 + len(p)) for p in ids}
    m = S.Pieces(ids, None, scores)
    for n in (50, 333):
        s = "".join(rng.choice("abc") for _ in range(n))
        best = [0.0] + [None] * n
        for e in range(1, n + 1):
            best[e] = max(best[a] + scores[s[a:e]] for a in range(max(0, e - 3), e) if s[a:e] in scores)
        got, _ = chunked(m, s, 20, None)
        names = {i: p for p, i in ids.items()}
        assert "".join(names[i] for i in got) == s
        assert sum(scores[names[i]] for i in got) == pytest.approx(best[n])


def test_trees_of_every_height_give_the_library_encoding(spark, enc):
    rng = random.Random(7)
    many = [*texts(), "the quick brown fox " * 900, "漢字かな" * 300, " " * 400 + "x" * 400]
    many += ["".join(rng.choice(["word ", "tion", "\n", "é"]) for _ in range(n)) for n in (2000, 6000)]
    rows = [(i % 9, t) for i, t in enumerate(many)] + [(None, many[0]), (3, many[3]), (3, many[3])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    # The model does not tell a space from the mark, so a text with marks does not come back.
    want = sorted(((i, tuple(enc.sp.encode(t)), S.MARK not in t) for i, t in rows), key=str)
    for fan, most in ((2, S.BROADCAST_BYTES), (16, 0)):
        got = S.encode(df, giant=100, chunk=90, fan=fan, max_broadcast=most).collect()
        assert sorted(((r["doc_id"], tuple(r["ids"]), r["round_trip"]) for r in got), key=str) == want


def test_the_query_reads_giant_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    assert docs.where(f"length(text) > {S.GIANT}").count() > 0  # so the scan is part of the query at every size
