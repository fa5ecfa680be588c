"""Secret scanning with a random forest that removes false positives.

Candidates are private keys in PEM armour, web tokens of two or three parts, values of
at least 4 characters after a speaking assignment, passwords in URLs, and all runs of at least 16 token characters, with digits or without.
Features of a candidate and the text around it go through a random forest, which was
trained on labelled findings with Spark ML and is then written out as one SQL
expression, so a scan is a projection: no shuffle, no Python, and the forest is part
of the plan.

Features: length, class transitions, digit and distinct-character shares,
dictionary coverage, path position, known prefixes, and the neighbouring words.  The
neighbourhood is taken from the whole text, other candidates included.  A value with
spaces is a candidate up to its first space only.

The default labelled findings are made by Spark SQL from templates, ``PER_TEMPLATE``
of each; that number bounds the training sample.

Defined results: null and empty texts have no candidates; an empty table gives no
rows.  Rows are scanned one by one; null and repeated ids and repeated rows keep a
result each.  A text of n candidates takes time in proportion to n log n, however
long.  A probability of exactly ``CUT`` is no secret.  Only ``doc_id`` and ``text``
(``n_chars`` too in :func:`redact`, if it is there) are read by name.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import let

TOKEN = r"A-Za-z0-9+/_\-"
_NAMES = "token|secret|passw|pass|pwd|api|key|auth|bearer|credential|private|access"
# The short looks behind come first: they spare the long one nearly everywhere.
_ASSIGNED = rf"(?<=[=:\s\"'`])(?<=[=:]\s{{0,4}}[\"'`]?)(?<=(?i:{_NAMES})[\w\-]{{0,16}}[\"'`]?\s{{0,4}}[=:]\s{{0,4}}[\"'`]?)"
_QUOTED = r"(?<=[\"'`])[^\s\"'`]{4,}+"
_BARE = r"(?<![\"'`])(?:(?!&\w{1,32}=)[^\s\"'`<>,;]){3,}(?!&\w{1,32}=)[^\s\"'`<>,;.:?]"
_IN_URL = r"(?<=:)(?<=://[^\s/:@]{0,64}:)[^\s/@]{4,}+(?=@)"
_RUN = rf"(?<![{TOKEN}])(?=[+/_\-]*+[A-Za-z0-9])[{TOKEN}]{{16,}}+(?:={{1,2}}(?![{TOKEN}=\"'`]))?"
_PEM = r"-----BEGIN (?:[A-Z0-9]{1,16} ){0,3}PRIVATE KEY-----[^\-]*+(?:-----END (?:[A-Z0-9]{1,16} ){0,3}PRIVATE KEY-----)?"
_JWT = rf"(?<![{TOKEN}])eyJ[\w\-]{{8,}}+\.[\w\-]{{4,}}+(?:\.[\w\-]{{4,}}+)?"
CANDIDATE = rf"{_PEM}|{_JWT}|{_IN_URL}|{_ASSIGNED}(?:{_QUOTED}|{_BARE})|{_RUN}"
#: Characters of context; a candidate has ``LEAST`` characters, so ``BEFORE / LEAST`` of them reach over it.
BEFORE, AFTER, LEAST = 48, 16, 4
PER_TEMPLATE = 150
TREES, DEPTH, SEED = 15, 5, 7
CUT = 0.5
#: A text has 2**31 characters at most and a candidate 4.
LEVELS = 29
MASK = "<secret>"

#: Words that ordinary identifiers, paths and titles are made of.
DICTIONARY = (
    "the", "and", "for", "with", "this", "that", "from", "page", "file", "image", "user", "name", "data", "test", "example",
    "version", "document", "title", "report", "index", "item", "list", "value", "number", "http", "html", "www", "com", "org",
    "content", "article", "chapter", "section", "figure", "table", "model", "build", "release", "server", "client", "path",
)
SPEAKS_FOR = r"(?i)(token|secret|passw|pwd|api|key|auth|bearer|credential|private|access)[^\n]{0,16}$"
SPEAKS_AGAINST = r"(?i)(sha\d*|md5|commit|checksum|digest|hash|etag|uuid|guid|isbn|doi|phone|card|iban|account|order|invoice|tracking|session|integrity|base64|public key|fingerprint)\W\W{0,5}[^\n]{0,12}$"
KNOWN = r"\A(?:A[KS]IA[A-Z2-7]{16}\z|gh[oprsu]_|github_pat_|glpat-|xox[abprs]-|[rs]k[_-]|AIza|eyJ|npm_|-----BEGIN)"

FEATURES = (
    "length", "transitions", "digits", "distinct", "dictionary", "hex", "decimal", "path", "assigned", "quoted", "for", "against",
    "known", "url", "reference", "upper", "parts", "named",
)


def features(c: Column, before: Column, after: Column) -> list[Column]:
    """Doubles, in the order of ``FEATURES``."""
    n = F.length(c).cast("double")
    left = lambda pattern: F.length(F.regexp_replace(c, pattern, "")) / n
    flag = lambda x: F.when(x, 1.0).otherwise(0.0)
    runs = F.regexp_replace(c, r"[a-z]+|[A-Z]+|[0-9]+|[^a-zA-Z0-9]+", "x")
    words = F.regexp_replace(F.lower(c), "|".join(sorted(DICTIONARY, key=len, reverse=True)), "")
    return [
        n,
        F.length(runs) / n,
        left("[^0-9]+"),
        F.size(F.array_distinct(F.split(c, ""))) / n,
        1 - F.length(words) / n,
        flag(c.rlike(r"\A(?:[0-9a-f]+|[0-9A-F]+)\z")),
        flag(c.rlike(r"\A[0-9\-]+\z")),
        flag(before.rlike(r"[/.\\:]\z") | (F.length(c) - F.length(F.replace(c, F.lit("/"), F.lit(""))) >= 2)),
        flag(before.rlike(r"[=:]\s*[\"']?\z")),
        flag(before.rlike(r"[\"'`]\z")),
        flag(before.rlike(SPEAKS_FOR)),
        flag(before.rlike(SPEAKS_AGAINST)),
        flag(c.rlike(KNOWN)),
        flag(before.rlike(r"://[^\s/:@]*:\z") & after.startswith("@")),
        flag(c.rlike(r"\A[$%{(\[*]")),
        left("[^A-Z]+"),
        F.length(F.regexp_replace(c, r"[^_/.\-]+", "")) / n,
        flag(after.rlike(r"\A[\"'`]?\s*(?:[=:(]|->)")),
    ]


#: (is a secret, SQL for the text before, SQL for the candidate); ``k`` numbers the finding.
TEMPLATES = (
    (1, "concat(word, ' token = \"')", "sha1(seed)"),
    (1, "concat(word, ' api_key: ')", "substring(base64(unhex(sha2(seed, 256))), 1, 24 + k % 18)"),
    (1, "concat('aws_access_key_id = ', '')", "concat('AKIA', substring(upper(base64(unhex(md5(seed)))), 1, 15), k % 10)"),
    (1, "concat(word, ' use ')", "concat('ghp_', substring(translate(base64(unhex(sha2(seed, 256))), '+/', 'ab'), 1, 35), k % 10)"),
    (1, "concat(word, ' password=\\'')", "concat(substring(md5(seed), 1, 9), upper(substring(sha1(seed), 3, 9)), k % 7)"),
    (1, "'Authorization: Bearer '", "substring(base64(unhex(sha2(seed, 384))), 1, 30 + k % 20)"),
    (0, "concat('commit ', '')", "sha1(seed)"),
    (0, "concat(word, if(k % 2 = 0, ' md5: ', ' checksum '))", "md5(seed)"),
    (0, "concat('see https://', word, '.org/item/')", "concat_ws('-', substring(md5(seed), 1, 8), substring(md5(seed), 9, 4), substring(md5(seed), 13, 12))"),
    (0, "concat(word, ' ')", "lpad(conv(substring(md5(seed), 1, 13), 16, 10), 16, '4')"),
    (0, "concat('card number: ', '')", "lpad(conv(substring(md5(seed), 1, 13), 16, 10), 16, '5')"),
    (0, "concat(word, ' ')", "concat('get', initcap(word), 'FromPage', k % 10, 'ForUser')"),
    (0, "concat('open /', word, '/')", "concat('2024/0', k % 9 + 1, '/the-', word, '-report-', word)"),
    (0, "concat(word, ' = ')", "concat(repeat(substring(word, 1, 1), 14), k % 100, 'xx')"),
    (0, "concat(word, ' ')", "concat(word, word, word, word, word, k % 10)"),
    (0, "concat(word, ' tel ')", "concat('0049-', lpad(k * 7919 % 1000, 3, '0'), '-', lpad(k * 104729 % 1000000, 8, '3'))"),
    # Short values, and runs without a forced digit or with none.
    (1, "concat(word, if(k % 2 = 0, ' password = \"', ' pwd=\"'))", "substring(translate(base64(unhex(md5(seed))), '+/=', '&!$'), 1, 7 + k % 9)"),
    (1, "concat(word, if(k % 2 = 0, ' password: ', ' secret='))", "concat(word, k % 97, substring(md5(seed), 1, 3 + k % 5))"),
    (1, "concat(word, if(k % 2 = 0, ' key id ', ' aws_access_key_id = '))", "concat('AKIA', substring(translate(upper(base64(unhex(sha2(seed, 256)))), '+/0189', 'QWERTZ'), 1, 16))"),
    (1, "concat(word, if(k % 2 = 0, ' ', ' key id '))", "concat('AKIA', substring(translate(upper(base64(unhex(sha2(seed, 256)))), '+/0123456789', 'QWERTZUIOPAS'), 1, 16))"),
    (1, "concat(word, if(k % 2 = 0, ' use ', ' token: '))", "concat('ghp_', substring(translate(base64(unhex(sha2(seed, 256))), '+/0123456789', 'abQwErTzUiOp'), 1, 36))"),
    (1, "concat(word, if(k % 2 = 0, ' api_key: ', ' secret = \"'))", "substring(translate(base64(unhex(sha2(seed, 256))), '+/0123456789', 'abQwErTzUiOp'), 1, 16 + k % 24)"),
    (1, "concat(word, ' use ')", "substring(translate(base64(unhex(sha2(seed, 256))), '0123456789', 'QwErTzUiOp'), 1, 24 + k % 18)"),
    (1, "concat(word, if(k % 2 = 0, ' password: ', ' PASSWORD='))", "concat(word, if(k % 3 = 0, k % 10, k % 100))"),
    (1, "concat(word, if(k % 2 = 0, '\n', ' key:\n'))", "concat('-----BEGIN ', if(k % 3 = 0, 'RSA ', ''), 'PRIVATE KEY-----\n', base64(unhex(sha2(seed, 512))), '\n', base64(unhex(sha2(word, 512))), '\n-----END ', if(k % 3 = 0, 'RSA ', ''), 'PRIVATE KEY-----')"),
    (1, "concat(word, if(k % 2 = 0, ' ', ' cookie: '))", "concat('eyJ', substring(translate(base64(unhex(sha2(seed, 256))), '+/=', 'ab'), 1, 20 + k % 15), '.eyJ', substring(translate(base64(unhex(sha2(seed, 512))), '+/=', '_-'), 1, 30 + k % 40), '.', substring(translate(base64(unhex(sha2(word, 512))), '+/=', '_-'), 1, 43))"),
    (1, "concat(word, if(k % 2 = 0, ' ', '='))", "concat_ws('-', if(k % 3 = 0, 'xoxb', 'xoxp'), lpad(k * 7919 % 1000000, 12, '3'), lpad(k * 104729 % 1000000, 12, '7'), substring(translate(base64(unhex(sha2(seed, 256))), '+/=', 'ab'), 1, 24))"),
    (1, "concat(word, if(k % 2 = 0, ' ', ' KEY='))", "concat(if(k % 3 = 0, 'sk_live_', if(k % 3 = 1, 'glpat-', 'npm_')), substring(translate(base64(unhex(sha2(seed, 256))), '+/=', 'ab'), 1, 20 + k % 16))"),
    (0, "concat(if(k % 2 = 0, 'integrity=\"', 'integrity: '), '')", "concat(if(k % 3 = 0, 'sha512-', 'sha384-'), base64(unhex(sha2(seed, 512))))"),
    (0, "concat('data:image/', word, ';base64,')", "substring(concat(base64(unhex(sha2(seed, 512))), base64(unhex(sha2(word, 512)))), 1, 40 + k % 100)"),
    (0, "concat('-----BEGIN ', if(k % 2 = 0, '', 'RSA '), 'PUBLIC KEY-----\n')", "substring(base64(unhex(sha2(seed, 512))), 1, 64)"),
    (0, "concat(word, if(k % 2 = 0, ' password: ', ' key = '))", "if(k % 3 = 0, word, concat(word, substring('sedlying', 1, k % 9)))"),
    (0, "if(k % 2 = 0, 'Authorization: ', 'the key: ')", "if(k % 4 = 0, 'Bearer', initcap(word))"),
    (0, "concat(word, if(k % 2 = 0, ' password = \"', ' token: '))", "concat(if(k % 3 = 0, '${', '$('), upper(word), if(k % 5 = 0, '_PASSWORD', '_TOKEN'), '}')"),
    (0, "concat(word, if(k % 2 = 0, ' key: ', ' access: '))", "concat(2000 + k % 30, if(k % 3 = 0, '', concat('-', lpad(k % 12 + 1, 2, '0'))))"),
    (0, "concat(word, ' ')", "concat('get', initcap(word), 'FromPage', if(k % 2 = 0, 'ForUser', 'AndThisItem'))"),
    (0, "concat(word, ' ')", "concat_ws(if(k % 3 = 0, '_', '-'), word, 'and', 'the', word, substring('sedlying', 1, k % 9))"),
    (0, "concat('the ', '')", "concat(if(k % 2 = 0, initcap(word), word), word, word, substring('schaftlichenlung', 1, 4 + k % 13))"),
    (0, "concat(word, '/')", "concat_ws('/', word, 'path', initcap(word), concat('the', word))"),
    (0, "concat(word, ' ')", "concat(if(k % 2 = 0, 'AWS_SECRET_', 'MAX_VALUE_OF_'), upper(word), '_KEY', if(k % 3 = 0, '_ID', '_NAME'))"),
)
#: The same with SQL for the text after the candidate, where that tells it.
PLACED = (
    (1, "concat(if(k % 2 = 0, 'postgres://', 'https://'), word, ':')", "substring(translate(base64(unhex(md5(seed))), '+/=', 'a!$'), 1, 6 + k % 12)", "'@db/prod'"),
    (1, "concat('amqp://', word, ':')", "concat(word, k % 97)", "'@queue.example.org'"),
    (0, "concat('postgres://', word, ':')", "concat('${', upper(word), '_PASSWORD}')", "'@db/prod'"),
    (0, "concat(word, ' ')", "concat(if(k % 2 = 0, 'aws_secret_access_', 'MY_PRIVATE_TOKEN_OF_'), if(k % 3 = 0, word, upper(word)))", "if(k % 2 = 0, ' = \"', '=')"),
)
_WORDS = "page,image,report,value,section,model,release,chapter,lemon,river,stone,garden"


def labelled_findings(spark: SparkSession, per_template: int = PER_TEMPLATE, templates=TEMPLATES) -> DataFrame:
    """``label, before, candidate, after``."""
    words = "array(" + ",".join(f"'{w}'" for w in _WORDS.split(",")) + ")"
    base = spark.range(per_template).selectExpr("cast(id AS int) AS k", f"{words}[cast(id % {len(_WORDS.split(','))} AS int)] AS word")
    out = None
    for i, (label, before, candidate, *after) in enumerate(templates):
        rows = base.withColumn("seed", F.concat(F.lit(f"{i}-"), "k")).selectExpr(
            f"{label} AS label", f"{before} AS before", f"cast({candidate} AS string) AS candidate", f"{(after or ['cast(null as string)'])[0]} AS after"
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def train(findings: DataFrame) -> list:
    """A forest as nested tuples: ``(feature, threshold, left, right)``, or a leaf's probability."""
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler

    cols = [f.alias(n) for n, f in zip(FEATURES, features(F.col("candidate"), F.col("before"), F.coalesce("after", F.lit(" after"))), strict=True)]
    rows = findings.select(F.col("label").cast("double").alias("label"), *cols)
    rows = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(rows).select("label", "features")
    model = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="onethird").fit(rows.coalesce(1))

    def nested(node):
        if node.getClass().getSimpleName() == "LeafNode":
            stats = list(node.impurityStats().stats())
            return round(stats[1] / sum(stats), 6)
        split = node.split()
        return (split.featureIndex(), split.threshold(), nested(node.leftChild()), nested(node.rightChild()))

    return [nested(t._call_java("rootNode")) for t in model.trees]


@lru_cache(maxsize=1)
def _default_forest() -> list:
    return train(labelled_findings(SparkSession.getActiveSession(), templates=TEMPLATES + PLACED))


def probability(forest: list, x: Column) -> Column:
    """The forest over a struct of features, as one expression."""

    def branch(node) -> Column:
        if not isinstance(node, tuple):
            return F.lit(float(node))
        f, t, left, right = node
        return F.when(x[FEATURES[f]] <= F.lit(float(t)), branch(left)).otherwise(branch(right))

    total = branch(forest[0])
    for tree in forest[1:]:
        total = total + branch(tree)
    return total / F.lit(float(len(forest)))


def _scan(text: Column, forest: list) -> Column:
    """A struct: the gaps between candidates, and the candidates with their probability."""
    text = F.coalesce(text, F.lit(""))
    found = F.regexp_extract_all(text, F.lit(CANDIDATE), F.lit(0))
    gaps = F.split(text, CANDIDATE, -1)

    def judged(c: Column, before: Column, after: Column) -> Column:
        x = F.struct(*[v.alias(n) for n, v in zip(FEATURES, features(c, before, after), strict=True)])
        return F.struct(c.alias("c"), let(x, lambda s: probability(forest, s)).alias("p"))

    def both(g: Column, f: Column) -> Column:
        pieces = F.zip_with(g, f, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
        ends = F.transform(pieces, lambda x: F.struct(F.substring(x, -BEFORE, BEFORE).alias("last"), F.substring(x, 1, AFTER).alias("first")))

        def around(e: Column, c: Column, i: Column) -> Column:
            n = F.least(i, F.lit(BEFORE // LEAST))
            before = F.concat(F.array_join(F.slice(e["last"], i - n + 1, n), ""), F.get(g, i))
            after = F.array_join(F.slice(e["first"], i + 2, F.lit(AFTER // LEAST)), "")
            x = F.struct(F.substring(before, -BEFORE, BEFORE).alias("b"), F.substring(after, 1, AFTER).alias("a"))
            return let(x, lambda y: judged(c, y["b"], y["a"]))

        items = let(ends, lambda e: F.transform(f, lambda c, i: around(e, c, i)))
        return F.struct(g.alias("gaps"), items.alias("items"))

    return let(gaps, lambda g: let(found, lambda f: both(g, f)))


def _doubled(k: int):
    def step(v: Column) -> Column:
        return F.when(F.size(v) > k, F.transform(v, lambda x, i: x + F.when(i >= k, F.get(v, i - k)).otherwise(F.lit(0)))).otherwise(v)

    return step


def _sums(values: Column) -> Column:
    """Running sums of an array of up to 2**LEVELS numbers, by doubling: n log n steps."""
    for level in range(LEVELS):
        values = let(values, _doubled(1 << level))
    return values


def findings(docs: DataFrame, forest: list | None = None, cut: float = CUT) -> DataFrame:
    """Every candidate: ``doc_id, ordinal, start`` and ``length`` in characters, ``fingerprint, probability, is_secret``."""
    forest = forest or _default_forest()

    def placed(s: Column) -> Column:
        steps = F.transform(s["items"], lambda x, i: F.length(F.get(s["gaps"], i)) + F.length(x["c"]))
        return F.zip_with(s["items"], _sums(steps), lambda x, z: F.struct(x["c"].alias("c"), x["p"].alias("p"), (z - F.length(x["c"])).alias("start")))

    one = docs.select("doc_id", F.posexplode_outer(let(_scan(F.col("text"), forest), placed)).alias("i", "x")).where("i IS NOT NULL")
    return one.select(
        "doc_id",
        F.col("i").alias("ordinal"),
        F.col("x.start").cast("long").alias("start"),
        F.length("x.c").cast("long").alias("length"),
        F.sha2("x.c", 256).alias("fingerprint"),
        F.round("x.p", 6).alias("probability"),
        (F.col("x.p") > cut).alias("is_secret"),
    )


def redact(docs: DataFrame, forest: list | None = None, cut: float = CUT) -> DataFrame:
    """``docs`` with each secret replaced by ``MASK``, and ``n_chars`` brought up to date; columns unchanged."""
    forest = forest or _default_forest()

    def rebuilt(s: Column) -> Column:
        kept = lambda i: F.get(s["items"], i)
        item = lambda i: F.when(kept(i)["p"] > cut, F.lit(MASK)).otherwise(F.coalesce(kept(i)["c"], F.lit("")))
        return F.array_join(F.transform(s["gaps"], lambda g, i: F.concat(g, item(i))), "")

    hit = lambda s: F.exists(s["items"], lambda x: x["p"] > cut)
    new = let(_scan(F.col("text"), forest), lambda s: F.when(hit(s), rebuilt(s)))
    out = docs.withColumn("_tm_new", new)
    text = F.coalesce("_tm_new", docs["text"])
    columns = {"text": text, "n_chars": F.when(F.col("_tm_new").isNull(), docs["n_chars"]).otherwise(F.length("_tm_new")) if "n_chars" in docs.columns else None}
    return out.select(*[(columns[c].cast(docs.schema[c].dataType).alias(c) if c in columns else docs[c]) for c in docs.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op7 over ``documents``."""
    return findings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
