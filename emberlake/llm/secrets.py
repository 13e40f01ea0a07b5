"""Secret scanning with a random forest that removes false findings; DataFrame operations and Spark ML only.

Candidates are private key blocks, values of at least ``MIN_VALUE`` signs assigned to names such as password or
token, and runs of at least 16 letters, digits and ``+/_=-`` with a digit. A forest judges each from its length, its
mix of signs and their transitions (entropy, changes of class, probability of its letter pairs under the corpus
dictionary), the share of it that dictionary words cover, the path of the document and the words before and after.

It is trained on labelled findings: given ones, or ``fixtures``, findings whose label is known because they were
made: keys, passwords and tokens on one side, and on the other what looks like them (placeholders, references,
identifiers, digests, card numbers, dates) in the same kinds of places, spelled with the corpus's own common words.
No rule stands between the forest and the result, but that given findings cannot unlearn a published format.
``published_labels`` is the rule that the forest is measured against.

Each place of a value in a document is judged by the text around it, and the greatest probability holds for all.
A place is wherever the value stands, inside other words too; what overlaps a key block belongs to the block. Values hold no blanks, quotes, commas or semicolons
(key blocks apart), so they are looked up in the words of the document: all windows of a word that are as long as the
end of a value are joined to the ends of the values, and the rest is compared.

Scale: all texts are read twice, once for candidates and once for the dictionary, whose words are counted in
each task before they are shuffled. Few documents have candidates; only their texts are read again, and the work on
one is in proportion to its length, times the number of different lengths (up to ``END``) of its values. What is
computed for a value is computed once, and places of a document with the same text around them are judged once. Training
takes at most ``MAX_TRAIN`` findings, those with the least hash. 200 common words reach the driver.

Defined results: null and empty texts have no findings; repeated rows have equal findings; a null id stays
null; a null path is the empty path; in an empty table nothing is found; if given findings lack one of the labels
there is no forest, and only published formats are secrets; texts and values of any length are scanned whole.
Assigned values of fewer than ``MIN_VALUE`` signs, and runs of fewer than 16 that nothing names, are no candidates.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberlake.llm.common import fresh, materialize

_NAME = r"(?i:passwd|password|pwd|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|auth|credentials?)"
_ASSIGN = _NAME + r"""["']?\s{0,8}[:=]\s{0,8}["']?"""
_BLOCK_HEAD = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"
_BLOCK = _BLOCK_HEAD + r"[\s\S]*?-----END [A-Z ]{0,40}PRIVATE KEY-----"
#: A sign of a value: a key block begins no value, and ends one. Repeated possessively, as the engine takes that
#: in a loop, however long a value is, and anything else on its stack.
_SIGN = rf"""(?:(?!{_BLOCK_HEAD})[^\s"',;])"""
_RUN = rf"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z+/_=-]*[0-9])(?:(?!{_BLOCK_HEAD})[A-Za-z0-9+/_=-]){{16,}}+"
#: What ends a sentence or a bracket is no part of a value.
_TAIL = r"[.)\]}>!?:]+$"
MIN_VALUE = 4
CANDIDATE = rf"{_BLOCK}|{_ASSIGN}{_SIGN}{{{MIN_VALUE},}}+|{_RUN}"
#: Signs of the end of a value that it is looked up by, and of a piece of a word that windows are taken from.
END, PIECE = 32, 4096
#: Signs before and after a value that are looked at.
BEFORE, AFTER = 59, 40
#: Published formats of credentials: fixed values.
KNOWN = r"^(AKIA|ASIA)[0-9A-Z]{16}$|^gh[pousr]_[0-9A-Za-z]{36,}$|^xox[abprs]-[0-9A-Za-z-]{10,}$|^AIza[0-9A-Za-z_-]{35}$|^-----BEGIN "
MIN_WORD_COUNT = 5
MAX_TRAIN = 20_000
FIXTURES = 9000
COMMON_WORDS = 200
TREES, DEPTH = 30, 8
THRESHOLD = 0.5
MASK = "[SECRET]"

FEATURES = [
    "size", "digits", "uppers", "lowers", "signs", "changes", "entropy", "pairs",
    "coverage", "path_depth", "path_test", "path_bucket", "named", "assigned", "quoted", "before_bucket", "after_bucket",
]


def _bucket(column: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("double")


def _words(docs: DataFrame) -> DataFrame:
    """(doc, start, word, before, after, ends): the words of each text of (doc, text, least, ends) that are long
    enough to hold a value, in document order; a word is a key block or a run of a value's signs."""
    pattern = F.concat(F.lit(f"{_BLOCK}|{_SIGN}{{"), F.col("least").cast("string"), F.lit(",}+"))
    cut = docs.select(
        "doc", "ends", F.regexp_extract_all("text", pattern, F.lit(0)).alias("words"), F.split("text", pattern, -1).alias("gaps")
    )
    # gap, word, gap, word, ..., gap. Nothing beyond BEFORE and AFTER signs is looked at, and a word has at least
    # MIN_VALUE signs, so few neighbours of a word are.
    pieces = F.concat(
        F.flatten(F.zip_with(F.slice("gaps", 1, F.size("words")), "words", lambda g, w: F.array(g, w))),
        F.slice("gaps", -1, 1),
    )
    cut = cut.filter(F.size("words") > 0).withColumns(
        {"tails": F.transform(pieces, lambda p: F.right(p, F.lit(BEFORE))), "heads": F.transform(pieces, lambda p: F.left(p, F.lit(AFTER)))}
    )

    def word(i: Column) -> Column:
        first = F.greatest(F.lit(1), 2 * i - 2 * (BEFORE // MIN_VALUE) - 1)
        before = F.right(F.array_join(F.slice("tails", first, 2 * i - first), ""), F.lit(BEFORE))
        after = F.left(F.array_join(F.slice("heads", 2 * i + 1, 2 * (AFTER // MIN_VALUE) + 2), ""), F.lit(AFTER))
        gap = F.length(F.element_at("gaps", i))
        return F.struct(i.alias("at"), F.element_at("words", i).alias("word"), gap.alias("gap"), before.alias("before"), after.alias("after"))

    each = cut.select("doc", "ends", F.inline(F.transform(F.sequence(F.lit(1), F.size("words")), word)))
    to_end = F.sum(F.col("gap") + F.length("word")).over(Window.partitionBy("doc").orderBy("at"))
    return each.select("doc", (to_end - F.length("word")).cast("int").alias("start"), "word", "before", "after", "ends")


def _windows(words: DataFrame) -> DataFrame:
    """(doc, first, at, end): where each window of each of (doc, first, word, ends) stands in it, for the
    window lengths ``ends``. Long words are cut in pieces that overlap, so that no array grows with a word."""
    parts = F.regexp_extract_all("word", F.lit(rf"[\s\S]{{1,{PIECE}}}"), F.lit(0))
    cut = words.select("doc", "first", "ends", parts.alias("parts"))

    def piece(i: Column) -> Column:
        more = F.left(F.coalesce(F.get("parts", i + 1), F.lit("")), F.lit(END - 1))
        return F.struct((i * PIECE).alias("base"), F.concat(F.get("parts", i), more).alias("piece"))

    pieces = cut.select("doc", "first", "ends", F.inline(F.transform(F.sequence(F.lit(0), F.size("parts") - 1), piece)))
    sized = pieces.select("doc", "first", "base", "piece", F.explode("ends").alias("size")).filter(F.length("piece") >= F.col("size"))
    # One match of no width at each code point, with the window ahead of it.
    pattern = F.concat(F.lit(r"(?![\uDC00-\uDFFF])(?=([\s\S]{"), F.col("size").cast("string"), F.lit("}))"))
    all_windows = sized.select("doc", "first", "base", "size", F.posexplode(F.regexp_extract_all("piece", pattern, F.lit(1))).alias("j", "end"))
    # What begins in the overlap belongs to the next piece.
    return all_windows.filter(F.col("j") < PIECE).select("doc", "first", (F.col("base") + F.col("j") + F.col("size")).alias("to"), "end")


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc, word, value, start, before, after): every place of each of the values of (doc, text, values)."""
    sizes = F.transform("values", lambda v: F.least(F.length(v), F.lit(END)))
    least = F.array_min(F.transform("values", F.length))
    words = materialize(_words(docs.select("doc", "text", least.alias("least"), F.array_distinct(sizes).alias("ends"))))
    distinct = materialize(words.groupBy("doc", "word").agg(F.min("start").alias("first"), F.first("ends").alias("ends")))
    values = docs.select("doc", F.explode("values").alias("value"))
    values = values.withColumn("end", F.right("value", F.lit(END)))
    ending = _windows(distinct).join(values, ["doc", "end"]).select("doc", "first", "value", (F.col("to") - F.length("value")).alias("at"))
    held = ending.filter("at >= 0").join(distinct.select("doc", "first", "word"), ["doc", "first"])
    held = held.filter(F.substring("word", F.col("at") + 1, F.length("value")) == F.col("value"))
    placed = held.select("doc", "word", "value", "at").join(words.drop("ends"), ["doc", "word"])
    after = F.substring("word", F.col("at") + F.length("value") + 1, F.lit(AFTER))
    return placed.select(
        "doc",
        "word",
        "value",
        (F.col("start") + F.col("at")).alias("start"),
        F.right(F.concat("before", F.left("word", F.col("at"))), F.lit(BEFORE)).alias("before"),
        F.left(F.concat(after, "after"), F.lit(AFTER)).alias("after"),
    )


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str | None = "source") -> DataFrame:
    """(finding, id, path, value, starts, contexts): a document's distinct candidate values, with their
    places (code points from 0) and the distinct (before, after) of the text around them."""
    path = F.coalesce(F.col(path_col).cast("string"), F.lit("")) if path_col else F.lit("")
    matches = F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    values = F.array_distinct(
        F.transform(matches, lambda m: F.regexp_replace(F.regexp_replace(m, "^" + _ASSIGN, ""), _TAIL, ""))
    )
    rows = docs.select(F.col(id_col).alias("id"), path.alias("path"), F.col(text_col).alias("text"))
    rows = rows.select("*", F.filter(values, lambda v: F.length(v) >= MIN_VALUE).alias("values")).filter(F.size("values") > 0)
    # The texts of documents with candidates; written, so that their numbers stay.
    held = materialize(rows.select(F.monotonically_increasing_id().alias("doc"), "*"))
    found = materialize(occurrences(held.select("doc", "text", "values")))
    each = found.groupBy("doc", "value").agg(
        F.sort_array(F.collect_set("start")).alias("starts"), F.collect_set(F.struct("before", "after")).alias("contexts")
    )
    return materialize(
        each.join(held.select("doc", "id", "path"), "doc").select(
            F.monotonically_increasing_id().alias("finding"), "id", "path", "value", "starts", "contexts"
        )
    )


def dictionary(docs: DataFrame, text_col: str = "text", min_count: int = MIN_WORD_COUNT) -> DataFrame:
    """(word, n): lower-case letter runs of 3 to 20 letters, as often as they stand in all texts."""
    words = docs.select(F.explode(F.split(F.lower(F.col(text_col)), r"[^\p{L}]+")).alias("word"))
    words = words.filter(F.length("word").between(3, 20))
    return materialize(words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= min_count))


def common_words(words: DataFrame, n: int = COMMON_WORDS) -> list[str]:
    """The commonest words of a dictionary; some plain ones where there are none."""
    found = [r["word"] for r in words.orderBy(F.desc("n"), "word").limit(n).collect()]
    return found or ["river", "harbour", "report", "people", "number", "open", "small", "green"]


def value_features(values: DataFrame, words: DataFrame) -> DataFrame:
    """What is computed from a distinct value alone."""
    value = F.col("value")
    size = F.length(value).cast("double")

    def share(pattern: str) -> Column:
        return F.length(F.regexp_replace(value, pattern, "")) / size

    kinds = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(value, r"\p{Ll}", "a"), r"\p{Lu}", "b"), "[0-9]", "c"), "[^abc]", "d")
    signs = F.split(value, "")
    counted = F.transform(F.array_distinct(signs), lambda c: F.length(value) - F.length(F.replace(value, c, F.lit(""))))
    entropy = F.aggregate(counted, F.lit(0.0), lambda a, n: a - (n / size) * F.log2(n / size))
    base = values.select(
        "value",
        size.alias("size"),
        share("[^0-9]").alias("digits"),
        share(r"[^\p{Lu}]").alias("uppers"),
        share(r"[^\p{Ll}]").alias("lowers"),
        share(r"[\p{L}0-9]").alias("signs"),
        ((F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1) / size).alias("changes"),
        entropy.alias("entropy"),
    )
    # Letter pairs as likely as in the dictionary's words; a pair it lacks counts as one in a million.
    spelled = words.select("n", F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2)))).alias("pair"))
    pairs = materialize(spelled.groupBy("pair").agg(F.sum("n").alias("n")))
    total = pairs.agg(F.sum("n")).first()[0] or 1
    own = values.select("value", F.explode(F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.lower(F.substring("value", i, F.lit(2))))).alias("pair"))
    likely = own.join(pairs, "pair", "left").groupBy("value").agg(F.avg(F.log10(F.coalesce(F.col("n") / total, F.lit(1e-6)))).alias("pairs"))
    parts = values.select("value", F.explode(F.split(F.lower("value"), r"[^\p{L}]+")).alias("word")).filter(F.length("word") >= 3)
    covered = parts.join(words, "word").groupBy("value").agg(F.sum(F.length("word")).alias("covered"))
    return base.join(likely, "value", "left").join(covered, "value", "left").select(
        *base.columns, F.coalesce("pairs", F.lit(-6.0)).alias("pairs"), (F.coalesce("covered", F.lit(0)) / F.col("size")).alias("coverage")
    )


def with_features(found: DataFrame, words: DataFrame) -> DataFrame:
    values = value_features(materialize(found.select("value").distinct()), words)
    before = F.col("before")
    context = found.select(
        "*",
        F.size(F.split("path", "[/.]")).cast("double").alias("path_depth"),
        F.col("path").rlike("(?i)test|example|sample|doc|fixture|mock").cast("double").alias("path_test"),
        _bucket(F.col("path"), 16).alias("path_bucket"),
        before.rlike(_NAME).cast("double").alias("named"),
        before.rlike(_ASSIGN + "$").cast("double").alias("assigned"),
        before.rlike("""["']$""").cast("double").alias("quoted"),
        _bucket(F.lower(F.regexp_extract(before, r"(\p{L}+)\P{L}*$", 1)), 32).alias("before_bucket"),
        _bucket(F.lower(F.regexp_extract("after", r"(\p{L}+)", 1)), 32).alias("after_bucket"),
    )
    return context.join(values, "value")


def published_labels(found: DataFrame) -> Column:
    """1.0 for values of a published format and for random-looking values assigned to a secret's name;
    0.0 for numbers, dictionary words and plain runs that nothing names; null for what is in between."""
    mixed = (F.col("digits") > 0) & (F.col("digits") < 1)
    sure = F.col("value").rlike(KNOWN) | ((F.col("assigned") == 1) & mixed & (F.col("coverage") < 0.5))
    not_secret = (F.col("named") == 0) & ((F.col("digits") == 1) | (F.col("coverage") >= 0.5))
    return F.when(sure, 1.0).when(not_secret, 0.0)


def fixtures(spark: SparkSession, common: list[str], n: int = FIXTURES) -> DataFrame:
    """(path, value, before, after, label): labelled findings, ``n`` of them, every kind equally often. They
    are drawn by hash, so they are the same each time for the same ``common`` words."""

    def number(salt: str, below: int) -> Column:
        return F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(below)).cast("int")

    def one(options: list, salt: str) -> Column:
        return F.element_at(F.array(*(x if isinstance(x, Column) else F.lit(x) for x in options)), number(salt, len(options)) + 1)

    def join(*parts: Column | str) -> Column:
        return F.concat(*(F.lit(p) if isinstance(p, str) else p for p in parts))

    def size(least: int, most: int, salt: str) -> Column:
        return F.lit(least) + number(salt, most - least + 1)

    def digest(salt: str) -> Column:
        return F.sha2(join(F.col("id").cast("string"), salt), 512)

    names = [
        "password", "passwd", "pwd", "secret", "client_secret", "token", "access_token", "api_key", "apikey",
        "access-key", "private_key", "auth", "credentials", "TOKEN", "PASSWORD", "API_KEY", "Secret", "authToken",
    ]
    marks = [' = "', '="', ": ", "=", "': '", '": "', " = ", ":"]
    cues = ["commit ", "revision ", "sha256 ", "sha1: ", "md5 ", "checksum ", "etag=", "build ", "id ", "digest "]
    paths = ["", "src0", "web", "crawl/page", "repo/src/main.py", "conf/app.yml", "notes.txt", "tests/unit.py", "docs/example.md"]
    # What findings are made of: random signs of several alphabets, words, and the text around.
    raw = spark.range(n).select(
        "id",
        digest("hex").alias("hex"),
        F.translate(digest("digits"), "abcdef", "").alias("digits"),
        F.base64(F.unhex(digest("base"))).alias("base"),
        *(one(common, f"word {w}").alias(w) for w in "abcdefgh"),
        join(one(names, "name"), one(marks, "mark")).alias("assign"),
        F.upper(one(names, "own")).alias("own"),
        one(paths, "path").alias("path"),
        one(['" ', "' ", " ", "\n", "", ") "], "close").alias("close"),
        one([" ", ", ", ". ", "\n"], "stop").alias("stop"),
    )
    parts = raw.select(
        "*",
        F.translate("base", "+/=", "wXz").alias("mixed"),
        F.translate(F.substring("base", 20, 60), "+/=", "wXz").alias("more"),
        join(F.col("a"), " ", F.col("b"), F.col("stop"), F.col("c")).alias("prose"),
        F.lower("d").alias("x"),
        F.lower("e").alias("y"),
        F.upper("d").alias("U"),
    )
    col = F.col
    some = F.left(col("digits"), size(1, 3, "some"))
    formats = one(
        [
            join(one(["AKIA", "ASIA"], "aws"), F.upper(F.left("more", F.lit(16)))),
            join(one(["ghp_", "gho_", "ghs_"], "hub"), F.left("mixed", F.lit(36))),
            join("AIza", F.left("mixed", F.lit(35))),
            join(one(["xoxb-", "xoxp-"], "chat"), F.left("digits", F.lit(11)), "-", F.left("mixed", F.lit(24))),
        ],
        "format",
    )
    placeholder = one(
        [
            join("your_", col("x"), "_here_", some),
            join("${", col("U"), "_", F.upper("e"), some, "}"),
            join(one(["${", "$", "%{", "{{"], "open"), col("U"), "_", col("own"), some),
            join("<", col("x"), "-", col("y"), "-", some, ">"),
            join(F.repeat(one(["x", "X", "*", "0"], "fill"), F.lit(12)), some),
            join("changeme", some),
            join("example-", col("x"), "-", some),
            join("os.environ[", col("x"), some, "]"),
            join("get_", col("x"), "_", col("y"), "(", some, ")"),
        ],
        "placeholder",
    )
    named = join(col("x"), one(["_", "-", "/", "."], "glue"), col("y"), one(["_", "-", "/", "="], "glue2"), F.left("digits", size(1, 6, "named")))
    block = join("-----BEGIN ", one(["RSA ", "EC ", ""], "kind"), "PRIVATE KEY-----\n", col("base"), "\n-----END PRIVATE KEY-----")
    uuid = F.regexp_replace(F.left("hex", F.lit(32)), "^(.{8})(.{4})(.{4})(.{4})(.{12})$", "$1-$2-$3-$4-$5")
    plain = one([F.left("digits", size(4, 16, "number")), join("20", F.left("digits", F.lit(6))), col("g")], "plain")
    keys = [F.left("hex", one([20, 32, 40, 64], "hex size")), F.left("mixed", size(12, 44, "key")), F.left("base", size(22, 60, "base"))]
    word_sign = join(F.left("mixed", size(4, 8, "pass")), one(["!", "$", "#", "@", "%", "-", "_"], "sign"), F.left("digits", size(2, 5, "tail")))
    assigned = join(col("prose"), " ", col("assign"))
    bare = join(col("prose"), one([" ", " ", "\n", ": ", " ("], "bare"))
    bearer = join(col("prose"), one([" Bearer ", " bearer ", " key ", " api key "], "bearer"))
    kinds: list[tuple[float, Column, Column]] = [
        (1.0, assigned, keys[0]),
        (1.0, assigned, keys[1]),
        (1.0, assigned, keys[2]),
        (1.0, assigned, word_sign),
        (1.0, assigned, formats),
        (1.0, bare, formats),
        (1.0, bearer, F.left("mixed", size(24, 48, "bearer"))),
        (1.0, one([" ", "\n", " key = "], "place"), block),
        (0.0, bare, F.left("digits", size(16, 20, "card"))),
        (0.0, join(col("prose"), " ", one(cues, "cue")), F.left("hex", one([32, 40, 64], "digest"))),
        (0.0, bare, F.left("hex", one([20, 32, 40, 64], "bare hex"))),
        (0.0, join(col("prose"), one([" ", " id=", " user "], "uuid")), uuid),
        (0.0, bare, join(named, "-", col("f"), F.left("digits", size(2, 4, "tail 2")))),
        (0.0, assigned, placeholder),
        (0.0, assigned, placeholder),
        (0.0, assigned, placeholder),
        (0.0, assigned, named),
        (0.0, assigned, plain),
    ]
    kind = F.col("id") % len(kinds)

    def chosen(i: int) -> Column:
        out = F.lit(None)
        for k, made in reversed(list(enumerate(kinds))):
            out = F.when(kind == k, made[i]).otherwise(out)
        return out

    made = parts.select(
        "path",
        F.regexp_replace(chosen(2), _TAIL, "").alias("value"),
        F.right(chosen(1), F.lit(BEFORE)).alias("before"),
        F.left(join(col("close"), col("g"), " ", col("h")), F.lit(AFTER)).alias("after"),
        F.when(kind.isin([k for k, x in enumerate(kinds) if x[0]]), 1.0).otherwise(0.0).alias("label"),
    )
    return materialize(made)


def train_forest(labelled: DataFrame, trees: int = TREES, depth: int = DEPTH, max_train: int = MAX_TRAIN) -> PipelineModel | None:
    """The forest, from findings with features and ``label``; none if they lack one of the labels."""
    usable = labelled.filter(F.col("label").isNotNull()).select("value", "label", *FEATURES)
    picked = materialize(usable.orderBy(F.xxhash64("value", *FEATURES)).limit(max_train))
    kinds = picked.agg(F.min("label"), F.max("label")).first()
    if kinds[0] is None or kinds[0] == kinds[1]:
        return None
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features")
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=trees, maxDepth=depth, seed=7)
    return PipelineModel([assembler, forest.fit(assembler.transform(picked))])


def scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    path_col: str | None = "source",
    findings: DataFrame | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(id, path, value, starts, probability, secret): each candidate value of each document, judged.
    ``findings``, labelled findings to train on, has id, value and label (1 real, 0 false); else the forest
    learns from ``fixtures``."""
    found = candidates(docs, id_col, text_col, path_col)
    words = dictionary(docs, text_col)
    places = found.select("finding", "id", "path", "value", F.inline("contexts"))
    featured = materialize(with_features(places, words).drop("before", "after"))
    if findings is None:
        labelled = with_features(fixtures(docs.sparkSession, common_words(words)), words)
    else:
        given = findings.select(F.col(id_col).alias("id"), "value", F.col("label").cast("double").alias("label"))
        labelled = featured.join(given, ["id", "value"])
    model = train_forest(labelled)
    if model is None:
        judged = featured.withColumn("chance", F.lit(0.0))
    else:
        judged = model.transform(featured).withColumn("chance", vector_to_array("probability")[1])
    if findings is not None:
        judged = judged.withColumn("chance", F.when(F.col("value").rlike(KNOWN), 1.0).otherwise(F.col("chance")))
    most = judged.groupBy("finding").agg(F.max("chance").alias("probability"))
    return found.join(most, "finding").select(
        F.col("id").alias(id_col), "path", "value", "starts", "probability", (F.col("probability") >= threshold).alias("secret")
    )


def redact(docs: DataFrame, judged: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = MASK) -> DataFrame:
    """``docs`` with every place of a document's secrets replaced; all rows and columns stay. Texts with
    secrets are taken apart into words, those that hold a secret are masked, and the texts put together again."""
    key, values = fresh("found_id", docs.columns), fresh("found", docs.columns)
    real = judged.filter("secret").select(F.col(id_col).alias(key), "value")
    lists = materialize(real.groupBy(key).agg(F.collect_set("value").alias(values)))
    joined = docs.join(lists, F.col(id_col).eqNullSafe(F.col(key)), "left")
    touched = joined.filter(F.col(values).isNotNull() & F.col(text_col).isNotNull())
    untouched = joined.filter(F.col(values).isNull() | F.col(text_col).isNull()).select(docs.columns)
    held = materialize(touched.select(F.monotonically_increasing_id().alias("doc"), F.struct(*docs.columns).alias("row"), F.col(values).alias("values")))
    texts = masked(held.select("doc", F.col(f"row.{text_col}").alias("text"), "values"), mask)
    changed = held.join(texts, "doc").select(
        *(F.col("masked").alias(c) if c == text_col else F.col("row").getField(c).alias(c) for c in docs.columns)
    )
    return untouched.unionByName(changed)


def masked(docs: DataFrame, mask: str = MASK) -> DataFrame:
    """(doc, masked): the texts of (doc, text, values) with every place of the values replaced. In a word the
    longest values are replaced first, as a value may be part of another."""
    least = F.array_min(F.transform("values", F.length))
    pattern = F.concat(F.lit(f"{_BLOCK}|{_SIGN}{{"), least.cast("string"), F.lit(",}+"))
    cut = docs.select("doc", F.regexp_extract_all("text", pattern, F.lit(0)).alias("words"), F.split("text", pattern, -1).alias("gaps"))
    part = F.transform("gaps", lambda g, i: F.struct(i.alias("at"), g.alias("gap"), F.coalesce(F.get("words", i), F.lit("")).alias("word")))
    parts = cut.select("doc", F.inline(part))
    each = F.collect_set(F.struct(F.length("value").alias("n"), "value"))
    found = occurrences(docs).select("doc", "value", "word").distinct()
    lists = found.groupBy("doc", "word").agg(F.sort_array(each, asc=False).alias("own"))
    hidden = lists.select("doc", "word", F.aggregate("own", F.col("word"), lambda a, s: F.replace(a, s["value"], F.lit(mask))).alias("new"))
    whole = parts.join(hidden, ["doc", "word"], "left").select("doc", F.struct("at", F.concat("gap", F.coalesce("new", "word")).alias("part")).alias("p"))
    in_order = F.sort_array(F.collect_list("p"))
    return whole.groupBy("doc").agg(in_order.alias("parts")).select("doc", F.array_join("parts.part", "").alias("masked"))
