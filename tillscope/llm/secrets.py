"""Scan for secrets: candidate strings, judged by a random forest that removes false positives.

A candidate is a run of letters, digits and ``+/=_.@-``, however many a word between white space has: every run of at least
``LEAST_CHARS`` signs with a digit, and every run that a credential's name and an assignment stand before, whatever its
length and signs; a leading ``name=`` is taken off and counts as a neighbouring word. Neighbours of a run are the runs
and signs before it in its word, then the words before. The forest sees

* its length, and the shares of digits, capitals and other signs,
* character transitions: how often the kind of character changes, and how the letters' pairs compare with those of the
  corpus's frequent words,
* dictionary coverage: the share of its characters that are letter runs among the most frequent words of the corpus,
* path: whether it looks like an address, a path, a number or a file name, and the words of a path,
* neighbouring words: whether those before name a credential, and an assignment stands between.

It is trained from labelled findings, a bounded sample of them. Where no labelled findings exist, ``planted`` makes some: it
puts strings whose kind is known into texts of the corpus, so labels come from the planting and from no feature.
Everything runs on DataFrame functions and MLlib.

Findings are told apart by id, a hash of the text, the place of the word and ``at``, the offset of the run among the word's
pieces (runs, and what parts them, from 0). NULL and empty texts have none. Repeated rows
each give theirs. Without labelled findings of both kinds nothing can be learned: the probability is NULL and every
candidate stays. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved, smallest, text_or_empty

LEAST_CHARS = 12
DICTIONARY = 2000
SAMPLE = 20_000
#: Texts that get a planted string each.
PLANTED = 3000
_SIGNS = r"A-Za-z0-9+/=_.@-"
_CREDENTIAL = r"(pass(word|wd)?|secret|token|api|key|auth|credential)"
_ASSIGNED = r"""["']?\s*[=:]\s*$"""
FEATURES = ["length", "digits", "capitals", "signs", "changes", "known_pairs", "coverage", "address", "path_parts", "number", "named", "assigned"]


def candidates(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """id, text_hash, place, at, value and the words around it."""
    words = F.split(F.regexp_replace(text_or_empty(text), r"\s+", " "), " ")
    word = lambda k: F.coalesce(F.get("w", k), F.lit(""))
    long = lambda k: (F.length(word(k)) >= LEAST_CHARS) & word(k).rlike("[0-9]")
    named = lambda k: word(k).rlike(rf"(?i){_CREDENTIAL}")
    # A name, the sign of assignment and the value are in up to three words; the sign, being rare, is looked for first.
    sign = lambda k: word(k).contains("=") | word(k).contains(":")
    assigned = lambda k: (sign(k) & (named(k) | named(k - 1))) | (sign(k - 1) & (named(k - 1) | named(k - 2)))
    piece = lambda k: F.when(F.col("at") >= -k, F.get(F.col("pieces"), F.col("at") + k)).otherwise(F.lit(""))
    # Runs and what parts them take turns in a word, so two runs before are at most four pieces before.
    inside = F.regexp_replace(F.concat(*[piece(k) for k in (-4, -3, -2, -1)]), r"""["'`({\[<\\]+$""", "")
    value = F.regexp_replace("held", r"^[A-Za-z_]+=", "")
    name = F.regexp_extract("held", r"^([A-Za-z_]+=)", 1)
    # Generators hold the expressions: a filter on them below would split the text again for every word.
    places = F.filter(F.sequence(F.lit(0), F.size("w") - 1), lambda k: long(k) | assigned(k))
    return (
        docs.select(F.col(id).cast("long").alias("id"), F.xxhash64(F.col(text).cast("string")).alias("text_hash"), words.alias("w"))
        .select("id", "text_hash", "w", F.explode(F.coalesce(places, F.array().cast("array<int>"))).alias("place"))
        .select("id", "text_hash", "place", word(F.col("place")).alias("word"), *[word(F.col("place") + k).alias(n) for k, n in ((-2, "before2"), (-1, "before1"), (1, "after1"))])
        .withColumn("pieces", F.regexp_extract_all("word", F.lit(rf"([{_SIGNS}]+|[^{_SIGNS}]+)"), 1))
        .select("*", F.posexplode(F.filter("pieces", lambda p: p.isNotNull())).alias("at", "held"))
        .filter(F.col("held").rlike(rf"^[{_SIGNS}]"))
        .select(
            "id",
            "text_hash",
            "place",
            "at",
            value.alias("value"),
            F.concat_ws(" ", F.when(F.col("at") < 2, F.col("before2")), F.when(F.col("at") < 4, F.col("before1")), inside, name).alias("before"),
            F.coalesce(F.get("pieces", F.col("at") + 2), "after1").alias("after1"),
        )
        .filter(
            (F.col("value") != "")
            & (((F.length("value") >= LEAST_CHARS) & F.col("value").rlike("[0-9]")) | F.col("before").rlike(rf"(?i){_CREDENTIAL}\w*{_ASSIGNED}"))
        )
    )


def dictionary(docs: DataFrame, text: str = "text", size: int = DICTIONARY) -> DataFrame:
    """One row: the most frequent words of letters (of three letters or more), and their pairs of letters."""
    word = F.explode(F.split(F.lower(text_or_empty(text)), r"[^a-z]+"))
    top = smallest(
        docs.select(word.alias("word")).filter(F.length("word") >= 3).groupBy("word").agg(F.count(F.lit(1)).alias("n")),
        [F.desc("n"), F.col("word")],
        size,
    )
    pairs = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda k: F.substr("word", k, F.lit(2)))
    return saved(  # at most ``size`` words
        top.agg(F.collect_set("word").alias("words"), F.array_distinct(F.flatten(F.collect_set(pairs))).alias("pairs"))
    )


def features(found: DataFrame, known: DataFrame) -> DataFrame:
    """The candidates with the columns ``FEATURES``, all double."""
    v, n = F.col("value"), F.length("value")
    share = lambda signs: F.length(F.regexp_replace("value", rf"[^{signs}]", "")) / n
    kinds = F.translate(F.regexp_replace(F.regexp_replace(F.regexp_replace("value", "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0"), "+/=_.@-", "-------")
    runs = F.regexp_extract_all(F.lower("value"), F.lit("([a-z]{2,})"), 1)
    pairs = F.flatten(F.transform("runs", lambda r: F.transform(F.sequence(F.lit(1), F.length(r) - 1), lambda k: F.substr(r, k, F.lit(2)))))
    total = lambda a: F.aggregate(a, F.lit(0), lambda s, x: s + F.length(x))
    columns = {
        "length": n,
        "digits": share("0-9"),
        "capitals": share("A-Z"),
        "signs": share("+/=_.@-"),
        "changes": (F.length(F.regexp_replace(kinds, r"(.)\1*", "$1")) - 1) / n,
        "known_pairs": F.size(F.filter("own", lambda p: F.array_contains("pairs", p))) / F.greatest(F.size("own"), F.lit(1)),
        "coverage": total(F.filter("runs", lambda r: F.array_contains("words", r))) / n,
        "address": v.rlike(r"@|^\d{1,3}(\.\d{1,3}){3}\.?$"),
        "path_parts": F.size(F.split("value", "[/.]")) - 1,
        "number": v.rlike(r"^[0-9.\-+]+$"),
        "named": F.col("before").rlike(rf"(?i){_CREDENTIAL}"),
        "assigned": F.col("before").rlike(r"[=:]\s*$"),
    }
    return (
        found.withColumn("runs", runs)
        .withColumn("own", pairs)
        .withColumn("words", known.select("words").scalar())
        .withColumn("pairs", known.select("pairs").scalar())
        .select(*found.columns, *[c.cast("double").alias(k) for k, c in columns.items()])
    )


def train(labelled: DataFrame, sample: int = SAMPLE, trees: int = 20, depth: int = 6, seed: int = 7) -> RandomForestClassificationModel | None:
    """A forest from labelled findings (features and label 0 or 1): the ``sample`` with the smallest hashes."""
    labelled = labelled.filter(F.col("label").isin(0, 1)).select(*FEATURES, F.col("label").cast("double").alias("label"), "value")
    rows = saved(smallest(labelled, [F.xxhash64("value"), F.xxhash64(*FEATURES)], sample)).coalesce(1)
    if rows.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed, featuresCol="features", labelCol="label")
    return forest.fit(_assembled(rows))


def judge(found: DataFrame, model: RandomForestClassificationModel | None, least: float = 0.5) -> DataFrame:
    """The candidates with probability, and is_secret where it is at least ``least``."""
    if model is None:
        return found.withColumn("probability", F.lit(None).cast("double")).withColumn("is_secret", F.lit(True))
    judged = model.transform(_assembled(found))
    return judged.withColumn("probability", vector_to_array("probability")[1]).withColumn("is_secret", F.col("probability") >= least)


def _assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def planted(docs: DataFrame, id: str = "doc_id", text: str = "text", sample: int = PLANTED, seed: int = 11) -> DataFrame:
    """id, text, planted and secret: texts of about ``sample`` documents, chosen by hash, each with one string put in.

    Half of the strings are secrets of several makes, the others are harmless strings that look alike: digests, numbers,
    addresses, paths, times, and plain words behind a credential's name. Which of them a text gets depends on a hash alone.
    """
    held = F.col(text).cast("string")
    docs = docs.select(F.col(id).cast("long").alias("id"), held.alias("text"), F.xxhash64(F.col(id), held, F.lit(seed)).alias("draw"))
    share = max(1, docs.count() // max(1, sample))
    hexed = F.sha2(F.col("draw").cast("string"), 256)
    code = F.translate(F.base64(F.unhex(hexed)), "+/=", "xyz")
    digits = F.translate(hexed, "abcdef", "012345")
    letters = F.translate(hexed, "0123456789", "ghijklmnop")
    part = lambda c, a, n: F.substr(c, F.lit(a), F.lit(n))
    number = lambda a, m: (F.conv(part(hexed, a, 4), 16, 10).cast("int") % m).cast("string")
    join = lambda *x: F.concat(*[F.lit(v) if isinstance(v, str) else v for v in x])
    some = F.try_element_at(F.split(F.regexp_replace(F.coalesce("text", F.lit("")), r"[^A-Za-z]+", " "), " "), F.lit(2))
    plain = F.coalesce(F.nullif(some, F.lit("")), F.lit("none"))
    kinds = [  # what stands before, the string, what stands behind, and whether it is a secret
        ('token = "', part(hexed, 1, 40), '"', 1), ("password=", part(code, 1, 12), "", 1), ("api_key: ", part(hexed, 1, 32), "", 1),
        ("", join("AKIA", F.upper(part(hexed, 1, 16))), "", 1), ('{"secret":"', part(code, 1, 24), '"}', 1), ("password: ", part(letters, 1, 8), "", 1),
        ("Authorization: Bearer ", part(code, 1, 40), "", 1), ("", join("ghp_", part(code, 1, 36)), "", 1), ("auth_token=", part(code, 1, 30), "&x=1", 1), ("secret ", part(code, 1, 32), "", 1),
        ("commit ", part(hexed, 1, 40), "", 0), ("", part(digits, 1, 16), "", 0), ("", join(part(letters, 1, 6), ".", number(1, 100), "@mail", number(5, 10), ".example.com"), "", 0),
        ("", F.concat_ws(".", *[number(a, 256) for a in (1, 5, 9, 13)]), "", 0), ("id: ", F.concat_ws("-", part(hexed, 1, 8), part(hexed, 9, 4), part(hexed, 13, 4), part(hexed, 17, 12)), "", 0),
        ("/usr/lib/", join(part(letters, 1, 6), "/v", number(1, 9), "/file", number(5, 999), ".so.", number(9, 9)), "", 0),
        ("", join("20", part(digits, 1, 2), "-0", number(1, 9), "-1", number(5, 9), "T1", number(9, 9), ":22:33"), "", 0),
        ("key: ", plain, "", 0), ("The password = ", plain, "", 0), ("https://www.example.com/", join(part(letters, 1, 7), "/", number(1, 99), "/page-", number(5, 9999)), "", 0),
    ]
    kind = F.pmod("draw", F.lit(len(kinds))).cast("int")
    chosen = F.element_at(
        F.array(*[F.struct(join(a).alias("a"), v.alias("value"), F.lit(b).alias("b"), F.lit(y).alias("secret")) for a, v, b, y in kinds]), kind + 1
    )
    at = F.pmod(F.xxhash64("draw"), F.length("text") + 1).cast("int")
    return (
        docs.filter(held.isNotNull() & (F.pmod(F.xxhash64("draw", F.lit(seed)), F.lit(share)) == 0))
        .withColumn("k", chosen)
        .select(
            "id",
            F.concat(F.substr("text", F.lit(1), at), F.lit(" "), "k.a", "k.value", "k.b", F.lit(" "), F.substr("text", at + 1)).alias("text"),
            F.col("k.value").alias("planted"),
            F.col("k.secret").alias("secret"),
        )
    )


def planted_findings(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Candidates that were planted, with features and label; ``rows`` come from ``planted``."""
    found = features(candidates(rows, "id", "text"), known)
    truth = rows.select("id", F.xxhash64("text").alias("text_hash"), "planted", F.col("secret").alias("label"))
    # A long string may be cut into runs; what is part of it, is of its kind.
    return found.join(truth, ["id", "text_hash"]).filter(F.contains("planted", "value")).drop("planted")
