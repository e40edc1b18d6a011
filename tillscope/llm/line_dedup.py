"""Removal of lines that repeat an earlier line, exactly or nearly, in any document.

A line's tokens are its distinct words (parted by white space, A-Z lower-cased). Two lines match if their sets of tokens have
a Jaccard similarity of 0.8 or more. A line goes if it matches any line before it, in the order of document id
and line number; whether that line goes itself does not matter. Lines of fewer than ``least_words`` tokens stay; by default
only lines without words do.

The join is exact and runs on DataFrame functions:

1. Tokens are counted over all documents, in 262,144 classes of their hash. A token is a number that holds its rarity in the
   upper bits, so sets sort by rarity, rarest first.
2. Equal sets become one, with its first place and its number. Every place after the first goes. It remains to be found
   whether an earlier set matches: that one's place is before all places of the set, so all of them go.
3. Prefix, positional and length filters, and a parity sketch of the set that bounds its difference from below, choose
   candidates; words decide. The sketch has 64 bits, and 256 for sets of many tokens, which 64 do not tell apart. To spare hot
   groups, sets first meet the earliest and the most frequent set with the same token of least hash. Only sets without a match
   go on to the full comparison, which verifies the most alike candidate of each, and to the last one, which verifies all
   candidates of sets whose most alike one was none.

NULL ids come first. Lines at the same place of rows that share an id are not before one another. Rows that agree in id and
text share their result, and each gives a row. NULL texts stay NULL, without lines. Other columns are ignored by ``marked``
and kept by ``cleaned``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import folded, free_shuffles, saved

#: Documents and sets are looked up by a broadcast of their keys up to this number (20 bytes each), else by a shuffle.
BROADCAST_DOCUMENTS = 1_000_000
_CLASSES = 1 << 18
_NULL_ID = -(1 << 63)
_SPACES = "\t\r\v\f"
_PLACE = ["doc", "hash", "line"]
#: Sets of more tokens have a sketch of 256 bits: the three columns, and the first quarter, which is what they and ``sketch``
#: add up to. For other sets the three are zero.
_WIDE = 64
_SKETCH = ["sketch", "second", "third", "fourth"]


def marked(docs: DataFrame, id: str = "doc_id", text: str = "text", least_words: int = 1) -> DataFrame:
    """id, text_hash and removed (numbers of lines, from 0) of every document of which lines go."""
    docs = docs.select(
        F.coalesce(F.col(id).cast("long"), F.lit(_NULL_ID)).alias("doc"),
        F.xxhash64(F.col(text).cast("string")).alias("hash"),
        F.col(text).cast("string").alias("text"),
    )
    lines = saved(_sets(docs)).filter(F.col("n") >= max(1, least_words))
    sets = saved(
        lines.groupBy("set", "sketch")
        .agg(F.min(F.struct("doc", "line", "hash", "n", "least", *_SKETCH[1:], "prefix")).alias("x"), F.count(F.lit(1)).alias("times"))
        .select("set", "sketch", "x.*", "times")
        .withColumn("sid", F.monotonically_increasing_id())  # fixed by the file that holds it
    )
    # Up to three words only equal sets match, and those are one already.
    comparable = sets.filter("n > 3")
    free_shuffles(docs.sparkSession)
    matched = _verified(docs, sets, saved(_lead_candidates(comparable)))
    free_shuffles(docs.sparkSession)
    still = _entries(_unmatched(comparable, matched))
    best = saved(_best(_full_candidates(still, still), _differing("a", "b", *_sizes())))
    free_shuffles(docs.sparkSession)
    found = _verified(docs, sets, best)
    free_shuffles(docs.sparkSession)
    failed = best.select(F.col("b_sid").alias("sid")).join(found, "sid", "left_anti")
    asked = _entries(comparable.join(_small(failed), "sid", "left_semi"))
    if failed.count() <= BROADCAST_DOCUMENTS // 10:  # about ten entries each
        asked = F.broadcast(asked)
    last = _verified(docs, sets, saved(_full_candidates(_entries(comparable), asked).select("a_sid", "b_sid").distinct()))
    matched = matched.union(found).union(last).withColumn("matched", F.lit(True))
    free_shuffles(docs.sparkSession)
    late = saved(
        sets.select("set", "sketch", "sid", "doc", "line", "times")
        .join(matched, "sid", "left")
        .filter("times > 1 OR matched")
        .select("set", "sketch", F.when(F.col("matched").isNull(), F.struct("doc", "line")).alias("first"))
    )
    return (
        lines.select(*_PLACE, "set", "sketch")
        .join(late, ["set", "sketch"])
        .filter(F.col("first").isNull() | (F.struct("doc", "line") > F.col("first")))
        .groupBy("doc", "hash")
        .agg(F.collect_set("line").alias("removed"))
        .select(F.when(F.col("doc") != _NULL_ID, F.col("doc")).alias("id"), F.col("hash").alias("text_hash"), "removed")
    )


def cleaned(docs: DataFrame, id: str = "doc_id", text: str = "text", least_words: int = 1) -> DataFrame:
    """All rows and columns as the struct ``row``, with new_text, n_lines and n_removed."""
    found = saved(marked(docs, id, text, least_words))
    free_shuffles(docs.sparkSession)
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(id).cast("long"), F.lit(_NULL_ID)).alias("of"),
        F.xxhash64(F.col(text).cast("string")).alias("hash"),
        F.col(text).cast("string").alias("text"),
    )
    found = found.select(F.coalesce("id", F.lit(_NULL_ID)).alias("of"), F.col("text_hash").alias("hash"), "removed")
    found_rows, gone = found.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("removed")), F.lit(0))).first()
    if 4 * found_rows <= BROADCAST_DOCUMENTS and gone <= BROADCAST_DOCUMENTS:  # no text needs to move
        rows = rows.join(F.broadcast(found), ["of", "hash"], "left")
    elif found_rows <= BROADCAST_DOCUMENTS:  # texts that stay as they are need not move
        keys = F.broadcast(found.select("of", "hash"))
        touched = rows.join(keys, ["of", "hash"], "left_semi").join(found, ["of", "hash"])
        rest = rows.join(keys, ["of", "hash"], "left_anti").withColumn("removed", F.lit(None).cast("array<int>"))
        rows = touched.unionByName(rest)
    else:
        rows = rows.join(found, ["of", "hash"], "left")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda _, k: ~F.array_contains("removed", k))
    count = lambda size, known: F.when(known, size).otherwise(0).cast("long")
    return rows.select(
        "row",
        F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("new_text"),
        count(F.size(lines), F.col("text").isNotNull()).alias("n_lines"),
        count(F.size("removed"), F.col("removed").isNotNull()).alias("n_removed"),
    )


def _words(line: Column) -> Column:
    """Words of a line, folded; where spaces meet there are empty ones."""
    return F.split(folded(_spaced(line, _SPACES)), " ")


def _spaced(text: Column, signs: str) -> Column:
    """Other white space as spaces; most texts have none, and looking costs less than translating."""
    return F.when(text.rlike(f"[{signs}]"), F.translate(text, signs, " " * len(signs))).otherwise(text)


def _class(hash: Column) -> Column:
    return hash.bitwiseAND(F.lit(_CLASSES - 1)).cast("int")


def _rarity(docs: DataFrame) -> DataFrame:
    """One row with an array: the class of frequency of every class of hash, a third of a binary order of magnitude each."""
    counted = (
        docs.select(F.explode(F.split("text", "\n")).alias("line"))
        .select(F.explode(_words(F.col("line"))).alias("w"))
        .filter("w <> ''")
        .groupBy(_class(F.xxhash64("w")).alias("k"))
        .agg(F.count(F.lit(1)).alias("c"))
        .select("k", F.least(F.lit(126), F.floor(3 * F.log2("c"))).cast("tinyint").alias("c"))
    )
    every = docs.sparkSession.range(_CLASSES).select(F.col("id").cast("int").alias("k"))
    pairs = every.join(counted, "k", "left").agg(F.collect_list(F.struct("k", F.coalesce("c", F.lit(0).cast("tinyint")).alias("c"))).alias("p"))
    return saved(pairs.select(F.transform(F.sort_array("p"), lambda x: x["c"]).alias("rarity")))


def _hashes(line: Column) -> Column:
    """Hashes of the distinct words."""
    return F.array_remove(F.array_distinct(F.transform(_words(line), lambda w: F.xxhash64(w))), F.xxhash64(F.lit("")))


def _tokens(hashes: Column, rarity: Column) -> Column:
    """Rarest first; a token is its class of frequency, then 56 bits of its hash."""
    return F.sort_array(
        F.transform(hashes, lambda h: F.shiftleft(F.get(rarity, _class(h)).cast("long"), 56).bitwiseOR(h.bitwiseAND(F.lit((1 << 56) - 1))))
    )


def _sketch(tokens: Column, quarter: int | None = None) -> Column:
    """For each of 64 classes of tokens, whether their number is odd; or for those of one quarter of 256 classes."""
    bit = lambda t: F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(F.lit(63)).cast("int"))
    if quarter is None:
        return F.aggregate(tokens, F.lit(0).cast("long"), lambda s, t: s.bitwiseXOR(bit(t)))
    of = F.lit(64 * quarter)
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda s, t: F.when(t.bitwiseAND(F.lit(192)) == of, s.bitwiseXOR(bit(t))).otherwise(s))


def _sets(docs: DataFrame) -> DataFrame:
    """doc, hash, line, set (a hash), sketch, n, least (hash) and prefix of every line.

    Lines without words are kept: a filter here would be moved below and make the tokens twice.
    """
    rarity, n = _rarity(docs).scalar(), F.col("n")
    return (
        docs.select("doc", "hash", F.posexplode(F.split("text", "\n")).alias("line", "own"), rarity.alias("rarity"))
        .select(*_PLACE, _hashes(F.col("own")).alias("hashes"), "rarity")
        .select(*_PLACE, F.array_min("hashes").alias("least"), _tokens(F.col("hashes"), F.col("rarity")).alias("tokens"))
        .withColumn("n", F.size("tokens"))
        .select(
            *_PLACE,
            F.xxhash64("tokens").alias("set"),
            _sketch(F.col("tokens")).alias("sketch"),
            *[F.when(n > _WIDE, _sketch(F.col("tokens"), k)).otherwise(0).alias(c) for k, c in enumerate(_SKETCH[1:], 1)],
            "n",
            "least",
            # Similar sets share a token here: n - ceil(0.8 n) + 1 of them.
            F.transform(
                F.slice("tokens", 1, n - F.floor((n * 4 + 4) / 5).cast("int") + 1), lambda t: F.hash(t)
            ).alias("prefix"),
        )
    )


def _differing(a: str, b: str, n: Column | None = None, m: Column | None = None) -> Column:
    """At most the number of tokens that only one of the sets has."""
    n, m = F.col(f"{a}_n") if n is None else n, F.col(f"{b}_n") if m is None else m
    x = [F.col(f"{a}_{s}").bitwiseXOR(F.col(f"{b}_{s}")) for s in _SKETCH]
    count = lambda p, q: F.bit_count(p) + F.bit_count(q)
    both = (n > _WIDE) & (m > _WIDE)
    return F.when(both, count(x[0].bitwiseXOR(x[1]).bitwiseXOR(x[2]).bitwiseXOR(x[3]), x[1]) + count(x[2], x[3])).otherwise(F.bit_count(x[0]))


def _possible(a: str, b: str, n: Column | None = None, m: Column | None = None) -> Column:
    """Whether length and sketch let the sets be similar; their overlap is at least 4 (n + m) / 9 then."""
    n, m = F.col(f"{a}_n") if n is None else n, F.col(f"{b}_n") if m is None else m
    return (n * 5 >= m * 4) & (m * 5 >= n * 4) & (_differing(a, b, n, m) <= n + m - 2 * F.floor(((n + m) * 4 + 8) / 9))


def _before(a: str, b: str) -> Column:
    x, y = F.col(f"{a}_doc"), F.col(f"{b}_doc")
    return (x < y) | ((x == y) & (F.col(f"{a}_line") < F.col(f"{b}_line")))


def _small(keys: DataFrame) -> DataFrame:
    """A saved table of keys, marked for broadcasting if its counted number is small."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_DOCUMENTS else keys


_SET = ["sid", "doc", "line", *_SKETCH, "n"]


def _lead_candidates(sets: DataFrame) -> DataFrame:
    """Each set with the more alike of the earliest and the most frequent set with its least hash, if they come earlier."""
    rows = sets.select("least", "times", F.struct("doc", "line", "sid", *_SKETCH, "n").alias("b"))
    leads = (
        rows.groupBy("least")
        .agg(F.min("b").alias("early"), F.max(F.struct("times", "b")).alias("common"), F.count(F.lit(1)).alias("k"))
        .filter("k > 1")
        .select("least", F.explode(F.array_distinct(F.array("early", "common.b"))).alias("a"))
    )
    pairs = rows.join(leads, "least").select(*[F.col(f"{x}.{c}").alias(f"{x}_{c}") for x in "ab" for c in _SET])
    return _best(pairs.filter(_before("a", "b") & _possible("a", "b")), _differing("a", "b"))


def _best(pairs: DataFrame, differing: Column) -> DataFrame:
    """The pair of each second set that differs least."""
    best = F.min(F.struct(differing.alias("differing"), "a_sid"))
    return pairs.groupBy("b_sid").agg(best.alias("a")).select("a.a_sid", "b_sid")


def _unmatched(sets: DataFrame, matched: DataFrame) -> DataFrame:
    """The sets with ``open``: whether none matched so far."""
    known = _small(matched.withColumn("known", F.lit(True)))
    return sets.join(known, "sid", "left").withColumn("open", F.col("known").isNull()).drop("known")


def _entries(sets: DataFrame) -> DataFrame:
    """A row for each token of a prefix; ``size`` holds n, and whether matches are asked for in its last bit."""
    asked = F.col("open").cast("int") if "open" in sets.columns else F.lit(1)
    return sets.select("sid", "doc", "line", *_SKETCH, (F.col("n") * 2 + asked).alias("size"), F.posexplode("prefix").alias("at", "token"))


def _sizes() -> list[Column]:
    """The numbers of tokens of two entries."""
    return [F.shiftright(f"{x}_size", 1) for x in "ab"]


def _full_candidates(earlier: DataFrame, asked: DataFrame) -> DataFrame:
    """Pairs of entries with the same token, the one before the other, that can belong to similar sets."""
    a, b = (e.select(*[F.col(c).alias(f"{x}_{c}") for c in e.columns]) for x, e in (("a", earlier), ("b", asked)))
    n, m = _sizes()
    inside = F.least(n - F.col("a_at"), m - F.col("b_at"))  # tokens that can be shared from here on
    near = _before("a", "b") & _possible("a", "b", n, m) & (inside * 9 >= (n + m) * 4)
    # Behind coalesce no side gets filters of its own, and both need the same columns; so equal entries are shuffled once.
    wanted = F.coalesce(near & (F.col("b_size").bitwiseAND(F.lit(1)) == 1), F.lit(False))
    return a.join(b, (F.col("a_token") == F.col("b_token")) & wanted)


def _verified(docs: DataFrame, sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The second sets (sid) of the saved candidates whose words are similar enough."""
    named = pairs.select(F.col("a_sid").alias("sid")).union(pairs.select("b_sid")).distinct()
    few = 2 * pairs.count() <= BROADCAST_DOCUMENTS
    places = sets.select("sid", *_PLACE).join(F.broadcast(named) if few else named, "sid", "left_semi")
    places = places if few else saved(places)
    rows, wanted = places.select("doc", "hash").distinct(), places
    if few:
        rows, wanted = F.broadcast(rows), F.broadcast(wanted)
    found = (
        docs.join(rows, ["doc", "hash"], "left_semi")
        .select("doc", "hash", F.posexplode(F.split("text", "\n")).alias("line", "own"))
        .join(wanted, _PLACE)
        .select("sid", "own")
        .dropDuplicates(["sid"])
    )
    # Lines travel as text, which shuffles compress, and are cut into words where they meet.
    left, right = (found.select(F.col("sid").alias(f"{x}_sid"), F.col("own").alias(f"{x}_own")) for x in "ab")
    a, b = (F.array_remove(F.array_distinct(_words(F.col(f"{x}_own"))), "") for x in "ab")
    return saved(
        pairs.join(left, "a_sid")
        .join(right, "b_sid")
        .select(F.col("b_sid").alias("sid"), F.inline(F.array(F.struct(a.alias("a"), b.alias("b")))))  # words are made once
        .filter(F.size(F.array_intersect("a", "b")) * 9 >= (F.size("a") + F.size("b")) * 4)
        .select("sid")
        .distinct()
    )
