"""Words one edit apart, by walking a trie that lies in a table.

A trie over the words is a table of edges (level, node, symbol, child); nodes are known by a 64-bit hash of
their prefix. All words walk it at once, level by level: a state (word, position, node) that has made
its edit is joined with the edges of its node whose symbol comes next in the word; a word that has made
none stands at the node of its own prefix, where it may skip a code point of its own or take a
neighbouring edge. An edge that ends a word has the empty symbol, and a state that reaches it at the
end of its word is a pair of near words.

What keeps the states few:

* An edit lies in the second half of a word or, read backwards, in the second half of that. There are two
  tries, of the words and of the reversed words, and edits are made only from half of a word on, where
  few words share a prefix.
* Of a pair of equal length only the smaller word takes the other's edge; of a pair of different lengths
  only the longer skips. The pairs are mirrored at the end.
* An edge holds 64 bits with the symbols that its child goes on with; a state that finds its next symbol
  missing there ends before it is shuffled again.

Words of up to ``LEVELS`` code points have symbols of one code point. The symbols of longer ones have
as many (a power of two) as make ``LEVELS`` of them at most, so the number of joins is bounded for words
of any length; a word is in the tries of its own length and of the next. Each level is written before
the next one starts. Joins have one key, the node: a node has few edges, so a busy one makes many
states on the other side only, which the adaptive skew join divides. Found pairs are compared once
more as text, so equal hashes add nothing.

Words are compared by code points, and ordered by them. Null texts have no words, a null word is none.
Repeated rows count as often as they come. Words of ``counted`` need not be distinct before it, words
given to ``neighbours`` must be. An empty table gives an empty result; other columns may have any names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levelscope.session import stage

#: Letters that make up words.
RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_CHARS, LEAST_COUNT, LEAST_RATIO = 7, 2, 10
LEVELS = 32


def runs(docs: DataFrame, text: str = "text", least: int = LEAST_CHARS, keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` and ``run``: every maximal run of letters of at least ``least`` code points, A-Z lowered."""
    found = F.regexp_extract_all(F.col(text), F.lit(f"{RUN}{{{least},}}"), 0)
    exploded = docs.select(*keep, F.explode(found).alias("_run"))
    return exploded.select(*keep, F.translate("_run", UPPER, LOWER).alias("run"))


def counted(words: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """``word`` and ``n``, how often it comes, of the words that are long and frequent enough."""
    long = words.where(F.char_length("word") >= least_chars)
    return long.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)


def _width(length: Column) -> Column:
    """Code points of a symbol in words of a length: the least power of two that makes few enough."""
    return F.when(length <= LEVELS, 1).otherwise(
        F.pow(F.lit(2.0), F.ceil(F.log2(length / F.lit(LEVELS)))).cast("int")
    )


def _cut(at, size) -> Column:
    """``size`` code points of ``_text`` from ``at`` (from 0) on."""
    return F.substring(F.col("_text"), at + 1, size)


def _bit(symbol: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.xxhash64(symbol), F.lit(64)).cast("int"))


def _node(depth: Column) -> Column:
    return F.xxhash64("_way", "_width", F.substring(F.col("_text"), F.lit(1), depth))


def _both_ways(words: DataFrame) -> DataFrame:
    """The words as they are read by the two tries."""
    size = F.char_length("word")
    way = words.select("word", "n", F.explode(F.array(F.lit(False), F.lit(True))).alias("_way"))
    return way.select(
        "n", "_way", F.when(F.col("_way"), F.reverse("word")).otherwise(F.col("word")).alias("_text"),
        size.alias("_size"),
    )


def _edges(words: DataFrame) -> DataFrame:
    """The edges of both tries, below the depth from which words make edits."""
    read = _both_ways(words)
    widths = F.array_distinct(F.array(_width(F.col("_size")), _width(F.col("_size") + 1)))
    placed = read.withColumn("_width", F.explode(widths))
    half = F.floor(F.floor(F.col("_size") / 2) / F.col("_width")).cast("int")
    last = F.ceil(F.col("_size") / F.col("_width")).cast("int")
    deep = placed.withColumn("level", F.explode(F.sequence(half, last)))
    depth = (F.col("level") * F.col("_width")).cast("int")
    symbol = _cut(depth, F.col("_width"))
    after = _cut(depth + F.col("_width"), F.col("_width"))
    ends = symbol == ""
    return (
        deep.select(
            "level", _node(depth).alias("node"), symbol.alias("symbol"),
            _node(depth + F.col("_width")).alias("child"), _bit(after).alias("mask"),
            F.when(ends, F.col("_text")).alias("near"), F.when(ends, F.col("n")).alias("near_n"),
        )
        .groupBy("level", "node", "symbol", "child", "near")
        .agg(F.bit_or("mask").alias("mask"), F.max("near_n").alias("near_n"))
    )


def _starts(read: DataFrame, level: int) -> DataFrame:
    """The states in which words make their edit at a level: ``want`` is the symbol that must come after
    a skipped code point, null where another edge than ``own`` is taken."""
    depth = (F.lit(level) * F.col("_width")).cast("int")
    here = read.where((depth + F.col("_width") > F.floor(F.col("_size") / 2)) & (depth < F.col("_size")))
    here = here.select("*", _node(depth).alias("node"), _cut(depth, F.col("_width")).alias("own"))
    ahead = _cut(depth, F.col("_width") + 1)
    skipped = F.transform(
        F.sequence(F.lit(1), F.char_length("own")),
        lambda i: F.concat(F.substring(ahead, F.lit(1), i - 1), F.substring(ahead, i + 1, F.col("_width"))),
    )
    # skipping another of equal code points gives the same: the last one is taken, unless it lies ahead
    wants = F.array_except(F.array_distinct(skipped), F.array("own"))
    step = F.concat(F.transform(wants, lambda w: F.struct(w.alias("want"), F.lit(1).alias("more"))),
                    F.array(F.struct(F.lit(None).cast("string").alias("want"), F.lit(0).alias("more"))))
    steps = here.withColumn("step", F.explode(step))
    return steps.select(
        "_text", "n", "_way", "_width", "_size", "node", "own", F.col("step.want").alias("want"),
        (depth + F.char_length("own") + F.col("step.more")).alias("at"),
    )


def _onwards(states: DataFrame) -> DataFrame:
    """States that have made their edit, before they are joined with the next level."""
    return states.where("near is null").select(
        "_text", "n", "_way", "_width", "_size", F.col("child").alias("node"),
        F.lit("").alias("own"), _cut(F.col("at"), F.col("_width")).alias("want"),
        F.least(F.col("at") + F.col("_width"), F.col("_size")).alias("at"),
    )


def neighbours(words: DataFrame) -> DataFrame:
    """``word``, ``n``, ``near`` and ``near_n``: every pair of words one edit apart, both ways.

    ``words`` has distinct ``word`` and ``n``; it is read once per level and should be a written table.
    """
    edges = stage(_edges(words).sortWithinPartitions("level"), "trie-edges")
    bounds = edges.agg(F.min("level").alias("low"), F.max("level").alias("high")).first()
    read = _both_ways(words).withColumn("_width", _width(F.col("_size")))
    found, states = [], None
    for level in range(bounds["low"] or 0, -1 if bounds["high"] is None else bounds["high"] + 1):
        here = _starts(read, level)
        if states is not None:
            here = here.unionByName(_onwards(states))
        edge = edges.where(F.col("level") == level).drop("level")
        wanted = F.when(
            F.col("want").isNull(),
            (F.col("symbol") > F.col("own"))
            & (F.char_length("symbol") == F.char_length("own"))
            & (F.levenshtein("symbol", "own", 1) == 1),
        ).otherwise(F.col("symbol") == F.col("want"))
        goes_on = F.col("mask").bitwiseAND(_bit(_cut(F.col("at"), F.col("_width")))) != 0
        joined = here.join(edge, "node").where(wanted & (F.col("near").isNotNull() | goes_on))
        states = stage(
            joined.select("_text", "n", "_way", "_width", "_size", "at", "child", "near", "near_n"),
            "trie-states",
        )
        found.append(states.where("near is not null").select("_text", "n", "_way", "near", "near_n"))
    if not found:
        return words.limit(0).select(
            "word", "n", F.col("word").alias("near"), F.col("n").alias("near_n")
        )

    def forwards(name: str) -> Column:
        return F.when(F.col("_way"), F.reverse(name)).otherwise(F.col(name))

    pairs = (
        reduce(DataFrame.unionByName, found)
        .select(forwards("_text").alias("word"), "n", forwards("near").alias("near"), "near_n")
        .where(F.levenshtein("word", "near", 1) == 1)
    )
    sides = [F.struct("word", "n", "near", "near_n"), F.struct(
        F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n")
    )]
    return pairs.dropDuplicates(["word", "near"]).select(F.explode(F.array(*sides)).alias("p")).select("p.*")


def _roots(forms: DataFrame) -> DataFrame:
    """The last word that each word's forms lead to. Each form comes ``LEAST_RATIO`` times as often as the
    one before, so the ways are short, and each turn doubles what is known of them."""
    known = stage(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        further = known.select(F.col("word").alias("root"), F.col("root").alias("further"))
        nearer = known.join(further, "root", "left")
        known = stage(
            nearer.select(
                "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")
            ),
            "variant-roots",
        )
        if known.where("moved").isEmpty():
            return known.select("word", "root")
        known = known.select("word", "root")


def variants(words: DataFrame, ratio: int = LEAST_RATIO) -> DataFrame:
    """Groups spelling variants: for each of the ``words`` (distinct ``word``, ``n``) its ``form``, the
    near word that comes most often (the smallest of equals), if that comes ``ratio`` times as often as
    the word or more, else null; ``root``, the last word that forms lead to, or the word itself; ``n_near``, how many
    near words it has; ``form_n``, how often its form comes.
    """
    words = stage(words.select("word", "n"), "variant-words")
    near = neighbours(words)
    best = F.min(F.struct((-F.col("near_n")).alias("rank"), F.col("near")))
    judged = near.groupBy("word").agg(
        F.count("*").alias("n_near"), F.first("n").alias("n"), best.alias("best")
    )
    is_form = -F.col("best.rank") >= ratio * F.col("n")
    judged = judged.select(
        "word", "n_near",
        F.when(is_form, F.col("best.near")).alias("form"), F.when(is_form, -F.col("best.rank")).alias("form_n"),
    )
    judged = stage(judged, "variant-forms")
    judged = judged.join(_roots(judged.where("form is not null")), "word", "left")
    return words.join(judged, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form_n",
    )
