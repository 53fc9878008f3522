"""Quality rules by the frequency of lines across documents of a host.

Every line with a word is normalised (lower case, digits as 0, white space runs as one blank, ends
trimmed) and hashed. For each host the distinct documents that hold a line are counted, documents of
equal text as one. A line is boilerplate where more than ``max_docs`` documents of the host, and
more than the share ``max_share`` of them, hold it. Boilerplate is removed, but for the first
document of the host that has the line, so that no text is lost for good. A document is depleted,
and rejected, if it has lost lines and keeps under ``min_words`` words or under the share
``min_kept`` of its words.

Base rules need no other document: ``base_failed`` marks documents of under 20 words and those of
whose words more than 30 percent lie in repeated windows of 8 words. Such documents are rejected
too.

Everything is expressed in DataFrame functions. Lines travel as hashes; only per-line flags return
to the documents. A null host is a host of its own. A null text has no words; a null id is kept as
it is. Rows are told apart by (id, hash of the text) within a host: rows equal in both share their
lines' fate, and all are returned. An empty table gives an empty result. Clashing column names do no
harm: the row travels as one struct.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levelscope.llm.rows import Carried
from levelscope.session import scratch, stage

BLANKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 20
MAX_REPEATED_PERCENT = 30
WINDOW = 8


@dataclass(frozen=True)
class LineLimits:
    max_docs: int = 20
    max_share: float = 0.005
    min_kept: float = 0.3
    min_words: int = 10


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, r"[ \t-\r]+"), lambda w: w != "")


def has_word(line: Column) -> Column:
    return line.rlike(r"[^ \t-\r]")


def normalised(line: Column) -> Column:
    squeezed = F.btrim(F.regexp_replace(line, r"[ \t-\r]+", " "))
    # translate() makes a string of each character
    return F.regexp_replace(F.lower(squeezed), "[1-9]", "0")


def normalised_words(line: Column) -> Column:
    """How many words a normalised line with a word has: one more than blanks."""
    return F.octet_length(line) - F.octet_length(F.replace(line, F.lit(" "), F.lit(""))) + 1


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """How many words lie in windows that occur twice or more in the text.

    ``window`` is a power of two. Windows are hashed; if all hashes differ, which costs one pass, there is nothing to count. Else
    their places are sorted by hash, the equal neighbours give the repeated ones, and the places,
    sorted again, add to the count what they do not share with the place before.
    """

    def joined(step: int):
        return lambda h: F.transform(h, lambda x, i: F.xxhash64(x, F.get(h, i + step)))

    def hashes(w: Column) -> Column:
        # of words, then of runs of 2, 4 and 8 words, each from two of the half length
        out, step = F.transform(w, lambda x: F.xxhash64(x)), 1
        while step < window:
            out, step = let(out, joined(step)), 2 * step
        return F.slice(out, 1, F.size(w) - window + 1)

    def places(h: Column) -> Column:
        ordered = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))

        def repeated(s: Column) -> Column:
            return F.array_sort(
                F.transform(
                    F.filter(
                        s,
                        lambda x, i: (F.get(s, i - 1)["h"] == x["h"])
                        | (F.get(s, i + 1)["h"] == x["h"]),
                    ),
                    lambda x: x["i"],
                )
            )

        return let(ordered, repeated)

    def covered(at: Column) -> Column:
        return F.aggregate(
            F.transform(
                at,
                lambda p, i: F.when(i == 0, F.lit(window)).otherwise(
                    F.least(F.lit(window), p - F.get(at, i - 1))
                ),
            ),
            F.lit(0),
            lambda a, x: a + x,
        )

    counted = let(
        hashes(words),
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
            let(places(h), covered)
        ),
    )
    return F.when(F.size(words) <= window, F.lit(0)).otherwise(counted)


def base_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the struct ``_base`` of counts that need only the document itself.

    It is generated, as Spark would compute a projected one again in each filter on it.
    """

    def counts(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n"), has_word)
        return let(
            words_of(t),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                (F.length(t) - F.length(F.regexp_replace(t, f"[{SYMBOLS}]", ""))).cast("long").alias("n_symbols"),
                let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
                .cast("long")
                .alias("n_dup_lines"),
                repeated_words(w).cast("long").alias("n_repeat_words"),
            ),
        )

    base = let(F.coalesce(F.col(text), F.lit("")), counts)
    return docs.select("*", F.explode(F.array(base)).alias("_base"))


def base_failed(base: Column) -> Column:
    return (base["n_words"] < MIN_WORDS) | (
        100 * base["n_repeat_words"] > MAX_REPEATED_PERCENT * base["n_words"]
    )


def keyed(docs: DataFrame, carried: Carried, key: str, host: str) -> DataFrame:
    return docs.select(
        *carried.columns,
        F.col(key).alias("_id"),
        F.xxhash64(carried.text).alias("_hash"),
        F.coalesce(F.xxhash64(host), F.lit(0)).alias("_host"),
    )


def _lines(rows: DataFrame) -> DataFrame:
    """A row per line with a word: place, hash and number of words."""

    def described(line: Column) -> Column:
        return let(
            normalised(line),
            lambda x: F.struct(F.xxhash64(x).alias("line"), normalised_words(x).alias("words")),
        )

    lines = F.filter(F.split(F.coalesce("_text", F.lit("")), "\n"), has_word)
    found = rows.select("_host", "_hash", "_id", F.posexplode(F.transform(lines, described)).alias("at", "found"))
    return found.select("_host", "_hash", "_id", "at", "found.*")


def boilerplate(rows: DataFrame, limits: LineLimits) -> DataFrame:
    """Of each document that loses lines: their hashes (``lost``) and all their words.

    Lines are hashed once, into a table that is deleted at the end. They are made distinct by (host, line, text) on
    the map side first, so copies of a document and a line repeated within one count once.
    """
    with scratch(rows.sparkSession):
        return stage(_lost(rows, stage(_lines(rows), "host-lines"), limits), "lost-lines", outlives=True)


def _lost(rows: DataFrame, lines: DataFrame, limits: LineLimits) -> DataFrame:
    hosts = (
        rows.groupBy("_host", "_hash").agg(F.lit(1).alias("one")).groupBy("_host")
        .agg(F.count("*").alias("docs"))
    )
    held = lines.groupBy("_host", "line", "_hash").agg(F.min("_id").alias("first"))
    frequent = (
        held.groupBy("_host", "line")
        .agg(F.count("*").alias("n"), F.min(F.struct("first", "_hash")).alias("first"))
        .where(F.col("n") > limits.max_docs)
        .join(hosts, "_host")
        .where(F.col("n") > limits.max_share * F.col("docs"))
        .select("_host", "line", "first")
    )
    lost = lines.join(frequent, ["_host", "line"]).where(
        ~F.struct("_id", "_hash").eqNullSafe(
            F.struct(F.col("first.first").alias("_id"), F.col("first._hash").alias("_hash"))
        )
    )
    # a set, as repeated rows have the same lines at the same places
    return lost.groupBy("_host", "_id", "_hash").agg(
        F.collect_set(F.struct("at", "line", "words")).alias("lines")
    ).select(
        "_host", "_id", "_hash",
        F.array_distinct(F.col("lines.line")).alias("lost"),
        F.aggregate("lines", F.lit(0).cast("long"), lambda n, x: n + x["words"]).alias("lost_words"),
    )


def judged(
    docs: DataFrame,
    limits: LineLimits = LineLimits(),
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    keep: list[str] | None = None,
    texts: bool = True,
) -> DataFrame:
    """``row`` (the document, or its columns ``keep``, as a struct), the counts, the verdict and, if
    ``texts``, the kept text. Without it, and without the text in ``keep``, texts are not shuffled."""
    carried = Carried(docs, text, keep)
    rows = keyed(docs, carried, key, host)
    lost = boilerplate(rows, limits).withColumnsRenamed({"_host": "h", "_id": "i", "_hash": "t"})
    counted = base_counts(rows, "_text")
    if not texts and text not in carried.names:
        counted = counted.drop("_text")
    # the texts are not sorted for it
    joined = counted.join(
        lost.hint("shuffle_hash"),
        (F.col("_hash") == F.col("t"))
        & F.col("_id").eqNullSafe(F.col("i"))
        & (F.col("_host") == F.col("h")),
        "left",
    )
    kept_lines = F.filter(
        F.split("_text", "\n"),
        lambda line: ~(
            has_word(line) & F.array_contains("lost", F.xxhash64(normalised(line)))
        ),
    )
    kept_text = F.when(F.col("lost").isNull(), F.col("_text")).otherwise(F.array_join(kept_lines, "\n"))
    kept_words = F.col("_base.n_words") - F.coalesce("lost_words", F.lit(0))
    depleted = F.col("lost").isNotNull() & (
        (kept_words < limits.min_words) | (kept_words < limits.min_kept * F.col("_base.n_words"))
    )
    failed = base_failed(F.col("_base"))
    return joined.select(
        carried.row,
        "_base.*",
        failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"),
        F.coalesce(F.size("lost"), F.lit(0)).alias("n_frequent_lines"),
        kept_words.alias("kept_words"),
        *([kept_text.alias("kept_text")] if texts else []),
    )
