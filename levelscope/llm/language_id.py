"""Language identification: words first, backing off to shorter and shorter character n-grams.

The words of all documents are counted once, by language (a Spark group-by); documents that are not to be
learned from are counted without one. From the counts come the character n-grams of the words of each language (of
``LONGEST`` characters down to one, with a mark at the word's ends). All words and all n-grams are the
model; it is a table and stays one.

The distinct words of the documents asked about are scored once each: those of the model by a join
with its words, the others by joins with its n-grams, of which only those reach the next shorter ones
that no n-gram has matched. The scores of the ``HOT_WORDS`` most frequent words are also sent to the
executors, so that only rarer ones are shuffled; this does not change a result.

A word of the model scores its log frequency in each language, smoothed. Any other word scores by
its longest n-grams if the model has one of them, else by the next shorter ones, and so on: the mean
of the log frequencies of those known. A text's score is the sum over its words, less the largest,
as probabilities; ``score`` is that of the language predicted, tempered by the number of words. Ties
go to the language that comes first in alphabetical order. Scores of words are whole multiples of
1 / ``SCALE``, so sums do not depend on their order.

A text that is null or has no letter is ``und`` with score 0; so is every text if there is nothing
to learn from. Letters are Unicode letters; words are runs of letters in lower case. Null languages
are not learned. Repeated rows count as often as they occur. An empty table gives an empty result.
Other columns may have any names.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levelscope.llm.token_counts import parts, texts_of
from levelscope.llm.workers import mapped
from levelscope.session import stage

LETTERS = regex.compile(r"\p{L}+")
LONGEST = 5
#: Words, or n-grams, counted in a task before they are handed on.
COUNT_ENTRIES = 400_000
#: Words, and numbers of their scores, that are sent to the executors.
HOT_WORDS = 200_000
HOT_NUMBERS = 4_000_000
SCALE = 1 << 24
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _is_letter() -> np.ndarray:
    """For each code point whether it is a letter."""
    out = np.zeros(0x110000, bool)
    for first, end in ((0, 0xD800), (0xE000, 0x110000)):
        letters = "".join(LETTERS.findall("".join(map(chr, range(first, end)))))
        out[np.frombuffer(letters.encode("utf-32-le"), np.uint32)] = True
    return out


def cut(texts: list[str]) -> list[list[str]]:
    """The words of each text: runs of letters, in lower case."""
    lower = [text.lower() for text in texts]
    codes = np.frombuffer("\n".join(lower).encode("utf-32-le"), np.uint32)
    ends = np.cumsum([len(text) + 1 for text in lower])[:-1] - 1
    codes = np.where(_is_letter()[codes], codes, np.uint32(0x20))
    codes[ends] = 0x0A
    return [line.split() for line in codes.tobytes().decode("utf-32-le").split("\n")]


def grams(word: str, n: int) -> list[str]:
    """The runs of ``n`` characters of a word with marks at its ends."""
    marked = f"^{word}$"
    return [marked[i : i + n] for i in range(len(marked) - n + 1)] if n > 1 else list(word)


def word_counts(docs: DataFrame) -> DataFrame:
    """``lang`` (or null), ``word`` and ``n`` over all ``_text``, with the ``lang`` that each is to teach."""

    def run(batches):
        counts: dict[str, Counter] = {}

        def flush():
            langs = [lang for lang, found in counts.items() for _ in found]
            words = [word for found in counts.values() for word in found]
            n = [k for found in counts.values() for k in found.values()]
            counts.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array(words, pa.string()), pa.array(n, pa.int64())],
                ["lang", "word", "n"],
            )

        for part in (part for batch in batches for part in parts(batch)):
            for words, lang in zip(cut(texts_of(part)), part.column("lang").to_pylist()):
                counts.setdefault(lang, Counter()).update(words)
                if sum(map(len, counts.values())) > COUNT_ENTRIES:
                    yield flush()
        yield flush()

    return mapped(docs.select("lang", "_text"), run, "lang string, word string, n long").groupBy(
        "lang", "word"
    ).agg(F.sum("n").alias("n"))


def gram_counts(counted: DataFrame) -> DataFrame:
    """``lang``, ``size``, ``gram`` and ``n`` from word counts."""

    sizes = range(1, LONGEST + 1)

    def run(batches):
        tables: dict[str, list[dict[str, int]]] = {}

        def flush():
            flat = [(lang, size, table) for lang, by in tables.items() for size, table in zip(sizes, by)]
            counts = [len(table) for _, _, table in flat]
            tables.clear()
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.array([f[0] for f in flat], object), counts), pa.string()),
                    pa.array(np.repeat([f[1] for f in flat], counts), pa.int32()),
                    pa.array([g for _, _, table in flat for g in table], pa.string()),
                    pa.array([n for _, _, table in flat for n in table.values()], pa.int64()),
                ],
                ["lang", "size", "gram", "n"],
            )

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("lang", "word", "n"))
            for lang, word, n in zip(*columns):
                by = tables.get(lang)
                if by is None:
                    by = tables[lang] = [defaultdict(int) for _ in sizes]
                single = by[0]
                for c in word:
                    single[c] += n
                marked = f"^{word}$"
                for size in sizes[1:]:
                    table = by[size - 1]
                    for i in range(len(marked) - size + 1):
                        table[marked[i : i + size]] += n
            if sum(len(table) for by in tables.values() for table in by) > COUNT_ENTRIES:
                yield flush()
        if tables:
            yield flush()

    # the words are few bytes, but much work each: more tasks than for reading them
    spread = counted.select("lang", "word", "n").repartition("word")
    found = mapped(spread, run, "lang string, size int, gram string, n long")
    return found.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Model:
    """Log frequencies per language: of words (size 0) and of n-grams by their size."""

    langs: list[str]
    tables: dict[int, dict[str, tuple[float, ...]]]


@dataclass(frozen=True)
class Trained:
    """The whole model: ``entries`` has ``size``, ``gram`` and ``by``, its count in each language."""

    langs: list[str]
    entries: DataFrame
    totals: dict[tuple[str, int], int]
    distinct: dict[int, int]

    def of_size(self, size: int) -> DataFrame:
        """``gram`` and ``values``, its log frequencies."""
        smooth = 0.5 * (self.distinct.get(size, 0) + 1)
        values = [
            F.log(
                (F.coalesce(F.col("by")[lang], F.lit(0)) + 0.5)
                / F.lit(self.totals.get((lang, size), 0) + smooth)
            )
            for lang in self.langs
        ]
        return self.entries.where(F.col("size") == size).select("gram", F.array(*values).alias("values"))


def trained(counts: DataFrame) -> Trained:
    """``counts`` is a written table of ``word_counts``."""
    counted = counts.where(F.col("lang").isNotNull())
    sized = counted.select(
        "lang", F.lit(0).alias("size"), F.col("word").alias("gram"), "n"
    ).unionByName(gram_counts(counted))
    by = F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by")
    entries = stage(sized.groupBy("size", "gram").agg(by), "entries")
    sums = (
        entries.select("size", F.explode("by").alias("lang", "n"))
        .groupBy("lang", "size").agg(F.sum("n").alias("total")).collect()
    )
    totals = {(r["lang"], r["size"]): r["total"] for r in sums}
    distinct = {r["size"]: r["count"] for r in entries.groupBy("size").count().collect()}
    return Trained(sorted({lang for lang, _ in totals}), entries, totals, distinct)


class Scorer:
    """Scores of words by a model in memory, or by the part of one that the words need."""

    def __init__(self, model: Model):
        self.langs, self.tables = model.langs, model.tables

    def word(self, word: str):
        known = self.tables[0].get(word)
        if known is not None:
            return known
        for size in range(LONGEST, 0, -1):
            table = self.tables[size]
            found = [table[g] for g in grams(word, size) if g in table]
            if found:
                return np.mean(found, axis=0)
        return 0.0


def _backed_off(words: DataFrame, model: Trained, size: int) -> DataFrame:
    """``word`` and ``values`` of those words of which the model has an n-gram of this size."""
    langs = model.langs

    def pieces(batches):
        for batch in batches:
            found = [(w, g) for w in batch.column("word").to_pylist() for g in dict.fromkeys(grams(w, size))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.string()) for k in (0, 1)], ["word", "gram"]
            )

    def scored(batches):
        for batch in batches:
            words = batch.column("word").to_pylist()
            tables: dict[int, dict] = {n: {} for n in range(LONGEST + 1)}
            for entries in batch.column("entries").to_pylist():
                tables[size].update((e["gram"], e["values"]) for e in entries)
            scorer = Scorer(Model(langs, tables))
            values = [list(scorer.word(word)) for word in words]
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), pa.array(values, pa.list_(pa.float64()))], ["word", "values"]
            )

    known = (
        mapped(words.select("word"), pieces, "word string, gram string")
        .join(model.of_size(size), "gram")
        .groupBy("word").agg(F.collect_list(F.struct("gram", "values")).alias("entries"))
    )
    return mapped(known, scored, "word string, values array<double>")


def word_scores(asked: DataFrame, model: Trained) -> DataFrame:
    """``word``, ``n`` and ``scores`` (in units of 1 / ``SCALE``) of distinct words (``word``, ``n``)."""
    words = model.of_size(0).withColumnRenamed("gram", "word")
    turn = stage(asked.join(words, "word", "left"), "known-words")
    found = turn.where("values is not null")
    for size in range(LONGEST, 0, -1):
        missed = turn.where("values is null").select("word", "n")
        if missed.isEmpty():
            break
        turn = stage(missed.join(_backed_off(missed, model, size), "word", "left"), f"backoff-{size}")
        found = found.union(turn.where("values is not null"))
    found = found.union(turn.where("values is null"))
    nothing = F.array(*[F.lit(0.0)] * len(model.langs))
    scores = F.transform(F.coalesce("values", nothing), lambda x: F.round(x * SCALE).cast("long"))
    return found.select("word", "n", scores.alias("scores"))


def _sums(docs: DataFrame, scored: DataFrame, n_langs: int, hot: int) -> DataFrame:
    """``_row``, ``n_words`` and ``total``, the sum of the scores of its words, of all ``_text``."""
    best = scored.orderBy(F.desc("n"), "word").limit(min(hot, HOT_NUMBERS // n_langs))
    best = best.select("word", "scores").toArrow().combine_chunks()
    table = np.array(best.column("scores").combine_chunks().flatten(), np.int64).reshape(-1, n_langs)
    shared = docs.sparkSession.sparkContext.broadcast((best.column("word").to_pylist(), table))

    def run(batches):
        names, scores = shared.value
        place = {name: k for k, name in enumerate(names)}
        for part in (part for batch in batches for part in parts(batch)):
            n_words, totals, rest = [], [], []
            for words in cut(texts_of(part)):
                known = [k for k in map(place.get, words) if k is not None]
                n_words.append(len(words))
                totals.append(scores[known].sum(axis=0) if known else np.zeros(n_langs, np.int64))
                rare = Counter(w for w in words if w not in place) if len(known) < len(words) else {}
                rest.append([{"word": w, "n": n} for w, n in rare.items()])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("_row"),
                    pa.array(n_words, pa.int64()),
                    pa.array(totals, pa.list_(pa.int64())),
                    pa.array(rest, pa.list_(pa.struct([("word", pa.string()), ("n", pa.int64())]))),
                ],
                ["_row", "n_words", "total", "rest"],
            )

    schema = docs.select(
        "_row",
        F.lit(0).cast("long").alias("n_words"),
        F.array(F.lit(0).cast("long")).alias("total"),
        F.array(F.struct(F.lit("").alias("word"), F.lit(0).cast("long").alias("n"))).alias("rest"),
    ).schema
    table = stage(
        mapped(docs, run, schema).withColumn("_id", F.monotonically_increasing_id()), "hot-sums"
    )
    more = (
        table.select("_id", F.explode("rest").alias("found")).select("_id", "found.word", F.col("found.n").alias("k"))
        .join(scored.select("word", "scores"), "word")
        .groupBy("_id").agg(F.array(*[F.sum(F.col("k") * F.col("scores")[i]) for i in range(n_langs)]).alias("more"))
    )
    both = F.when(F.col("more").isNull(), F.col("total")).otherwise(
        F.zip_with("total", "more", lambda x, y: x + y)
    )
    return table.select("_id", "_row", "n_words", "total").join(more, "_id", "left").select(
        "_row", "n_words", both.alias("total")
    )


def predicted(
    docs: DataFrame,
    model: Trained,
    text: str = "text",
    keep: list[str] | None = None,
    hot: int = HOT_WORDS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Adds ``lang_pred`` and ``score`` (replacing columns of these names) to ``keep``, the columns
    to return, all by default. ``hot`` words at most are sent to the executors. ``counts`` are the ``word_counts`` of
    these texts, if they are known."""
    langs = model.langs
    kept = [c for c in keep or docs.columns if c not in ("lang_pred", "score")]
    rows = docs.select(F.struct(*kept).alias("_row"), F.col(text).alias("_text"))
    if not langs:
        return rows.select("_row.*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    if counts is None:
        counts = word_counts(rows.select(F.lit("").alias("lang"), "_text"))
    asked = counts.groupBy("word").agg(F.sum("n").alias("n"))
    scored = stage(word_scores(asked, model), "scores")

    def run(batches):
        for batch in batches:
            out = []
            for n_words, sums in zip(batch.column("n_words").to_pylist(), batch.column("total").to_pylist()):
                if not n_words:
                    out.append((UNKNOWN, 0.0))
                    continue
                total = np.array(sums, np.int64)
                best = int(total.argmax())
                chance = np.exp((total - total[best]) / SCALE / n_words**0.5)
                out.append((langs[best], float(chance[best] / chance.sum())))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    pa.array([lang for lang, _ in out], pa.string()),
                    pa.array([score for _, score in out], pa.float64()),
                ],
                ["_row", "lang_pred", "score"],
            )

    schema = rows.select("_row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    return mapped(_sums(rows, scored, len(langs), hot), run, schema).select("_row.*", "lang_pred", "score")
