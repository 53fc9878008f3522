"""Finding benchmark passages in documents by winnowing.

Words are runs of ASCII letters and digits or non-ASCII characters, with A-Z lowered. A passage is
``span`` consecutive words of a benchmark item; an item of fewer words is one passage. Documents and
items are winnowed: of the hashes of every ``GRAM`` words, the smallest in each window of ``span -
GRAM + 1`` is kept as a fingerprint, so two texts that share ``span`` words share a fingerprint. The
fingerprints of a document are joined with those of the benchmark, and each hit is extended to the
passages around it, compared by two hashes of 64 bits over all their words. For short items all
grams of their length are fingerprints.

The benchmark is a stated set that is far smaller than the corpus. It is taken in blocks of at most
``BLOCK_TEXT_BYTES`` of item texts (an item is never divided), so what is sent to the executors is
bounded whatever its size; each block is compared with all documents. Documents are read once per
block and never shuffled for a single block; with more blocks the hits are merged by document.

``scan`` gives a row for each document row: ``row`` (the document as a struct), ``n_words``,
``hits`` (spans of words hit, as starts and ends) and ``items`` (the item ids with occurring
passages, as sorted strings). Null texts and texts without words have no hits; items without words
contaminate nothing. A null item id marks words but is not listed. Repeated item ids are listed
once. Repeated document rows get equal results each. Empty tables are valid on both sides.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levelscope.llm.texts import (
    ALNUM, LOWER, RUN_BASES, Block, blocks, covered, members, ranges, run_hashes, runs, word_hashes,
    words,
)
from levelscope.llm.workers import mapped

SPAN = 10
GRAM = 5
BLOCK_TEXT_BYTES = 16 << 20


def winnowed(hashes: np.ndarray, found, span: int) -> np.ndarray:
    """The first words of the grams that are the minimum of some window within a text."""
    width = span - GRAM + 1
    grams = run_hashes(hashes, np.arange(max(0, len(found) - GRAM + 1)), GRAM)
    first = runs(found, span)
    if not len(first):
        return first
    views = np.lib.stride_tricks.sliding_window_view(grams, width)
    return np.unique(first + views[first].argmin(axis=1))


@dataclass(frozen=True)
class Passages:
    """Passages of one length: their sorted hashes, a check hash, and the items that have them."""

    length: int
    keys: np.ndarray
    checks: np.ndarray
    item_bounds: np.ndarray
    items: np.ndarray

    def found(self, hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the runs from ``starts`` on are passages, and which passages they are."""
        at = members(run_hashes(hashes, starts, self.length), self.keys)
        hit = np.flatnonzero(at >= 0)
        at = at[hit]
        same = run_hashes(hashes, starts[hit], self.length, RUN_BASES[1]) == self.checks[at]
        return starts[hit[same]], at[same]


@dataclass(frozen=True)
class Benchmark:
    """One block of items, as the tables that a scan needs."""

    names: list[str | None]
    long_prints: np.ndarray
    passages: dict[int, Passages]


def prepared(items: list[tuple[str | None, str]], span: int) -> Benchmark:
    prints = []
    found_of: dict[int, list[tuple[np.ndarray, np.ndarray, int]]] = defaultdict(list)
    for k, (_, text) in enumerate(items):
        for block in blocks(pa.array([text], pa.string())):
            found = words(block, ALNUM)
            if not len(found):
                continue
            hashes = word_hashes(block, found, LOWER)
            length = min(span, len(found))
            starts = runs(found, length)
            found_of[length].append(
                (run_hashes(hashes, starts, length), run_hashes(hashes, starts, length, RUN_BASES[1]), k)
            )
            if length == span:
                prints.append(run_hashes(hashes, winnowed(hashes, found, span), GRAM))
    passages = {}
    for length, parts in found_of.items():
        keys = np.concatenate([p[0] for p in parts])
        checks = np.concatenate([p[1] for p in parts])
        owner = np.concatenate([np.full(len(p[0]), p[2]) for p in parts])
        order = np.lexsort((owner, keys))
        keys, checks, owner = keys[order], checks[order], owner[order]
        distinct, first = np.unique(keys, return_index=True)
        bounds = np.append(first, len(keys))
        passages[length] = Passages(length, distinct, checks[first], bounds, owner)
    flat = np.unique(np.concatenate(prints)) if prints else np.zeros(0, np.uint64)
    return Benchmark([name for name, _ in items], flat, passages)


def block_hits(block: Block, bench: Benchmark, span: int):
    """Words of a block, which of them are hit, and pairs of a text and an item found in it."""
    found = words(block, ALNUM)
    hashes = word_hashes(block, found, LOWER)
    hit = np.zeros(len(found), bool)
    texts, items = [], []
    text_of = found.text_of()
    for length, passages in bench.passages.items():
        if length == span:
            grams = winnowed(hashes, found, span)
            near = grams[members(run_hashes(hashes, grams, GRAM), bench.long_prints) >= 0]
            # every passage that holds the gram, within the text
            lowest = np.maximum(near - (span - GRAM), found.bounds[text_of[near]])
            highest = np.minimum(near, found.bounds[text_of[near] + 1] - span)
            starts = np.unique(ranges(lowest, np.maximum(0, highest - lowest + 1)))
        else:
            starts = runs(found, length)
        starts, at = passages.found(hashes, starts)
        if not len(starts):
            continue
        hit |= covered(starts, length, len(found))
        counts = passages.item_bounds[at + 1] - passages.item_bounds[at]
        texts.append(np.repeat(text_of[starts], counts))
        items.append(passages.items[ranges(passages.item_bounds[at], counts)])
    pairs = np.zeros((0, 2), np.int64)
    if texts:
        pairs = np.unique(np.stack([np.concatenate(texts), np.concatenate(items)], axis=1), axis=0)
    return found, hit, pairs


def spans_of(hit: np.ndarray) -> list[int]:
    """Starts and ends of runs of hit words, alternating."""
    return np.flatnonzero(np.diff(hit.astype(np.int8), prepend=0, append=0)).tolist()


def _scan_block(rows: DataFrame, bench, span: int) -> DataFrame:
    """``rows`` has the columns row and text; adds words, hits and items of one block of items."""

    def run(batches):
        tables = bench.value
        for batch in batches:
            n_words, hits, items = [], [], []
            for block in blocks(batch.column("_text")):
                found, hit, pairs = block_hits(block, tables, span)
                n_words += found.counts.tolist()
                for t, any_hit in enumerate(np.isin(np.arange(len(block)), pairs[:, 0])):
                    if not any_hit:
                        hits.append([])
                        items.append([])
                        continue
                    hits.append(spans_of(hit[found.bounds[t] : found.bounds[t + 1]]))
                    names = {tables.names[k] for k in pairs[pairs[:, 0] == t, 1]} - {None}
                    items.append(sorted(names))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array(n_words, pa.int64()),
                    pa.array(hits, pa.list_(pa.int64())),
                    pa.array(items, pa.list_(pa.string())),
                ],
                ["row", "n_words", "hits", "items"],
            )

    schema = rows.select(
        "row",
        F.lit(0).cast("long").alias("n_words"),
        F.array(F.lit(0).cast("long")).alias("hits"),
        F.array(F.lit("")).alias("items"),
    ).schema
    return mapped(rows, run, schema)


def _merged(lists) -> Column:
    """The spans of several lists of starts and ends as one such list: sorted, without overlaps."""
    places = F.flatten(
        F.transform(
            lists,
            lambda h: F.transform(
                F.sequence(F.lit(0), (F.size(h) / 2).cast("int") - 1),
                lambda i: F.struct(F.get(h, 2 * i).alias("a"), F.get(h, 2 * i + 1).alias("b")),
            ),
        )
    )

    def add(done, span):
        last = F.element_at(done, -1)
        longer = F.struct(last.a.alias("a"), F.greatest(last.b, span.b).alias("b"))
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1)).b >= span.a)
        return F.when(joins, F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(
            F.concat(done, F.array(span))
        )

    none = F.array().cast("array<struct<a:bigint,b:bigint>>")
    spans = F.aggregate(F.array_sort(places), none, add)
    flat = F.flatten(F.transform(spans, lambda x: F.array(x.a, x.b)))
    return F.coalesce(flat, F.array().cast("array<bigint>"))


def scan(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    span: int = SPAN,
    block_bytes: int = BLOCK_TEXT_BYTES,
    keep: list[str] | None = None,
) -> DataFrame:
    """``keep``: the columns of the documents to return in ``row``, all by default."""
    spark = docs.sparkSession
    listed = benchmark.select(
        F.col(item).cast("string").alias("item"),
        F.coalesce(F.col(item_text), F.lit("")).alias("text"),
    )
    size = listed.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes) or 1
    blocks_of = listed.withColumn("block", F.pmod(F.xxhash64("item", "text"), F.lit(count)))
    rows = docs.select(F.struct(*(keep or docs.columns)).alias("row"), F.col(text).alias("_text"))

    def tables(k: int):
        part = blocks_of.where(F.col("block") == k) if count > 1 else listed
        rows_of = part.select("item", "text").toLocalIterator()
        return spark.sparkContext.broadcast(prepared([(r["item"], r["text"]) for r in rows_of], span))

    if count == 1:
        return _scan_block(rows, tables(0), span)
    # what is found depends on the text alone; a null one is as an empty one
    whole = F.coalesce("_text", F.lit(""))
    by_text = F.struct(F.xxhash64(whole).alias("x"), F.xxhash64(F.lit("again"), whole).alias("y"))
    keyed = rows.select(F.struct("row", by_text.alias("hash")).alias("row"), "_text")
    parts = [
        _scan_block(keyed, tables(k), span).where(F.size("hits") > 0).select(
            F.col("row.hash").alias("hash"), "hits", "items"
        )
        for k in range(count)
    ]
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    hits = together.groupBy("hash").agg(
        F.collect_set("hits").alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    counted = _scan_block(keyed, spark.sparkContext.broadcast(prepared([], span)), span)
    keyed_words = counted.select("row", "n_words", F.col("row.hash").alias("hash"))
    return keyed_words.join(hits, "hash", "left").select(
        F.col("row.row").alias("row"),
        "n_words",
        _merged("hits").alias("hits"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contaminated(found: DataFrame):
    return F.size("hits") > 0
