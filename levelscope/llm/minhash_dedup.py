"""Near-duplicate documents by DartMinHash.

A document is the bag of its runs of ``SHINGLE`` words (A-Z lowered, words end at white space; a
shorter document is one run). A run with weight w, the number of times it occurs, owns the strip [0,
w) of a half plane whose other axis is the rank. Hashing throws the same darts into a strip wherever
the run occurs, one per unit of area on average: the strip is divided into unit cells by weight and
into steps by rank (halved repeatedly below rank 1), and a hash of (run, cell, step) says how many
darts fall there, and where. Each dart also has a coordinate of the signature, and the earliest dart
per coordinate is kept. Only ranks below T / (total weight) are looked at, where about T darts fall,
T being just over what it takes to hit all coordinates; if one stays empty the limit is doubled. So
a signature takes T darts, however many runs there are. Two documents agree in a coordinate with the
probability of their weighted Jaccard similarity, the sum of the smaller weights over the sum of the
larger.

Documents that agree in a band of coordinates are compared exactly (``similarity.linked``); those
with a similarity of at least ``threshold`` are linked. Documents of the same words are one node
from the start. A class is a component of linked documents; its id is its smallest document id, and
of the document rows with this id one is ``kept`` (of those with the smallest text hash).

Documents without words, null texts among them, are classes of their own and always kept; they have
a null class id only where their own id is null. Null ids are the smallest. Repeated rows are copies
like others: each has a row in the result, and one is kept; of rows that are equal in id and text, but
not in other columns, any one. An empty table gives an empty result. Other columns may have any names and types.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levelscope.llm.similarity import linked
from levelscope.llm.texts import (
    LOWER, MASK, SPACED, U64, Block, blocks, mix, run_hashes, runs, span_hashes, word_hashes, words,
)
from levelscope.llm.workers import mapped
from levelscope.session import stage

SHINGLE = 5
#: Rank steps: [0, 2 ** -DEEPEST), then doubling up to 1, then of width 1.
DEEPEST = 7
POISSON_TERMS = 24


@dataclass(frozen=True)
class Banding:
    """At a similarity of 0.8 a pair shares a band with probability 0.9993."""

    bands: int = 24
    rows: int = 6

    @property
    def coordinates(self) -> int:
        return self.bands * self.rows

    @property
    def darts(self) -> int:
        k = self.coordinates
        return ceil(k * log(k) + 2 * k)


def cells(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text: a hash of its words (0 without words), the bounds of its cells, the cells.

    A cell is a run of words with the number of equal runs before it in the text. So bags
    become sets, and the Jaccard similarity of the sets is the weighted one of the bags.
    """
    found = words(block, SPACED)
    hashes = word_hashes(block, found, LOWER)
    whole = span_hashes(hashes, found.bounds[:-1], found.bounds[1:], 0xA24BAED4963EE407)
    whole[found.counts == 0] = 0
    starts = runs(found, SHINGLE)
    values, owner = run_hashes(hashes, starts, SHINGLE), found.text_of()[starts]
    short = np.flatnonzero((found.counts > 0) & (found.counts < SHINGLE))
    if len(short):
        values = np.concatenate([values, whole[short]])
        owner = np.concatenate([owner, short])
        order = np.argsort(owner, kind="stable")
        values, owner = values[order], owner[order]
    tags = mix(values + mix(owner.astype(U64)))
    order = np.argsort(tags, kind="stable")
    tags = tags[order]
    fresh = np.ones(len(tags), bool)
    fresh[1:] = tags[1:] != tags[:-1]
    place = np.arange(len(tags))
    before = np.empty(len(tags), np.int64)
    before[order] = place - np.maximum.accumulate(np.where(fresh, place, 0))
    values = np.where(before == 0, values, mix(values + mix(before.astype(U64))))
    return whole, np.searchsorted(owner, np.arange(len(block) + 1)), values


def _poisson(width: float) -> np.ndarray:
    term = total = np.exp(-width)
    out = [total]
    for n in range(1, POISSON_TERMS):
        term *= width / n
        total += term
        out.append(total)
    return np.array(out)


def _steps(limit: float):
    """Rank steps from 0 up to the limit: number, start and width."""
    yield 0, 0.0, 2.0**-DEEPEST
    number, low = 1, 2.0**-DEEPEST
    while low < limit:
        width = min(low, 1.0)
        yield number, low, width
        number, low = number + 1, low + width


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> U64(11)).astype(np.float64) * 2.0**-53


def signatures(bounds: np.ndarray, values: np.ndarray, banding: Banding) -> np.ndarray:
    """The rank of the earliest dart, for each text and coordinate; all texts have cells."""
    k = banding.coordinates
    n = len(bounds) - 1
    out = np.full(n * k, np.inf)
    texts = np.arange(n)
    limits = banding.darts / np.diff(bounds)
    owner = np.repeat(texts, np.diff(bounds))
    while len(texts):
        highest = limits[texts].max()
        active = np.zeros(n, bool)
        active[texts] = True
        at = np.flatnonzero(active[owner])
        cell, text = values[at], owner[at]
        for number, low, width in _steps(highest):
            if number:
                going = limits[text] > low
                if not going.all():
                    cell, text = cell[going], text[going]
            seed = mix(cell + U64(number * 0x9E3779B97F4A7C15 & MASK))
            chance = _unit(seed)
            levels = _poisson(width)
            hit = np.flatnonzero(chance > levels[0])
            darts = np.searchsorted(levels, chance[hit], "left")
            place = np.repeat(hit, darts)
            first = np.cumsum(darts) - darts
            nth = np.arange(len(place)) - np.repeat(first, darts)
            thrown = mix(seed[place] + (nth + 1).astype(U64) * U64(0xD6E8FEB86659FD93))
            rank = low + width * _unit(thrown)
            good = rank < limits[text[place]]
            thrown, rank, place = thrown[good], rank[good], place[good]
            coordinate = (mix(thrown) >> U64(32)).astype(np.int64) * k >> 32
            np.minimum.at(out, text[place] * k + coordinate, rank)
        empty = np.isinf(out.reshape(n, k)).any(axis=1)
        texts = np.flatnonzero(empty)
        limits[texts] *= 2
    return out.reshape(n, k)


def band_keys(ranks: np.ndarray, banding: Banding) -> np.ndarray:
    bits = ranks.view(U64).reshape(len(ranks), banding.bands, banding.rows)
    keys = np.broadcast_to(np.arange(1, banding.bands + 1, dtype=U64), bits.shape[:2]).copy()
    for row in range(banding.rows):
        keys = mix(keys * U64(31) + bits[:, :, row])
    return keys


def sketched(rows: DataFrame, banding: Banding) -> DataFrame:
    """Adds ``node``, the hash of the words, and ``bands``; both null without words."""

    def run(batches):
        for batch in batches:
            nodes, keys = [], []
            for block in blocks(batch.column("_text")):
                whole, bounds, values = cells(block)
                there = np.flatnonzero(whole)
                keep = np.concatenate([bounds[there], bounds[-1:]])
                made = band_keys(signatures(keep, values, banding), banding).view(np.int64)
                filled = iter(made.tolist())
                nodes += [int(x) if x else None for x in whole.view(np.int64)]
                keys += [next(filled) if x else None for x in whole]
            fixed = [batch.column(c) for c in batch.schema.names if c != "_text"]
            names = [c for c in batch.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*fixed, pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))],
                [*names, "node", "bands"],
            )

    schema = rows.drop("_text").select(
        "*",
        F.lit(0).cast("long").alias("node"),
        F.array(F.lit(0).cast("long")).alias("bands"),
    ).schema
    for field in schema:
        field.nullable = True
    return mapped(rows, run, schema)


def bags(rows: DataFrame) -> DataFrame:
    """``id`` and the cells (``elements``) of the texts in ``_text``."""

    def run(batches):
        for batch in batches:
            elements = []
            for block in blocks(batch.column("_text")):
                _, bounds, values = cells(block)
                elements.append(
                    pa.ListArray.from_arrays(
                        pa.array(bounds.astype(np.int32)), pa.array(values.view(np.int64))
                    )
                )
            both = pa.concat_arrays(elements) if elements else pa.array([], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column("id"), both], ["id", "elements"])

    return mapped(rows.select("id", "_text"), run, "id long, elements array<long>")


def classes(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    threshold: float = 0.8,
    banding: Banding = Banding(),
) -> DataFrame:
    """A row for each document row: ``doc_id``, ``row_hash``, ``class_id``, ``class_size`` and ``kept``,
    which holds for one row of each class."""
    folded = folded_classes(docs, key, text, threshold, banding)
    each = folded.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    return each.withColumn("kept", F.col("kept") & (F.col("copy") == 1)).drop("copies", "copy")


def _hash(text: str) -> Column:
    return F.xxhash64(F.col(text), F.col(text).isNull())


def folded_classes(
    docs: DataFrame, key: str, text: str, threshold: float = 0.8, banding: Banding = Banding()
) -> DataFrame:
    """As :func:`classes`, with a row for rows that are equal in id and text, and ``copies``, how many they are."""
    rows = docs.select(
        F.col(key).alias("doc_id"), _hash(text).alias("row_hash"), F.col(text).alias("_text")
    )
    table = stage(sketched(rows, banding), "sketches")
    nodes = (
        table.where("node is not null")
        .groupBy("node")
        .agg(F.min_by(F.struct("doc_id", "row_hash", "bands"), F.struct("doc_id", "row_hash")).alias("first"))
    )
    members = nodes.select(
        F.col("node").alias("id"), F.explode(F.col("first.bands")).alias("key")
    )

    def features_of(ids: DataFrame) -> DataFrame:
        firsts = nodes.join(ids.withColumnRenamed("id", "node"), "node", "left_semi").select(
            F.col("node").alias("id"), F.col("first.doc_id").alias("d"), F.col("first.row_hash").alias("h")
        )
        texts = rows.join(
            firsts, (F.col("row_hash") == F.col("h")) & F.col("doc_id").eqNullSafe(F.col("d"))
        )
        return bags(texts).dropDuplicates(["id"])

    roots = linked(members, features_of, threshold, "documents")
    folded = table.groupBy("doc_id", "row_hash", "node").agg(F.count("*").alias("copies"))
    labelled = folded.join(roots.withColumnRenamed("id", "node"), "node", "left").select(
        "doc_id",
        "row_hash",
        "copies",
        # documents without words are alone: their own row names them
        F.coalesce("root", "node", "row_hash").alias("label"),
        F.when(F.col("node").isNull(), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("alone"),
    )
    heads = labelled.groupBy("label", "alone").agg(
        F.min(F.struct("doc_id", "row_hash")).alias("head"), F.sum("copies").alias("class_size")
    )
    return labelled.join(
        heads.withColumnsRenamed({"label": "l", "alone": "o"}),
        (F.col("label") == F.col("l")) & F.col("alone").eqNullSafe(F.col("o")),
    ).select(
        "doc_id",
        "row_hash",
        "copies",
        F.col("head.doc_id").alias("class_id"),
        "class_size",
        F.struct("doc_id", "row_hash").eqNullSafe(F.col("head")).alias("kept"),
    )


def deduplicated(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents without near-duplicates: of each class one row with the kept id and text."""
    kept = folded_classes(docs, key, text, **options).where("kept").select(
        F.col("doc_id").alias("_d"), F.col("row_hash").alias("_h"), F.col("copies").alias("_n")
    )
    kept = stage(kept, "kept")
    rows = docs.select(F.struct("*").alias("_row"), _hash(text).alias("_r"))
    joined = rows.join(kept, (F.col("_r") == F.col("_h")) & F.col(f"_row.{key}").eqNullSafe(F.col("_d")))
    once = joined.where("_n = 1").select("_row")
    if not kept.where("_n > 1").isEmpty():
        once = once.union(joined.where("_n > 1").dropDuplicates(["_d", "_h"]).select("_row"))
    return once.select("_row.*")
