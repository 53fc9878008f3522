"""Removal of passages of ``SPAN`` words or more that an earlier document has, by fixed-block anchors.

Every document is cut into blocks of ``BLOCK`` words, one after the other; these are the anchors.
Any ``SPAN`` words hold a whole block, as ``2 * BLOCK - 1 <= SPAN``. All rolling windows of
``BLOCK`` words of all documents are looked up among the blocks. Where a window meets a block of
another document, the hit is extended: all runs of ``SPAN`` words around it are compared, by two
hashes of 64 bits, over all documents, and a run that also starts in a document with a smaller id is
removed. Neighbouring runs join to maximal repeats. Runs are judged on the input, not on what is
left.

Anchors and windows travel packed: per task and hash range one row of binary columns, with 4 bytes
of hash and 2 of position for a window. The lookup sorts a hash range in a task, blocks first, and
keeps for a block only its hash, its first document and whether there are others; so a passage
shared by any number of documents takes one entry, and windows stream by. Hits become counts by
group-by and join, whose skew Spark splits. Copies of a whole text are found by its hash beforehand
and lose all words without being compared again.

A null text has no words. Null ids are neither smaller nor larger than others: such documents lose
nothing and take nothing. Rows are told apart by id and text; repeated rows have equal results, and
an equal id is not smaller. An empty table gives an empty result; other columns may have any names.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levelscope.llm.rows import Carried
from levelscope.llm.texts import (
    RUN_BASES, SPACED, U64, blocks, covered, members, ranges, run_hashes, runs, word_hashes, words,
)
from levelscope.llm.workers import mapped
from levelscope.session import stage

SPAN = 50
BLOCK = 25
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Windows that a task packs together, and entries that it gathers before it folds them.
PACK_WINDOWS = 1_500_000
FOLD_ENTRIES = 2_000_000

PACKED = "part int, kind int, hashes binary, steps binary, owners binary, counts binary"


def _packed(hashes, owners, places, parts: int, kind: int):
    """Rows of PACKED: within a hash range, for each owner in turn, its hashes and places.

    ``places`` ascend per owner; the first is stored as it is, the others by their distance.
    """
    part = ((hashes >> U64(32)) * U64(parts) >> U64(32)).astype(np.uint16 if parts < 65536 else np.uint32)
    order = np.argsort(part, kind="stable")
    part, low = part[order], hashes[order].astype(np.uint32)
    owner, place = owners[order], places[order]
    fresh = np.ones(len(order), bool)
    fresh[1:] = (part[1:] != part[:-1]) | (owner[1:] != owner[:-1])
    step = place.copy()
    step[1:] -= np.where(fresh[1:], 0, place[:-1])
    firsts = np.flatnonzero(fresh)
    sizes = np.diff(np.append(firsts, len(order))).astype(np.uint32)
    distinct, cuts = np.unique(part, return_index=True)
    cuts = np.append(cuts, len(part))
    runs_at = np.searchsorted(firsts, cuts)
    rows: list[list] = [[], [], [], [], [], []]
    for p, a, b, i, j in zip(distinct.tolist(), cuts[:-1], cuts[1:], runs_at[:-1], runs_at[1:]):
        steps = step[a:b]
        steps = steps.astype(np.uint16 if steps.max() < 65536 else np.uint32)
        values = (p, kind, low[a:b], steps, owner[firsts[i:j]], sizes[i:j])
        for column, value in zip(rows, values):
            column.append(value.tobytes() if isinstance(value, np.ndarray) else value)
    types = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(rows, types)],
        ["part", "kind", "hashes", "steps", "owners", "counts"],
    )


def _unpacked(hashes: bytes, steps: bytes, owners: bytes, counts: bytes):
    low = np.frombuffer(hashes, np.uint32)
    step = np.frombuffer(steps, np.uint16 if len(steps) == 2 * len(low) else np.uint32)
    owner, sizes = np.frombuffer(owners, np.int64), np.frombuffer(counts, np.uint32).astype(np.int64)
    total = np.cumsum(step.astype(np.int64))
    firsts = np.cumsum(sizes) - sizes
    return low, total - np.repeat(total[firsts] - step[firsts], sizes), owner, sizes


def anchors_and_windows(rows: DataFrame, parts: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            ids = batch.column("rid").to_numpy(zero_copy_only=False)
            waiting, size = [], 0

            def flush():
                hashes, owners, places = (np.concatenate(c) for c in zip(*waiting))
                waiting.clear()
                aligned = places % BLOCK == 0
                yield _packed(hashes[aligned], owners[aligned], places[aligned], parts, 0)
                yield _packed(hashes, owners, places, parts, 1)

            for block in blocks(batch.column("_text")):
                found = words(block, SPACED)
                starts = runs(found, BLOCK)
                if not len(starts):
                    continue
                text = found.text_of()[starts]
                hashes = run_hashes(word_hashes(block, found), starts, BLOCK)
                waiting.append((hashes, ids[block.first + text], starts - found.bounds[text]))
                size += len(starts)
                if size > PACK_WINDOWS:
                    yield from flush()
                    size = 0
            if waiting:
                yield from flush()

    return mapped(rows.select("rid", "_text"), run, PACKED)


class _Blocks:
    """The blocks of one hash range: hash, first owner, and whether others have it too."""

    def __init__(self):
        self.waiting: list[tuple] = []
        self.size = 0
        self.keys, self.owner = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.several = np.zeros(0, bool)

    def add(self, keys: np.ndarray, owner: np.ndarray) -> None:
        self.waiting.append((keys, owner, np.zeros(len(keys), bool)))
        self.size += len(keys)
        if self.size > FOLD_ENTRIES:
            self.fold()

    def fold(self) -> None:
        if not self.waiting:
            return
        parts = [*self.waiting, (self.keys, self.owner, self.several)]
        keys, owner, several = (np.concatenate(c) for c in zip(*parts))
        order = np.argsort(keys, kind="stable")
        keys, owner, several = keys[order], owner[order], several[order]
        firsts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
        self.keys = keys[firsts]
        self.owner = np.minimum.reduceat(owner, firsts)
        self.several = np.logical_or.reduceat(several, firsts)
        self.several |= self.owner != np.maximum.reduceat(owner, firsts)
        self.waiting, self.size = [], 0


def hits(packed: DataFrame, parts: int) -> DataFrame:
    """``rid`` and places of windows that equal a block of another document (by 32 bits of hash and
    the hash range: a few are chance, and do no harm)."""

    def run(batches):
        part, index = None, _Blocks()
        for batch in batches:
            ids, places, bounds = [], [], [0]
            for k in range(batch.num_rows):
                p, kind, *columns = (batch.column(c)[k].as_py() for c in range(6))
                if p != part:
                    part, index = p, _Blocks()
                low, place, owner, sizes = _unpacked(*columns)
                if kind == 0:
                    index.add(low, np.repeat(owner, sizes))
                    continue
                index.fold()
                at = members(low, index.keys)
                whose = np.repeat(owner, sizes)
                hit = np.flatnonzero(at >= 0)
                hit = hit[index.several[at[hit]] | (index.owner[at[hit]] != whose[hit])]
                if len(hit):
                    firsts = np.flatnonzero(np.append(True, whose[hit][1:] != whose[hit][:-1]))
                    ids += whose[hit][firsts].tolist()
                    places.append(place[hit])
                    bounds += (np.append(firsts[1:], len(hit)) + bounds[-1]).tolist()
            if ids:
                flat = pa.array(np.concatenate(places), pa.int64())
                lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat)
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), lists], ["rid", "places"])

    dealt = packed.repartition(parts, "part").sortWithinPartitions("part", "kind")
    return mapped(dealt, run, "rid long, places array<long>")


def spans_around(candidates: DataFrame) -> DataFrame:
    """Hashes of the runs of ``SPAN`` words that hold a hit."""

    def run(batches):
        for batch in batches:
            asked = batch.column("places")
            sizes = asked.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat, ends = asked.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
            for block in blocks(batch.column("_text")):
                found = words(block, SPACED)
                hashes = word_hashes(block, found)
                some = slice(block.first, block.first + len(block))
                place = flat[(ends[some] - sizes[some])[0] : ends[some][-1]]
                text = np.repeat(np.arange(len(block)), sizes[some])
                lowest = np.maximum(found.bounds[text] + np.maximum(place - (SPAN - BLOCK), 0), 0)
                highest = np.minimum(found.bounds[text] + place, found.bounds[text + 1] - SPAN)
                starts = np.unique(ranges(lowest, np.maximum(highest - lowest + 1, 0)))
                owner = found.text_of()[starts]
                row = pa.array(owner + block.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(run_hashes(hashes, starts, SPAN).view(np.int64)),
                        pa.array(run_hashes(hashes, starts, SPAN, RUN_BASES[1]).view(np.int64)),
                        batch.column("doc_id").take(row),
                        batch.column("rid").take(row),
                        pa.array(starts - found.bounds[owner], pa.int64()),
                    ],
                    ["h", "g", "doc_id", "rid", "start"],
                )

    zero = F.lit(0).cast("long")
    schema = candidates.select(
        zero.alias("h"), zero.alias("g"), "doc_id", "rid", zero.alias("start")
    ).schema
    for field in schema:
        field.nullable = True
    return mapped(candidates.select("doc_id", "rid", "_text", "places"), run, schema)


def removed_runs(rows: DataFrame) -> DataFrame:
    """``rid``, ``starts`` of the runs to remove, and ``copy``: whether all words go.

    ``rows`` has ``rid``, ``doc_id`` and ``_text``.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = stage(hits(anchors_and_windows(rows, parts), parts), "hits")

    same = ["t", "u", "n"]
    texts = rows.where(F.col("doc_id").isNotNull() & F.col("_text").isNotNull()).select(
        "rid", "doc_id", F.xxhash64("_text").alias("t"), F.hash("_text").alias("u"),
        F.octet_length("_text").alias("n"),
    )
    firsts = texts.groupBy(*same).agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    copies = (
        texts.join(firsts.where("first != last"), same).where("doc_id > first")
        .select("rid").distinct()
    )
    copies = stage(copies, "copies")

    asked = found.groupBy("rid").agg(F.flatten(F.collect_list("places")).alias("places"))
    asked = asked.join(copies, "rid", "left_anti")
    candidates = stage(rows.join(asked, "rid").select("rid", "doc_id", "_text", "places"), "candidates")
    around = spans_around(candidates)
    owners = around.groupBy("h", "g").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    later = around.join(owners.where("first != last"), ["h", "g"]).where("doc_id > first")
    starts = later.groupBy("rid").agg(F.collect_list("start").alias("starts"))
    return starts.withColumn("copy", F.lit(False)).union(
        copies.select("rid", F.array().cast("array<long>").alias("starts"), F.lit(True).alias("copy"))
    )


def deduplicated(
    docs: DataFrame, key: str = "doc_id", text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``row`` (the document, or its columns ``keep``, as a struct), ``n_words``, ``n_removed`` and
    ``kept_text``, the kept words joined by single blanks (null for a null text)."""
    carried = Carried(docs, text, keep)
    rows = docs.select(
        *carried.columns, F.xxhash64(F.col(key), F.col(text)).alias("rid"), F.col(key).alias("doc_id")
    )
    gone = stage(removed_runs(rows.select("rid", "doc_id", "_text")), "removed")
    joined = rows.join(gone, "rid", "left").select("_rest", "_text", "starts", "copy")
    returned = ["_rest", *(["_text"] if text in carried.names else [])]

    def run(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            columns = (batch.column(c).to_pylist() for c in ("_text", "starts", "copy"))
            for body, starts, copy in zip(*columns):
                found = WORD.findall(body or "")
                n = len(found)
                n_words.append(n)
                if copy and n >= SPAN:
                    found = []
                elif starts:
                    lost = covered(np.unique(np.array(starts)), SPAN, n)
                    found = [found[k] for k in np.flatnonzero(~lost)]
                n_removed.append(n - len(found))
                kept.append(None if body is None else " ".join(found))
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in returned),
                    pa.array(n_words, pa.int64()),
                    pa.array(n_removed, pa.int64()),
                    pa.array(kept, pa.string()),
                ],
                [*returned, "n_words", "n_removed", "kept_text"],
            )

    zero = F.lit(0).cast("long")
    schema = joined.select(
        *returned, zero.alias("n_words"), zero.alias("n_removed"), F.lit("").alias("kept_text")
    ).schema
    for field in schema:
        field.nullable = True
    return mapped(joined, run, schema).select(carried.row, "n_words", "n_removed", "kept_text")
