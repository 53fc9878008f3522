"""Token counts by rank-synchronous merging of pre-tokens held as ragged arrays.

A text is cut at its special strings and by the pre-token pattern. The distinct pre-tokens of a
block lie end to end in one array of symbols; each step finds the lowest-ranked adjacent pair of
every sequence and applies it everywhere in that sequence, for all sequences at once, until no
sequence has a pair left. What survives is the count; it is all that is kept. A pre-token of more than
``LONG`` bytes is worked on alone: the places of its pairs are kept by rank, and only the
neighbours of merged places are looked up again, so that its time is in proportion to its length.

``with_token_counts`` keeps all columns and adds ``n_bytes`` and ``n_tokens`` (replacing columns of
these names). A null text counts as empty. Rows are independent: repeated rows are counted each, an
empty table gives an empty table, and a text is never cut short.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levelscope.llm.texts import utf8
from levelscope.llm.vocabulary import byte_symbols, shipped, special_pattern
from levelscope.llm.workers import mapped

#: The pre-token pattern of byte-level BPE files whose pre-tokenizer has ``use_regex``.
PRE_TOKENS = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
NONE = np.int32(1 << 30)
#: Bytes from which a pre-token is merged by lists of places.
LONG = 2048
#: Pre-tokens kept with their counts from block to block, and bytes merged in one go.
CACHE_ENTRIES = 400_000
STEP_BYTES = 1 << 20


class PairTable:
    """Ranks of symbol pairs, found for whole arrays at a time (open addressing)."""

    def __init__(self, pairs: np.ndarray):
        self.bits = max(4, int(4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int32)
        waiting, slots = np.arange(len(pairs)), self._slots(pairs)
        while len(waiting):
            free = self.keys[slots] < 0
            first = np.unique(slots[free], return_index=True)[1]
            placed = np.flatnonzero(free)[first]
            self.keys[slots[placed]] = pairs[waiting[placed]]
            self.ranks[slots[placed]] = waiting[placed]
            rest = np.ones(len(waiting), bool)
            rest[placed] = False
            waiting, slots = waiting[rest], (slots[rest] + 1) & (len(self.keys) - 1)

    def _slots(self, pairs: np.ndarray) -> np.ndarray:
        spread = pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (spread >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, pairs: np.ndarray) -> np.ndarray:
        slots = self._slots(pairs)
        there = self.keys[slots]
        out = np.where(there == pairs, self.ranks[slots], NONE)
        open_ = np.flatnonzero((there != pairs) & (there >= 0))
        slots = slots[open_]
        while len(open_):
            slots = (slots + 1) & (len(self.keys) - 1)
            there = self.keys[slots]
            same = there == pairs[open_]
            out[open_[same]] = self.ranks[slots[same]]
            more = ~same & (there >= 0)
            open_, slots = open_[more], slots[more]
        return out


class Counter:
    """Counts the tokens of texts for one vocabulary file."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        ids = spec["model"]["vocab"]
        self.special = special_pattern(spec)
        self.symbol = np.array([ids[s] for s in byte_symbols()], np.int64)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        left, right = (np.array([ids[m[k]] for m in merges], np.int64) for k in (0, 1))
        self.made = np.array([ids[a + b] for a, b in merges], np.int64)
        self.joined = left << 32 | right
        self.pairs = PairTable(self.joined)
        self.known: dict[str, int] = {}

    def merge_long(self, sequence: bytes) -> int:
        """The number of symbols left of one sequence.

        A pair that a merge makes has a higher rank than the merge, as its symbol must have been made first: so
        each rank comes up once, with all its places.
        """
        symbols = self.symbol[np.frombuffer(sequence, np.uint8)]
        n = len(symbols)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        there, left = np.ones(n, bool), n
        places: dict[int, list[np.ndarray]] = {}
        ranks: list[int] = []

        def note(at: np.ndarray) -> None:
            rank = self.pairs.find(symbols[at] << 32 | symbols[after[at]])
            at, rank = at[rank < NONE], rank[rank < NONE]
            order = np.argsort(rank, kind="stable")
            at, rank = at[order], rank[order]
            bounds = [0, *(np.flatnonzero(np.diff(rank)) + 1).tolist(), len(at)] if len(at) else []
            for a, b in zip(bounds, bounds[1:]):
                of = int(rank[a])
                if of not in places:
                    places[of] = []
                    heappush(ranks, of)
                places[of].append(at[a:b])

        note(np.arange(n - 1))
        while ranks:
            rank = heappop(ranks)
            at = np.unique(np.concatenate(places.pop(rank)))
            at = at[there[at] & (after[at] < n)]
            at = at[(symbols[at] << 32 | symbols[after[at]]) == self.joined[rank]]
            if not len(at):
                continue
            # of overlapping pairs every other is taken
            follows = np.zeros(len(at), bool)
            follows[1:] = after[at[:-1]] == at[1:]
            run = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            gone = after[at]
            there[gone] = False
            symbols[at] = self.made[rank]
            after[at] = after[gone]
            inner = after[at] < n
            before[after[at[inner]]] = at[inner]
            left -= len(at)
            earlier = before[at]
            note(np.unique(np.concatenate([at[inner], earlier[earlier >= 0]])))
        return left

    def merge(self, sequences: list[bytes]) -> np.ndarray:
        """The number of symbols left of each non-empty sequence."""
        if any(len(s) > LONG for s in sequences):
            long = [len(s) > LONG for s in sequences]
            out = np.zeros(len(sequences), np.int64)
            out[long] = [self.merge_long(s) for s in sequences if len(s) > LONG]
            short = [s for s in sequences if len(s) <= LONG]
            if short:
                out[np.logical_not(long)] = self.merge(short)
            return out
        lengths = np.fromiter(map(len, sequences), np.int64, len(sequences))
        out = np.zeros(len(sequences), np.int64)
        symbols = self.symbol[np.frombuffer(b"".join(sequences), np.uint8)]
        alive = np.arange(len(sequences))
        while len(alive):
            starts = np.cumsum(lengths) - lengths
            last = np.zeros(len(symbols), bool)
            last[starts + lengths - 1] = True
            rank = np.full(len(symbols), NONE, np.int32)
            inner = np.flatnonzero(~last)
            rank[inner] = self.pairs.find(symbols[inner] << 32 | symbols[inner + 1])
            lowest = np.minimum.reduceat(rank, starts)
            going = lowest < NONE
            out[alive[~going]] = lengths[~going]
            # the places of each sequence's lowest pair; of overlapping ones every other is taken
            at = np.flatnonzero((rank == np.repeat(lowest, lengths)) & (rank < NONE))
            follows = np.zeros(len(at), bool)
            follows[1:] = at[1:] == at[:-1] + 1
            run = np.maximum.accumulate(np.where(follows, 0, np.arange(len(at))))
            at = at[(np.arange(len(at)) - run) % 2 == 0]
            symbols[at] = self.made[rank[at]]
            keep = np.repeat(going, lengths)
            keep[at + 1] = False
            gone = np.zeros(len(symbols), np.int64)
            gone[at + 1] = 1
            lengths = lengths - np.add.reduceat(gone, starts)
            symbols, lengths, alive = symbols[keep], lengths[going], alive[going]
        return out

    def learn(self, tokens: set[str]) -> None:
        if len(self.known) + len(tokens) > CACHE_ENTRIES:
            self.known.clear()
        batch, size = [], 0
        for token in tokens:
            batch.append(token)
            size += len(token)
            if size > STEP_BYTES:
                self.known.update(zip(batch, self.merge([t.encode() for t in batch]).tolist()))
                batch, size = [], 0
        if batch:
            self.known.update(zip(batch, self.merge([t.encode() for t in batch]).tolist()))

    def count(self, texts: list[str]) -> list[int]:
        found, extra = [], []
        for text in texts:
            pieces = self.special.split(text) if self.special else [text]
            extra.append(len(pieces) - 1)
            tokens: list[str] = []
            for piece in pieces:
                tokens += PRE_TOKENS.findall(piece)
            found.append(tokens)
        new = set().union(*found) - self.known.keys()
        if new:
            if len(self.known) + len(new) > CACHE_ENTRIES:  # the cache starts anew
                new = set().union(*found)
            self.learn(new)
        count = self.known.__getitem__
        return [n + sum(map(count, tokens)) for n, tokens in zip(extra, found)]


@lru_cache(maxsize=4)
def counter(vocabulary: str) -> Counter:
    return Counter(vocabulary)


def parts(batch: pa.RecordBatch, size: int = STEP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``size`` bytes of ``_text``, so that a task holds little at once."""
    _, bounds = utf8(batch.column("_text"))
    i, n = 0, batch.num_rows
    while i < n:
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + size, "right")) - 1)
        yield batch.slice(i, j - i)
        i = j


def texts_of(batch: pa.RecordBatch) -> list[str]:
    return [text or "" for text in batch.column("_text").to_pylist()]


def with_token_counts(
    df: DataFrame, vocabulary_file: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``keep``: the columns to return besides the counts, all by default."""
    shared = shipped(df.sparkSession, vocabulary_file)
    kept = [c for c in keep or df.columns if c not in ("n_bytes", "n_tokens")]

    def run(batches):
        counts = counter(shared.value)
        for part in (part for batch in batches for part in parts(batch)):
            n = pa.array(counts.count(texts_of(part)), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column("_row"), part.column("n_bytes"), n], ["_row", "n_bytes", "n_tokens"]
            )

    rows = df.select(
        F.struct(*kept).alias("_row"),
        F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text).alias("_text"),
    )
    schema = rows.select("_row", "n_bytes", F.lit(0).cast("long").alias("n_tokens")).schema
    return mapped(rows, run, schema).select("_row.*", "n_bytes", "n_tokens")
