"""Detection of periodic runs of words by string synchronising sets.

A run is a stretch of consecutive words of one text with smallest period q (words q apart are equal), of at
least twice q, that no neighbouring word extends. Texts are treated as strings of word hashes, all texts of a
block at once, with a separator of its own between two of them.

For periods in ``[3 t - 1, 6 t - 1)``, t = 2, 4, 8, ..., a set of places is chosen by hashes: each place has the hash
of its t words, places where those have a period of at most t / 3 have none, and a place is in the set if
the smallest hash of the t + 1 places from it on is its own or that of the last. Whether a place is in the set
depends on its 2 t words alone, and in every stretch of t places there is one, unless the 3 t - 1 words from
its start on have a period of at most t / 3. So in a run there are two places of the set, one period apart, with the
same 2 t words. Two such places are more than t / 3 apart, so the pairs of places with equal words whose
distance is in the range are fewer than 18 for a place: these distances are the periods proposed.

What this leaves out has small periods, and comes from the highly periodic regions:

* periods up to ``DIRECT`` are found by comparing each word with the one so many places on;
* where one whole period of a run is itself periodic with some smaller p, so are the next one's words, and two
  regions of period p lie side by side in the run, out of step. For two regions that touch, all shifts
  that bring them in step are proposed.

A proposal is extended to both sides by hashes of spans, kept if it is as long as twice its period, and
dropped if a divisor of it is a period too. Words and spans are compared by 64-bit hashes.

A text is worked on as a whole in one task, in arrays of some hundred bytes for each of its words; nothing is
shuffled. Null and empty texts and texts of blanks have no words and no runs. Equal rows get equal results. An
empty table gives an empty result, and other columns may have any names.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levelscope.llm.rows import Carried
from levelscope.llm.texts import (
    RUN_BASES, SPACED, U64, blocks, inverse, mix, powers, ranges, word_hashes, words,
)
from levelscope.llm.workers import mapped

LEAST_WORDS = 12
DIRECT = 4
NONE = np.iinfo(np.uint64).max


class Symbols:
    """Words of texts as one string; text d has the places ``starts[d]`` to ``ends[d] - 1`` of it."""

    def __init__(self, hashes: np.ndarray, bounds: np.ndarray):
        texts = len(bounds) - 1
        self.counts = np.diff(bounds)
        self.starts = bounds[:-1] + np.arange(texts)
        self.ends = self.starts + self.counts
        self.values = np.empty(len(hashes) + texts, U64)
        self.values[ranges(self.starts, self.counts)] = hashes
        self.values[self.ends] = mix(np.arange(texts, dtype=U64) * U64(RUN_BASES[1]) + U64(RUN_BASES[0]))
        n = len(self.values)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(self.values * powers(RUN_BASES[0], n), out=self.sums[1:])
        self.back = powers(inverse(RUN_BASES[0]), n + 1)

    def __len__(self) -> int:
        return len(self.values)

    def span(self, starts: np.ndarray, length) -> np.ndarray:
        """A hash of ``length`` words from each of ``starts`` on."""
        return (self.sums[starts + length] - self.sums[starts]) * self.back[starts]

    def extended(self, i: np.ndarray, j: np.ndarray, forwards: bool) -> np.ndarray:
        """How many words from places i and j on are equal; or up to them, these not included."""
        size = np.zeros(len(i), np.int64)
        step = 1 << max(0, int(self.counts.max(initial=1)).bit_length())
        while step:
            if forwards:
                fits = np.flatnonzero(np.maximum(i, j) + size + step <= len(self))
                a, b = (x[fits] + size[fits] for x in (i, j))
            else:
                fits = np.flatnonzero(np.minimum(i, j) - size - step >= 0)
                a, b = (x[fits] - size[fits] - step for x in (i, j))
            size[fits[self.span(a, step) == self.span(b, step)]] += step
            step >>= 1
        return size


@lru_cache(maxsize=1 << 16)
def _prime_factors(n: int) -> tuple[int, ...]:
    out, p = [], 2
    while p * p <= n:
        if n % p == 0:
            out.append(p)
            while n % p == 0:
                n //= p
        p += 1
    return (*out, n) if n > 1 else tuple(out)


def _distinct(starts, ends, periods):
    """Runs once each, in the order of their starts, then periods."""
    order = np.lexsort((periods, starts))
    starts, ends, periods = starts[order], ends[order], periods[order]
    fresh = np.ones(len(starts), bool)
    fresh[1:] = (starts[1:] != starts[:-1]) | (periods[1:] != periods[:-1])
    return starts[fresh], ends[fresh], periods[fresh]


def _proved(text: Symbols, places: np.ndarray, periods: np.ndarray):
    """Runs around places where the words are the same one of the proposed periods on."""
    starts = places - text.extended(places, places + periods, False)
    ends = places + periods + text.extended(places, places + periods, True)
    long = ends - starts >= 2 * periods
    starts, ends, periods = _distinct(starts[long], ends[long], periods[long])
    least = np.ones(len(starts), bool)
    values, which = np.unique(periods, return_inverse=True)
    factors = [_prime_factors(int(v)) for v in values]
    for k in range(max(map(len, factors), default=0)):
        prime = np.array([f[k] if k < len(f) else 0 for f in factors])[which]
        ask = np.flatnonzero(prime > 1)
        part = periods[ask] // prime[ask]
        size = ends[ask] - starts[ask] - part
        least[ask[text.span(starts[ask], size) == text.span(starts[ask] + part, size)]] = False
    return starts[least], ends[least], periods[least]


def _direct(text: Symbols, period: int):
    """Runs of one small period, by comparing all words so many places apart."""
    same = np.zeros(len(text) + 2, np.int8)
    if len(text) > period:
        same[1 : len(text) - period + 1] = text.values[period:] == text.values[:-period]
    turns = np.diff(same)
    starts, stops = np.flatnonzero(turns > 0), np.flatnonzero(turns < 0)
    long = stops - starts >= period
    return starts[long], stops[long] + period, np.full(int(long.sum()), period)


def _windows_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of ``width`` values from each place on, as far as there are so many."""
    out, have = values, 1
    while 2 * have <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return np.minimum(out[:-rest], out[rest:]) if rest else out


def _pairs(text: Symbols, scale: int, known) -> tuple[np.ndarray, np.ndarray]:
    """Places of the synchronising set and distances to places with the same words."""
    low, high = 3 * scale - 1, 6 * scale - 1
    chosen = np.flatnonzero(text.counts >= 2 * low)
    counts = text.counts[chosen] - scale + 1
    at = ranges(text.starts[chosen], counts)
    hashes = mix(text.span(at, scale))
    starts, ends, periods = known
    periodic = (3 * periods <= scale) & (ends - starts >= scale)
    if periodic.any():
        inside = np.zeros(len(text) + 1, np.int64)
        np.add.at(inside, starts[periodic], 1)
        np.add.at(inside, ends[periodic] - scale + 1, -1)
        hashes[np.cumsum(inside)[at] > 0] = NONE
    least = _windows_least(hashes, scale + 1)
    size = len(least)
    in_set = (least != NONE) & ((hashes[:size] == least) | (hashes[scale : scale + size] == least))
    # a window must not reach into the next text
    in_set &= (np.repeat(np.cumsum(counts), counts) - np.arange(len(at)))[:size] > scale
    places = at[:size][in_set]
    context = text.span(places, 2 * scale)
    order = np.argsort(context, kind="stable")
    context, places = context[order], places[order]
    out_places, out_periods = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    left, ahead = np.arange(len(places)), 1
    while len(left):
        left = left[left + ahead < len(places)]
        apart = places[left + ahead] - places[left]
        near = (context[left + ahead] == context[left]) & (apart < high)
        left, apart = left[near], apart[near]
        out_places.append(places[left[apart >= low]])
        out_periods.append(apart[apart >= low])
        ahead += 1
    places, periods = np.concatenate(out_places), np.concatenate(out_periods)
    # pairs whose words overlap lie in the same stretch
    order = np.lexsort((places, periods))
    places, periods = places[order], periods[order]
    fresh = np.ones(len(places), bool)
    fresh[1:] = (periods[1:] != periods[:-1]) | (places[1:] - places[:-1] > 2 * scale)
    return places[fresh], periods[fresh]


def _out_of_step(text: Symbols, known) -> tuple[np.ndarray, np.ndarray]:
    """Places and periods from two regions of the same small period that touch."""
    starts, ends, periods = known
    long = np.flatnonzero(ends - starts >= 8 * periods)
    order = long[np.lexsort((starts[long], periods[long]))]
    starts, ends, periods = starts[order], ends[order], periods[order]
    touch = np.flatnonzero((periods[1:] == periods[:-1]) & (starts[1:] <= ends[:-1]))
    a0, a1, b0, b1, p = starts[touch], ends[touch], starts[touch + 1], ends[touch + 1], periods[touch]
    # shifts by less than p that bring the second region's words in step with the first's
    pair = np.repeat(np.arange(len(p)), p)
    turn = ranges(np.zeros(len(p), np.int64), p)
    step = text.span(a0[pair] + turn, p[pair]) == text.span(b0[pair], p[pair])
    pair, turn = pair[step], turn[step]
    p, a0, a1, b0, b1 = (x[pair] for x in (p, a0, a1, b0, b1))
    rest = np.mod(b0 - a0 - turn, p)
    count = np.maximum(0, (b1 - a0) // 2 // p + 1)
    period = np.repeat(rest, count) + np.repeat(p, count) * ranges(np.zeros(len(p), np.int64), count)
    a0, a1, b0, p = (np.repeat(x, count) for x in (a0, a1, b0, p))
    place = np.maximum(a0, b0 - period)
    good = (period > 2 * p) & (place < a1) & (place + period < len(text))
    return place[good], period[good]


def runs_of(text: Symbols) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends (places in the string) and periods of all runs of at least twice their period."""
    none = np.zeros(0, np.int64)
    known = (none, none, none)

    def add(more):
        return _distinct(*(np.concatenate(both) for both in zip(known, more)))

    longest = int(text.counts.max(initial=0))
    for period in range(1, min(DIRECT, longest // 2) + 1):
        starts, ends, periods = _direct(text, period)
        known = add(_proved(text, starts, periods))
    scale = 2
    while 2 * (3 * scale - 1) <= longest:
        known = add(_proved(text, *_pairs(text, scale, known)))
        known = add(_proved(text, *_out_of_step(text, known)))
        scale *= 2
    return known


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The spans one after the other, each with a blank after it."""
    sizes = ends - starts + 1
    out = data[np.minimum(ranges(starts, sizes), max(0, len(data) - 1))]
    out[np.cumsum(sizes) - 1] = 0x20
    return out


def scan(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, least: int = LEAST_WORDS
) -> DataFrame:
    """``row`` (the document, or its columns ``keep``, as a struct), ``n_words``, ``runs`` (``start``, ``length``
    and ``period`` of each run of at least ``least`` words, by start, then period) and ``collapsed_text``, the words
    that no run holds after its first period, joined by blanks."""
    carried = Carried(docs, text, keep)

    def part(batch, block):
        found = words(block, SPACED)
        string = Symbols(word_hashes(block, found), found.bounds)
        starts, ends, periods = runs_of(string)
        long = ends - starts >= least
        starts, ends, periods = starts[long], ends[long], periods[long]
        doc = np.searchsorted(string.starts, starts, "right") - 1
        doc_bounds = np.searchsorted(doc, np.arange(len(block) + 1)).astype(np.int32)
        again = np.zeros(len(string) + 1, np.int64)
        np.add.at(again, starts + periods, 1)
        np.add.at(again, ends, -1)
        kept = np.cumsum(again)[ranges(string.starts, string.counts)] == 0
        flat = _joined(block.data, found.starts[kept], found.ends[kept])
        sizes = np.concatenate([[0], np.cumsum((found.ends - found.starts + 1) * kept)])
        cuts = sizes[found.bounds]
        # the last blank of each text goes
        last = cuts[1:][np.diff(cuts) > 0] - 1
        flat = np.delete(flat, last)
        cuts = cuts - np.concatenate([[0], np.cumsum(np.diff(cuts) > 0)])
        collapsed = pa.LargeStringArray.from_buffers(
            len(block), pa.py_buffer(cuts.astype(np.int64)), pa.py_buffer(flat)
        ).cast(pa.string())
        fields = [pa.array(starts - string.starts[doc]), pa.array(ends - starts), pa.array(periods)]
        listed = pa.ListArray.from_arrays(
            pa.array(doc_bounds), pa.StructArray.from_arrays(fields, ["start", "length", "period"])
        )
        return pa.RecordBatch.from_arrays(
            [batch.column("_rest").slice(block.first, len(block)),
             batch.column("_text").slice(block.first, len(block)),
             pa.array(string.counts), listed, collapsed],
            ["_rest", "_text", "n_words", "runs", "collapsed_text"],
        )

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column("_text")):
                yield part(batch, block)

    rows = docs.select(*carried.columns)
    fields = ", ".join(f"'{name}', 0L" for name in ("start", "length", "period"))
    schema = rows.select(
        "_rest", "_text", F.lit(0).cast("long").alias("n_words"),
        F.expr(f"array(named_struct({fields}))").alias("runs"), F.lit("").alias("collapsed_text"),
    ).schema
    return mapped(rows, run, schema).select(carried.row, "n_words", "runs", "collapsed_text")
