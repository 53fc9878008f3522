"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

Encoding walks a pre-token from left to right and takes the longest token that an Aho-Corasick
automaton found to start there. It may stand only if it is compatible with the token before it, that
is, if merging both together by rank gives back just these two; else the next shorter token that
starts there is tried, and when none fits the token before is taken back. Places that turned out to
be dead ends are not tried again, so the work is linear in the length. By the compatibility of all
neighbours the result is that of the merges.

Decoding copies the spelling of each id out of one byte array with offsets.

``encoded`` keeps all columns and adds ``ids`` (array of int); ``decoded`` adds ``decoded``
(string). Columns of these names are replaced. A null text is empty and has no ids; null ids decode
to the empty string. Rows are independent of each other and of their order, whole texts are encoded,
and an empty table stays empty.

Letters, digits and lower case are those of the Unicode tables of Python and ``regex``; code points
that were assigned after Unicode 15.1 may be classed otherwise than by the tokenizers library.
"""

from __future__ import annotations

import json
import unicodedata
from array import array
from functools import lru_cache
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levelscope.llm.texts import ranges
from levelscope.llm.token_counts import parts, texts_of
from levelscope.llm.vocabulary import byte_symbols, shipped, special_pattern
from levelscope.llm.workers import mapped

NEVER = 1 << 30
BETWEEN = 600  # a symbol that no token has
#: Words whose ids are kept; as many of those before them are kept until there are so many new ones again.
CACHE_ENTRIES = 100_000
DECODE_IDS = 1 << 18


class Codec:
    """The tables of one vocabulary file with an end-of-word suffix."""

    def __init__(self, vocabulary: str):
        spec = json.loads(vocabulary)
        model = spec["model"]
        self.ids: dict[str, int] = model["vocab"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = special_pattern(spec)
        self.special_ids = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pattern = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        self.compose, self.lower = "NFC" in kinds, "Lowercase" in kinds

        # symbol 0-255: a byte within a word; 256-511: the last byte, which carries the suffix
        spelled = byte_symbols()
        self.single = [self.ids[s] for s in spelled] + [self.ids[s + self.suffix] for s in spelled]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        for left, right in merges:
            joined = left.removesuffix(self.suffix) + right if self.suffix else left + right
            self.rank.setdefault((self.ids[left], self.ids[right]), len(self.made))
            self.made.append(self.ids[joined])
        self._index_tokens(spelled)
        self._offsets()
        self.compatible: dict[int, bool] = {}
        self.spines: tuple[dict[int, list[tuple[int, int]]], ...] = ({}, {})
        self.codes: dict[str, int] = {}
        self.flat, self.ends = array("i"), array("q", [0])
        self._reset()

    # tables

    def _index_tokens(self, spelled: list[str]) -> None:
        """Automaton, lengths, next shorter tokens and merge spines of the tokens in use."""
        byte_of = {s: b for b, s in enumerate(spelled)}
        by_word: dict[str, int] = {}
        self.parts: dict[int, tuple[int, int, int]] = {}
        for text, token in sorted(self.ids.items(), key=lambda x: x[1]):
            if token in self.special_ids.values():
                continue
            ends = bool(self.suffix) and text.endswith(self.suffix)
            body = [byte_of[c] for c in (text.removesuffix(self.suffix) if ends else text)]
            if ends:
                body[-1] += 256
            left, steps = self.merged([self.single[s] for s in body])
            if left == [token]:  # else the merges never give it
                by_word["".join(map(chr, body))] = token
                self.parts.update(steps)
        self.length = {token: len(word) for word, token in by_word.items()}
        self.shorter: dict[int, int | None] = {}
        self.automaton = ahocorasick.Automaton()
        for word, token in by_word.items():
            prefixes = (by_word.get(word[:n]) for n in range(len(word) - 1, 0, -1))
            self.shorter[token] = next((p for p in prefixes if p is not None), None)
            self.automaton.add_word(word, (len(word) - 1, token))
        self.automaton.make_automaton()

    def _spine(self, token: int, side: int) -> list[tuple[int, int]]:
        """From the outermost symbol of a side up to the token: each piece, and the rank at which
        it is merged into the next."""
        known = self.spines[side].get(token)
        if known:
            return known
        whole, out, taken = token, [], NEVER
        while True:
            out.append((token, taken))
            if token not in self.parts:
                out.reverse()
                self.spines[side][whole] = out
                return out
            taken = self.parts[token][2]
            token = self.parts[token][side]

    def merged(self, tokens: list[int]) -> tuple[list[int], dict[int, tuple[int, int, int]]]:
        """The merges applied one by one in order of rank, and the parts of each token made."""
        steps: dict[int, tuple[int, int, int]] = {}
        tokens = list(tokens)
        while len(tokens) > 1:
            rank, at = min(
                (self.rank.get(pair, NEVER), i) for i, pair in enumerate(zip(tokens, tokens[1:]))
            )
            if rank == NEVER:
                break
            steps[self.made[rank]] = (tokens[at], tokens[at + 1], rank)
            tokens[at : at + 2] = [self.made[rank]]
        return tokens, steps

    def _offsets(self) -> None:
        spellings = {i: s for s, i in (self.ids | self.special_ids).items()}
        parts = [(spellings.get(i, "") + " ").encode() for i in range(max(spellings) + 1)]
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.offsets = np.cumsum([0, *map(len, parts)])

    # encoding

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the symbols of ``a`` and ``b`` together gives back ``a`` and ``b``.

        The pieces at the border grow in order of rank. The pair across the border would be merged
        if its rank comes before that of the left piece's next merge (which goes first on a tie,
        being further left) and no later than that of the right piece's.
        """
        lefts, rights, i, j = self._spine(a, 1), self._spine(b, 0), 0, 0
        while True:
            (left, left_at), (right, right_at) = lefts[i], rights[j]
            across = self.rank.get((left, right), NEVER)
            if across < left_at and across <= right_at:
                return False
            if left_at == right_at == NEVER:
                return True
            if left_at <= right_at:
                i += 1
            else:
                j += 1

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """The ids of each of some words, which the automaton reads as one string."""
        raw = np.frombuffer(b"\xff".join([word.encode() for word in words]), np.uint8)
        symbols = raw.astype(np.uint16)
        stops = np.append(np.flatnonzero(raw == 0xFF), len(raw))  # a byte that UTF-8 does not have
        symbols[stops[:-1]] = BETWEEN
        if self.suffix:
            symbols[stops - 1] += 256
        longest: list[int] = [0] * len(raw)
        for end, (back, token) in self.automaton.iter(symbols.tobytes().decode("utf-16-le")):
            longest[end - back] = token  # matches come in order of their ends: a later one is longer
        stops = stops.tolist()
        starts = [0, *(stop + 1 for stop in stops[:-1])]
        return [self._walk(longest, start, stop) for start, stop in zip(starts, stops)]

    def encode_word(self, word: str) -> list[int]:
        return self.encode_words([word])[0]

    def _walk(self, longest: list[int], at: int, stop: int) -> list[int]:
        """The ids of the word from ``at`` to ``stop``, by the longest token that starts at each place."""
        length, compatible = self.length, self.compatible
        token: int | None = longest[at]
        at += length[token]
        out = [token]
        if at == stop:
            return out
        dead: set[int] = set()
        token = longest[at]
        while True:
            before = out[-1] if out else None
            while token is not None:
                if not dead or at + length[token] not in dead:
                    if before is None:
                        break
                    pair = before << 32 | token
                    good = compatible.get(pair)
                    if good is None:
                        good = compatible[pair] = self.fits(before, token)
                    if good:
                        break
                token = self.shorter[token]
            if token is None:
                dead.add(at)
                token = out.pop()
                at -= length[token]
                continue
            out.append(token)
            at += length[token]
            if at == stop:
                return out
            token = longest[at]

    def _reset(self) -> None:
        """Starts a new cache; the words of the last one are taken over as they come up."""
        self.before = self.codes, self.flat, self.ends
        self.codes = {}
        self.flat, self.ends = array("i"), array("q", [0])
        for text, token in self.special_ids.items():
            self._keep(text, [token])

    def _keep(self, word: str, tokens: list[int]) -> None:
        self.codes[word] = len(self.ends) - 1
        self.flat.extend(tokens)
        self.ends.append(len(self.flat))

    def words(self, text: str) -> list[str]:
        out: list[str] = []
        at = 0
        for match in self.special.finditer(text) if self.special else ():
            out += self._plain(text[at : match.start()])
            out.append(match.group())
            at = match.end()
        return out + self._plain(text[at:]) if out else self._plain(text[at:])

    def _plain(self, text: str) -> list[str]:
        if self.compose and not text.isascii():
            text = unicodedata.normalize("NFC", text)
        if self.lower:  # letter by letter: no special form at the end of a word
            text = text.replace("Σ", "σ").lower()
        return self.pattern.findall(text)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and the number of ids of each text."""
        found = [self.words(text) for text in texts]
        there = set().union(*found)
        new = [word for word in there if word not in self.codes]
        if len(self.compatible) > CACHE_ENTRIES:
            self.compatible.clear()
        if len(self.codes) + len(new) > CACHE_ENTRIES:
            self._reset()
            new = [word for word in there if word not in self.codes]
        codes, flat, ends = self.before
        for word in new:
            if (code := codes.get(word)) is not None:
                self._keep(word, flat[ends[code] : ends[code + 1]])
        new = [word for word in new if word not in self.codes]
        for word, tokens in zip(new, self.encode_words(new) if new else ()):
            self._keep(word, tokens)
        sizes = [len(words) for words in found]
        codes = np.fromiter(map(self.codes.__getitem__, chain.from_iterable(found)), np.int64, sum(sizes))
        ends, flat = np.array(self.ends), np.array(self.flat)
        lengths = ends[codes + 1] - ends[codes]
        totals = np.concatenate([[0], np.cumsum(lengths)])
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        return flat[ranges(ends[codes], lengths)], np.diff(totals[bounds])

    # decoding

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The spellings of each text's ids, joined by single spaces."""
        sizes = self.offsets[ids + 1] - self.offsets[ids]
        flat = self.bytes[ranges(self.offsets[ids], sizes)].tobytes()
        ends = np.concatenate([[0], np.cumsum(sizes)])[np.concatenate([[0], np.cumsum(counts)])]
        return [flat[a : max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]


@lru_cache(maxsize=2)
def codec(vocabulary: str) -> Codec:
    return Codec(vocabulary)


def _coded(
    df: DataFrame, vocabulary_file: str, text: str, keep: list[str] | None, decode: bool
) -> DataFrame:
    shared = shipped(df.sparkSession, vocabulary_file)
    added = ["ids", "decoded"] if decode else ["ids"]

    def run(batches):
        tables = codec(shared.value)
        for part in (part for batch in batches for part in parts(batch)):
            ids, counts = tables.encode(texts_of(part))
            ends = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
            columns = [part.column("_row"), pa.ListArray.from_arrays(ends, pa.array(ids))]
            if decode:
                columns.append(_texts(tables.decode(ids, counts)))
            yield pa.RecordBatch.from_arrays(columns, ["_row", *added])

    kept = [c for c in keep or df.columns if c not in added]
    rows = df.select(F.struct(*kept).alias("_row"), F.col(text).alias("_text"))
    outputs = [F.array(F.lit(0)).alias("ids"), F.lit("").alias("decoded")][: len(added)]
    return mapped(rows, run, rows.select("_row", *outputs).schema).select("_row.*", *added)


def _texts(spelled: list[bytes]) -> pa.Array:
    return pa.array(spelled, pa.binary()).cast(pa.string())


def encoded(
    df: DataFrame, vocabulary_file: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``keep``: the columns to return besides the ids, all by default."""
    return _coded(df, vocabulary_file, text, keep, False)


def round_trips(
    df: DataFrame, vocabulary_file: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``decoded(encoded(df))`` in one pass."""
    return _coded(df, vocabulary_file, text, keep, True)


def decoded(df: DataFrame, vocabulary_file: str, ids: str = "ids") -> DataFrame:
    shared = shipped(df.sparkSession, vocabulary_file)

    def run(batches):
        tables = codec(shared.value)
        for batch in batches:
            column = batch.column("_ids")
            counts = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            flat, ends = column.flatten().to_numpy(zero_copy_only=False), np.cumsum(counts)
            i = at = 0
            while i < len(counts):  # so many ids at a time, one text at least
                j = max(i + 1, int(np.searchsorted(ends, at + DECODE_IDS, "right")))
                texts = _texts(tables.decode(flat[at : ends[j - 1]], counts[i:j]))
                rows = batch.column("_row").slice(i, j - i)
                yield pa.RecordBatch.from_arrays([rows, texts], ["_row", "decoded"])
                i, at = j, int(ends[j - 1])

    kept = [c for c in df.columns if c != "decoded"]
    rows = df.select(F.struct(*kept).alias("_row"), F.col(ids).alias("_ids"))
    schema = rows.select("_row", F.lit("").alias("decoded")).schema
    return mapped(rows, run, schema).select("_row.*", "decoded")
