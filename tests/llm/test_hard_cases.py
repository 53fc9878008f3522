"""Repeated rows by the thousand, very long words, other column types, and measured recall."""

import random
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from levelscope.llm import (
    band_exchange, language_id, line_dedup, minhash_dedup, queries, similarity, token_counts,
)
from levelscope.llm.texts import U64, mix
from tests.llm import corpus


def test_a_document_row_each(spark):
    """Rows that are repeated, by id and text or by text alone, all come back."""
    text = "one two three four five six seven eight nine ten"
    rows = [(1, text)] * 40 + [(2, text)] * 40 + [(3, None)] * 5 + [(4, "")] * 5 + [(None, text)] * 3
    got = minhash_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id is not None, r.doc_id or 0) for r in got) == sorted((i is not None, i or 0) for i, _ in rows)
    same = [r for r in got if r.doc_id in (1, 2, None)]
    assert {(r.class_id, r.class_size) for r in same} == {(None, 83)} and sum(r.kept for r in same) == 1
    assert all(r.class_id == r.doc_id for r in got if r.doc_id in (3, 4))


def test_copies_by_the_thousand_cost_as_many_lines(spark):
    """1,000 copies each of two rows whose lines are similar: the work is that of the two."""
    line = "the quick brown fox jumps over the lazy dog and goes on to the river to drink {} times a day"
    rows = [(k % 2, f"{line.format(k % 2)}\nanother line of the document number {k % 2}00") for k in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    began = time.time()
    got = line_dedup.removed(docs).groupBy("doc_id", "removed").count().collect()
    assert time.time() - began < 120
    assert {(r.doc_id, tuple(r.removed), r["count"]) for r in got} == {(0, (), 1000), (1, (0, 1), 1000)}


def law(a: str, b: str) -> bool:
    """Whether two normalised lines are similar, in the words of the README: 5-grams from 49 characters on, 3-grams
    under 62."""

    def like(n):
        x, y = ({t[i : i + n] for i in range(max(1, len(t) - n + 1))} for t in (a, b))
        return len(x & y) / len(x | y) >= 0.8

    return (min(len(a), len(b)) >= 49 and like(5)) or (max(len(a), len(b)) < 62 and like(3))


def test_similar_lines_of_all_lengths(spark):
    rng = random.Random(8)
    letters, lines = "abcdefghij klmnop", []
    for n in list(range(5, 100, 3)) + [47, 48, 49, 50, 60, 61, 62, 63]:
        line = " ".join("".join(rng.choice(letters) for _ in range(n)).split()) or "x"
        lines.append(line)
        for k in (1, 2, 4):
            other = list(line)
            for _ in range(k):
                other[rng.randrange(len(other))] = rng.choice("qrstuvwxyz")
            lines.append(" ".join("".join(other).split()) or "y")
    forest = corpus.Forest()
    for i, a in enumerate(lines):
        for j in range(i):
            if lines[j] == a or law(a, lines[j]):
                forest.join(i, j)
    docs = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string")
    gone = {r.doc_id for r in line_dedup.removed(docs).collect() if r.removed}
    assert gone == {i for i in range(len(lines)) if forest.find(i) != i}
    assert 20 < len(gone) < len(lines) - 20


def test_other_columns_of_any_type(spark):
    docs = corpus.documents(spark).limit(30).withColumn("more", F.create_map(F.lit("a"), F.lit(1)))
    assert line_dedup.deduplicated(docs).count() == 30
    kept = minhash_dedup.deduplicated(docs)
    assert kept.columns == docs.columns and kept.select(F.map_keys("more")).count() > 0


def test_settled_keys_lose_no_pair(spark, monkeypatch):
    """Many items under one key, packed in many packs: all meet through their leaders, or in parts."""
    monkeypatch.setattr(band_exchange, "SETTLED", 4)
    monkeypatch.setattr(band_exchange, "PACK_PAIRS", 40)
    line = "item number {:05d} of the catalogue of the town library, in the hall on the left, third shelf from below"
    lines = [line.format(7919 * k % 100000) for k in range(400)] + [f"{k} something else altogether {k * k}" for k in range(50)]
    rows = [(k, text) for k, text in enumerate(lines)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    gone = {r.doc_id for r in line_dedup.removed(docs).collect() if r.removed}
    forest = corpus.Forest()
    for i, a in enumerate(lines):
        forest.find(i)
        for j in range(i):
            if law(a, lines[j]):
                forest.join(i, j)
    assert gone == {i for i in range(len(lines)) if forest.find(i) != i}


def test_shared_keys_equal_a_group_by():
    """What the exchange gives out, against a plain count of items by key."""
    rng = np.random.default_rng(2)
    keys = mix(rng.integers(0, 900, 3000).astype(U64))
    ids = rng.integers(-50, 50, 3000)
    items = np.unique(ids)
    for parts in (1, 3, 8):
        by_part: dict[int, list] = {}
        for part in range(0, 3000, 700):  # packs
            some = slice(part, part + 700)
            made = [(keys[some], ids[some], items, items * 3)]
            for batch in band_exchange._packed(made, parts):
                for row in batch.to_pylist():
                    by_part.setdefault(row["part"], []).append((row["low"], row["ids"], row["more"]))
        got, sketches = set(), {}
        for part, rows in by_part.items():
            for batch in band_exchange._received(rows, part):
                for row in batch.to_pylist():
                    if row["key"] is None:
                        sketches[row["id"]] = row["sketch"]
                    else:
                        got.add((row["key"], row["id"]))
        known = band_exchange._known(keys, parts).tolist()
        want = set(zip(known, ids.tolist()))
        count: dict[int, int] = {}
        for key, _ in want:
            count[key] = count.get(key, 0) + 1
        assert got == {(key, i) for key, i in want if count[key] > 1}
        assert sketches == {i: 3 * i for i in items.tolist()}


def test_groups_of_rows_stay_whole():
    """However the rows of a key are cut into batches."""
    rng = random.Random(4)
    keys = sorted(rng.choice(range(12)) for _ in range(200))
    for _ in range(50):
        cuts = sorted(rng.sample(range(201), 9))
        batches = [
            pa.RecordBatch.from_arrays([pa.array(keys[a:b], pa.int64())], ["key"])
            for a, b in zip([0, *cuts], [*cuts, 200])
        ]
        parts = [p["key"].tolist() for p in similarity._by_key(iter(batches))]
        assert sum(parts, []) == keys
        assert all(a[-1] != b[0] for a, b in zip(parts, parts[1:]))


def near_copy(rng, words, share):
    """A text whose weighted Jaccard similarity of 5-word runs is about ``share``."""
    lost = (1 - share) * len(words) / (1 + share)
    out, changed = list(words), 0
    while changed < lost:
        at = rng.randrange(len(words) // 5) * 5  # changes that share no run
        out[at + 4] = f"new{rng.random()}"
        changed += 5
    return out


@pytest.mark.parametrize("share", [0.81, 0.85, 0.9])
def test_recall_of_near_copies(spark, share):
    """Pairs whose exact similarity is the threshold or more are found, at any similarity above it."""
    rng = random.Random(int(share * 100))
    rows, asked = [], []
    for k in range(150):
        words = [f"w{k}x{i}" for i in range(rng.choice([300, 600]))]
        both = " ".join(words), " ".join(near_copy(rng, words, share))
        rows += [(2 * k, both[0]), (2 * k + 1, both[1])]
        asked.append(corpus.jaccard(*map(corpus.bag, both)) >= 0.8)
    got = {r.doc_id: r.class_id for r in minhash_dedup.classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found = [got[2 * k + 1] == 2 * k for k in range(150)]
    assert sum(asked) > 60
    assert all(not f or a for f, a in zip(found, asked))  # nothing below the threshold
    assert sum(f for f, a in zip(found, asked) if a) >= 0.98 * sum(asked)


def test_a_million_letters_without_a_blank():
    rng = random.Random(1)
    library = Tokenizer.from_file(queries.BYTE_BPE)
    counter = token_counts.counter(open(queries.BYTE_BPE, encoding="utf-8").read())
    texts = [
        "".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=1_000_000)),
        "ab" * 40_000 + "a" * 33_333, "é" * 5001, "".join(rng.choices("eaté", k=20_000)),
        " " + "the" * 3000 + " and " + "on" * 1500,
    ]
    began = time.time()
    assert counter.count(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert time.time() - began < 60


def test_long_and_short_merges_agree():
    rng = random.Random(5)
    counter = token_counts.counter(open(queries.BYTE_BPE, encoding="utf-8").read())
    for _ in range(60):
        text = "".join(rng.choices(rng.choice(["ab", "aeint", "the ", "aé中"]), k=rng.randint(1, 300)))
        data = text.encode()
        assert counter.merge_long(data) == counter.merge([data])[0]


def test_words_are_cut_like_the_pattern():
    rng = random.Random(6)
    some = "aB é ß İ ǅ 中文 ½² ٣ \n\r\x0b\x0c\x85   -_' 𝔸𝟘 \x00 ºª"
    texts = ["".join(rng.choices(some, k=rng.randint(0, 60))) for _ in range(400)] + ["", "\n", "\n\n"]
    assert language_id.cut(texts) == [language_id.LETTERS.findall(t.lower()) for t in texts]
    assert language_id.cut([""]) == [[]] and language_id.cut(["a\nb", ""]) == [["a", "b"], []]
