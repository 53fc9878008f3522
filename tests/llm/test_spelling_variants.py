"""Words one edit apart and the groups they form, against plain versions."""

import random
import re
import zlib
from collections import Counter

from levelscope.llm import queries, spelling_variants
from tests.llm import corpus

LETTERS = "abé"


def edits(word: str, letters: str) -> set[str]:
    out = set()
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in letters}
        if i < len(word):
            out |= {word[:i] + c + word[i + 1 :] for c in letters} | {word[:i] + word[i + 1 :]}
    return out - {word}


def plain(counts: dict[str, int], letters: str):
    """(word, form, root, n, n_near, form_n) by the definition."""
    near = {w: edits(w, letters) & counts.keys() for w in counts}
    forms = {}
    for word, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[word] = best if best and counts[best] >= 10 * counts[word] else None

    def root(word):
        while forms[word]:
            word = forms[word]
        return word

    return {
        (w, forms[w], root(w), n, len(near[w]), counts[forms[w]] if forms[w] else None) for w, n in counts.items()
    }


def got_of(spark, counts):
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    rows = spelling_variants.variants(words).collect()
    return {tuple(r) for r in rows}, len(rows)


def test_variants_equal_the_definition(spark):
    rng = random.Random(4)
    words = {"".join(rng.choice(LETTERS) for _ in range(rng.choice([7, 7, 8, 9, 11]))) for _ in range(700)}
    for start in ("abéabéa", "bbbbbbbb"):  # ways of several forms
        for k in range(4):
            words.add(start[:k] + "z" + start[k + 1 :])
    counts = {w: rng.choice([2, 3, 25, 300, 4000, 50000]) for w in sorted(words)}
    got, size = got_of(spark, counts)
    assert size == len(counts)
    assert got == plain(counts, LETTERS + "z")


def test_ways_lead_to_the_last_form(spark):
    counts = {"aaaaaaaa": 2, "aaaaaaab": 20, "aaaaaabb": 200, "aaaaabbb": 2000, "aaaabbbb": 20000, "zzzzzzz": 5}
    got, _ = got_of(spark, counts)
    assert {(r[0], r[2]) for r in got} == {(w, "aaaabbbb" if w[0] == "a" else w) for w in counts}


def test_ties_take_the_smallest_word(spark):
    counts = {"ccccccc": 2, "ccccccd": 40, "ccccccb": 40, "éccccccc": 40}
    got, _ = got_of(spark, counts)
    assert ("ccccccc", "ccccccb", "ccccccb", 2, 3, 40) in got


def test_words_of_any_length(spark):
    """Around the lengths at which symbols get wider, with every kind of edit at many places."""
    words = set()
    for length in (31, 32, 33, 64, 65, 129, 400):
        rng = random.Random(length)
        word = "".join(rng.choice(LETTERS) for _ in range(length))
        words |= {word, word + "a", word + "aa"}
        for i in {0, 1, length // 2 - 1, length // 2, length - 2, length - 1, *rng.sample(range(length), 4)}:
            words |= {word[:i] + "b" + word[i:], word[:i] + word[i + 1 :], word[:i] + "z" + word[i + 1 :]}
    counts = {w: 2 + len(w) % 2 for w in words} | {"z" * 3000: 2, "z" * 2999: 50, "z" * 2997: 9}
    got, _ = got_of(spark, counts)
    usual = {w: n for w, n in counts.items() if len(w) < 500}
    assert {r for r in got if len(r[0]) < 500} == plain(usual, LETTERS + "z")
    assert ("z" * 3000, "z" * 2999, "z" * 2999, 2, 1, 50) in got and len(got) == len(counts)


def test_the_query_counts_whole_texts(spark, tmp_path):
    docs = corpus.documents(spark)
    texts = [(d, t) for d, t, _ in corpus.texts()]
    texts += [(3000 + i, "Wörterbuch wörterbuch WörterbuchÖ colours colour colouur Colours ×÷×÷×÷×") for i in range(40)]
    more = spark.createDataFrame(texts[len(corpus.texts()) :], "doc_id long, text string")
    docs.select("doc_id", "text").union(more).write.parquet(f"{tmp_path}/documents.parquet")
    counts: Counter = Counter()
    for doc_id, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(corpus.UPPER)
            mark = 1 if doc_id is None else zlib.crc32(f"{doc_id}:{run}".encode())
            if mark % 31 == 0:
                at = mark % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    letters = "".join(sorted(set("".join(counts))))
    rows = queries.variant_query(spark, str(tmp_path)).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert {tuple(r) for r in rows} == plain(counts, letters) and len(rows) == len(counts)


def test_no_words(spark):
    none = spark.createDataFrame([], "word string, n long")
    assert spelling_variants.variants(none).collect() == []
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "short ones")], "doc_id long, text string")
    assert spelling_variants.runs(docs).collect() == []


def test_other_columns_may_clash(spark):
    docs = spark.createDataFrame([("colours", 1, 2, "x")], "text string, run int, node int, _run string")
    assert [tuple(r) for r in spelling_variants.runs(docs).collect()] == [("colours",)]
    words = spark.createDataFrame([("colours", 30, 1), ("colour", 2, 1), ("colouxs", 2, 1)], "word string, n long, level int")
    got = {(r.word, r.form) for r in spelling_variants.variants(words).collect()}
    assert got == {("colours", None), ("colour", "colours"), ("colouxs", "colours")}


def test_busy_words_are_not_paired_among_themselves(spark):
    """Many variants of one word that are not near each other give a pair each way with it, no more."""
    word = "abcdefghijklmnopqrst"
    counts = {word: 1000} | {word[:i] + c + word[i + 1 :]: 2 for i in range(20) for c in "xyz"}
    got, _ = got_of(spark, counts)
    assert {r[2] for r in got} == {word}
    assert (word, None, word, 1000, 60, None) in got
