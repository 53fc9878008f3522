"""Operators that compare documents with each other, against plain versions."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from levelscope.llm import line_dedup, minhash_dedup, similarity, substring_dedup
from tests.llm import corpus


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.documents(spark).cache()


def test_classes_equal_pairwise_comparison(docs):
    got = minhash_dedup.classes(docs).collect()
    rows = list(dict.fromkeys((i, t) for i, t, _ in corpus.texts()))
    bags = [corpus.bag(t) for _, t in rows]
    forest = corpus.Forest()
    for x in range(len(rows)):
        forest.find(x)
        for y in range(x):
            if bags[x] and bags[y] and corpus.jaccard(bags[x], bags[y]) >= 0.8:
                forest.join(x, y)
    low = {}
    for x, (i, _) in enumerate(rows):
        low.setdefault(forest.find(x), []).append((i is not None, i))
    want = {row: min(low[forest.find(x)])[1] for x, row in enumerate(rows)}
    assert {(r.doc_id): r.class_id for r in got if r.doc_id is not None} == {i: c for (i, _), c in want.items() if i is not None}
    assert len(got) == docs.count()
    kept = {r.class_id for r in got if r.kept}
    assert len([r for r in got if r.kept]) == len(set(low)) and kept >= {500} - {70} or 70 in kept


def test_one_document_of_each_class_stays(docs):
    rows = minhash_dedup.deduplicated(docs)
    assert rows.columns == docs.columns
    kept = rows.collect()
    texts = [r.text for r in kept if corpus.spaced(r.text)]
    assert len(set(texts)) == len(texts)
    assert sum(not corpus.spaced(r.text) for r in kept) == 4
    assert len([r for r in kept if r.doc_id is not None and 500 <= r.doc_id < 512]) == 0


def test_signatures_estimate_the_weighted_similarity():
    import pyarrow as pa

    from levelscope.llm.texts import blocks

    a = " ".join(f"w{i}" for i in range(400)) + " w1 w2 w3 w4 w5 w6 w7" * 30
    b = " ".join(f"w{i}" for i in range(40, 400)) + " w1 w2 w3 w4 w5 w6 w7" * 20
    block = next(blocks(pa.array([a, b])))
    _, bounds, values = minhash_dedup.cells(block)
    banding = minhash_dedup.Banding(bands=200, rows=10)
    ranks = minhash_dedup.signatures(bounds, values, banding)
    exact = corpus.jaccard(corpus.bag(a), corpus.bag(b))
    assert abs((ranks[0] == ranks[1]).mean() - exact) < 0.05
    assert (ranks < 1e9).all()


def test_a_large_group_costs_no_pairs(spark):
    """Thousands of near copies are one class, by about as many comparisons as there are documents."""
    base = [f"w{i}" for i in range(120)]
    rows = []
    for k in range(1500):
        words = list(base)
        words[k % 120] = f"x{k}"
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert [r.class_id for r in minhash_dedup.classes(docs).select("class_id").distinct().collect()] == [0]


def lines_by_hand(rows, threshold=0.8):
    occurrences, sets = [], {}
    for i, text in rows:
        for n, line in line_dedup.normalised(text) if text else []:
            occurrences.append((i, n, line))
            k = line_dedup.SHINGLE
            sets[line] = {line[j : j + k] for j in range(max(1, len(line) - k + 1))}
    names, forest = list(sets), corpus.Forest()
    for x, a in enumerate(names):
        for b in names[:x]:
            common = len(sets[a] & sets[b])
            if common and common / (len(sets[a]) + len(sets[b]) - common) >= threshold:
                forest.join(a, b)
    seen, out = set(), {}
    for i, n, line in occurrences:
        root = forest.find(line)
        if root in seen:
            out.setdefault(i, []).append(n)
        seen.add(root)
    return out


def test_lines_equal_pairwise_comparison(docs):
    got = line_dedup.deduplicated(docs.where("doc_id is not null")).collect()
    rows = sorted({(i, t) for i, t, _ in corpus.texts() if i is not None}, key=lambda r: r[0])
    want = lines_by_hand(rows)
    assert sum(map(len, want.values())) > 20
    for r in got:
        removed = want.get(r.row.doc_id, [])
        assert list(r.removed) == removed, r.row.doc_id
        lines = None if r.row.text is None else r.row.text.split("\n")
        kept = None if lines is None else "\n".join(x for n, x in enumerate(lines) if n not in set(removed))
        assert r.kept_text == kept


def test_lines_with_one_changed_character_are_one(spark):
    """Of lines of 30 to 80 characters, and boilerplate with other numbers, only the first stays."""
    rng = random.Random(11)
    lines = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=n)) for n in range(30, 81)]
    pairs = [(x, x[: len(x) // 2] + "7" + x[len(x) // 2 + 1 :]) for x in lines]
    pairs.append(tuple(f"posted on 2024-01-02 by the site administrator | {n} comments" for n in (3, 4)))
    rows = [(2 * k + j, line) for k, pair in enumerate(pairs) for j, line in enumerate(pair)]
    got = line_dedup.removed(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.doc_id for r in got if r.removed} == {i for i, _ in rows if i % 2}


def test_lines_of_rows_without_an_id_come_first(spark):
    line = "The same long line stands in both of these documents."
    rows = [(3, line + "\nmine"), (None, line), (3, line + "\nmine")]
    got = line_dedup.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.row.doc_id or -1, r.kept_text) for r in got) == [(-1, line), (3, "mine"), (3, "mine")]


def passages_by_hand(rows):
    owners = {}
    for i, text in rows:
        words = corpus.spaced(text)
        for k in range(len(words) - 49):
            window = tuple(words[k : k + 50])
            if i is not None:
                owners[window] = min(i, owners.get(window, i))
    out = []
    for i, text in rows:
        words = corpus.spaced(text)
        lost = set()
        for k in range(len(words) - 49):
            if i is not None and owners[tuple(words[k : k + 50])] < i:
                lost |= set(range(k, k + 50))
        kept = " ".join(w for k, w in enumerate(words) if k not in lost)
        out.append((i, len(words), len(lost), kept if text is not None else None))
    return sorted(out, key=repr)


def test_passages_equal_a_plain_search(docs):
    got = substring_dedup.deduplicated(docs).select("row.doc_id", "n_words", "n_removed", "kept_text")
    want = passages_by_hand([(i, t) for i, t, _ in corpus.texts()])
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(w[2] for w in want) > 300


def test_passages_at_any_offset_and_within_documents(spark):
    words = [f"w{i}" for i in range(64)]
    rows = []
    for k in range(30):
        lead, tail = [f"a{k}_{j}" for j in range(k)], [f"b{k}_{j}" for j in range(3)]
        rows.append((100 - k, " ".join(lead + words[k % 15 :] + tail + words[: 30 + k])))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = substring_dedup.deduplicated(docs).select("row.doc_id", "n_words", "n_removed", "kept_text")
    assert sorted(map(tuple, got.collect()), key=repr) == passages_by_hand(rows)


def test_components_of_chains_and_hubs(spark):
    chain = [(i, i + 1) for i in range(200)]
    hub = [(1000, 1001 + i) for i in range(300)]
    links = spark.createDataFrame([(b, a) for a, b in chain] + hub + [(5000, 5000)], "a long, b long").repartition(6)
    got = {r.id: r.root for r in similarity.components(links, "test").collect()}
    assert got == {i: 0 for i in range(201)} | {1000 + i: 1000 for i in range(301)}


def test_links_between_followers_are_found(spark):
    """Two items of a bucket that are like each other, but not like its leader."""
    sets = {1: range(0, 100), 2: range(50, 150), 3: range(48, 148), 4: range(500, 600), 5: range(300, 310)}
    members = spark.createDataFrame([(7, i) for i in sets] + [(8, 5)], "key long, id long")
    features = spark.createDataFrame([(i, list(s)) for i, s in sets.items()], "id long, elements array<long>")
    roots = similarity.linked(members, lambda ids: features.join(ids, "id"), 0.8, "test")
    assert {r.id: r.root for r in roots.collect()} == {2: 2, 3: 2}


def test_large_buckets_are_compared_in_parts(spark, monkeypatch):
    """Items that are like one other item each, in one bucket, with parts of a few items."""
    monkeypatch.setattr(similarity, "PART_ELEMENTS", 60)
    sets = {i: list(range(100 * (i // 2), 100 * (i // 2) + 20 + i % 2)) for i in range(60)}
    members = spark.createDataFrame([(7, i) for i in sets], "key long, id long")
    features = spark.createDataFrame(list(sets.items()), "id long, elements array<long>")
    roots = similarity.linked(members, lambda ids: features.join(ids, "id"), 0.8, "test")
    assert {r.id: r.root for r in roots.collect()} == {i: i - i % 2 for i in range(60)}


def test_removed_lines_are_those_that_the_texts_lose(docs):
    rows = docs.where("doc_id is not null")
    removed = {r.doc_id: list(r.removed) for r in line_dedup.removed(rows).collect()}
    assert removed == {r.row.doc_id: list(r.removed) for r in line_dedup.deduplicated(rows).collect()}


def test_empty_tables(spark):
    nothing = corpus.empty(spark)
    assert minhash_dedup.classes(nothing).count() == 0
    assert minhash_dedup.deduplicated(nothing).count() == 0
    assert line_dedup.deduplicated(nothing).count() == 0
    assert substring_dedup.deduplicated(nothing).count() == 0


def test_texts_without_words_only(spark):
    blank = spark.createDataFrame([(1, None), (2, " \n "), (None, "")], "doc_id long, text string")
    assert minhash_dedup.deduplicated(blank).count() == 3
    assert line_dedup.deduplicated(blank).where("size(removed) > 0").count() == 0
    digests = substring_dedup.deduplicated(blank).select(F.sha2(F.coalesce("kept_text", F.lit("")), 256).alias("d"))
    assert {r.d for r in digests.collect()} == {hashlib.sha256(b"").hexdigest()}
