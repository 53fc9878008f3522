"""Operators that look at a document, or a document and a small set: counts, codes, languages."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from levelscope.llm import (
    bpe_codec, decontamination, language_id, quality_rules, queries, secret_scan, sharding,
    token_counts,
)
from tests.llm import corpus

SPECIAL = ["<|endoftext|>", "a<|endoftext|><|startoftext|> b", "ΑΣ ΟΔΟΣ İx é", "aaaa" * 50, "  \n\t x  "]


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.documents(spark).cache()


def by_row(rows, *names):
    return sorted(map(tuple, rows.select(*names).collect()), key=repr)


def test_token_counts_equal_the_library(spark, docs):
    library = Tokenizer.from_file(queries.BYTE_BPE)
    more = spark.createDataFrame([(2000 + i, t) for i, t in enumerate(SPECIAL)], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(more)
    got = token_counts.with_token_counts(both, queries.BYTE_BPE).collect()
    assert len(got) == both.count()
    for row in got:
        text = row.text or ""
        assert row.n_bytes == len(text.encode())
        assert row.n_tokens == len(library.encode(text, add_special_tokens=False).ids), text[:60]


def test_token_counts_of_overlapping_pairs():
    counter = token_counts.counter(open(queries.BYTE_BPE, encoding="utf-8").read())
    library = Tokenizer.from_file(queries.BYTE_BPE)
    for n in range(1, 40):
        assert counter.count(["a" * n, "ab" * n, " " * n]) == [
            len(library.encode(t * n).ids) for t in ("a", "ab", " ")
        ]


def test_codes_equal_the_library_and_decode(spark, docs):
    library = Tokenizer.from_file(queries.WORD_BPE)
    more = spark.createDataFrame([(2000 + i, t) for i, t in enumerate(SPECIAL)], "doc_id long, text string")
    both = docs.select("doc_id", "text").union(more)
    coded = bpe_codec.decoded(bpe_codec.encoded(both, queries.WORD_BPE), queries.WORD_BPE)
    for row in coded.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert list(row.ids) == ids, (row.text or "")[:60]
        assert row.decoded == library.decode(ids, skip_special_tokens=False)
    one_pass = bpe_codec.round_trips(both, queries.WORD_BPE)
    assert by_row(one_pass, "doc_id", "ids", "decoded") == by_row(coded, "doc_id", "ids", "decoded")


def test_compatibility_is_that_of_merging():
    codec = bpe_codec.codec(open(queries.WORD_BPE, encoding="utf-8").read())
    library = Tokenizer.from_file(queries.WORD_BPE)
    for word in ("unbelievable", "aaaaaaaaaaab", "ththth" * 30, "naïveté", "日本語", "x" * 500):
        assert codec.encode_word(word) == library.encode(word).ids


def test_null_ids_decode_to_nothing(spark):
    rows = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert {r.decoded for r in bpe_codec.decoded(rows, queries.WORD_BPE).collect()} == {""}


def benchmark(spark):
    rows = [
        (1, " ".join((corpus.texts()[5][1] or "").split()[3:20])),
        (2, "ONE two, three"), (2, "ONE two, three"), (3, None), (4, "..."), (5, "z" * 3000),
        (None, "nine ten one two three four five six seven eight nine"), (6, "nowhere to be found at all"),
        (10, (corpus.texts()[24][1] or "")[5:400]),
    ]
    return spark.createDataFrame(rows, "item_id long, text string")


def leaks(docs, bench):
    passages: dict[tuple, set] = {}
    for row in bench.collect():
        words = corpus.alnum(row.text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            passages.setdefault(tuple(words[i : i + n]), set()).add(row.item_id)
    sizes = {len(p) for p in passages}
    out = []
    for row in docs.collect():
        words, hit, items = corpus.alnum(row.text), set(), set()
        for n in sizes:
            for i in range(len(words) - n + 1):
                if (found := passages.get(tuple(words[i : i + n]))) is not None:
                    hit |= set(range(i, i + n))
                    items |= found - {None}
        out.append((row.doc_id, len(words), sorted(hit), sorted(map(str, items))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_bytes", [decontamination.BLOCK_TEXT_BYTES, 300])
def test_leaks_equal_a_plain_search(spark, docs, block_bytes):
    bench = benchmark(spark)
    found = decontamination.scan(docs, bench, block_bytes=block_bytes).collect()
    got = []
    for r in found:
        spans = zip(r.hits[::2], r.hits[1::2])
        got.append((r.row.doc_id, r.n_words, [k for a, b in spans for k in range(a, b)], list(r["items"])))
    want = leaks(docs, bench)
    assert sorted(got, key=repr) == want
    assert any(w[3] for w in want)


def test_an_empty_benchmark_leaves_all_clean(spark, docs):
    found = decontamination.scan(docs, benchmark(spark).limit(0))
    assert found.where("size(hits) > 0").count() == 0 and found.count() == docs.count()


def test_languages_are_learned_and_told_apart(spark):
    words = {"de": "und der die nicht ist ein ich sie", "es": "que de no los por una con para", "fr": "les des est dans vous pas une sur"}
    rows = []
    for k, (lang, text) in enumerate(words.items()):
        parts = text.split()
        rows += [(100 * k + i, " ".join(parts[(i + j) % 8] for j in range(6)), lang) for i in range(20)]
    train = spark.createDataFrame(rows, "doc_id long, _text string, lang string")
    model = language_id.trained(language_id.word_counts(train))
    asked = [(1, "UND nicht", "x"), (2, "que para", "x"), (3, None, "x"), (4, "12 34!", "x"), (5, "vouss", "x"), (6, "", "x")]
    got = language_id.predicted(spark.createDataFrame(asked, "doc_id long, text string, lang_pred string"), model)
    found = {r.doc_id: (r.lang_pred, r.score) for r in got.collect()}
    assert [found[k][0] for k in range(1, 7)] == ["de", "es", "und", "und", "fr", "und"]
    assert all(0 <= score <= 1 for _, score in found.values())
    assert found[3][1] == 0


def test_nothing_to_learn_from_is_undetermined(spark, docs):
    nothing = spark.createDataFrame([], "doc_id long, _text string, lang string")
    found = language_id.predicted(docs, language_id.trained(language_id.word_counts(nothing)))
    assert [tuple(r) for r in found.select("lang_pred", "score").distinct().collect()] == [("und", 0.0)]


def test_word_backoff_takes_the_longest_known_run():
    tables = {0: {"word": (-1.0,)}, **{n: {} for n in range(1, 6)}}
    tables[3]["wor"], tables[2]["ze"] = (-2.0,), (-3.0,)
    scorer = language_id.Scorer(language_id.Model(["x"], tables))
    assert scorer.word("word") == (-1.0,) and scorer.word("wort") == -2.0
    assert scorer.word("zebra") == -3.0 and scorer.word("qqq") == 0.0


def test_every_word_of_training_counts(spark):
    """Words rarer than 100,000 others of another language still tell their own."""
    rng = random.Random(3)
    words = list(dict.fromkeys("".join(rng.choices("abcdefgh", k=7)) for _ in range(140_000)))
    rare, common = words[:20_000], words[20_000:]
    assert len(common) > 100_000
    rows = [(" ".join(common[i::50]), "en") for i in range(50)] * 2 + [(" ".join(rare[i::50]), "es") for i in range(50)]
    model = language_id.trained(
        language_id.word_counts(spark.createDataFrame(rows, "_text string, lang string"))
    )
    asked = spark.createDataFrame([(k, w) for k, w in enumerate(rare[:200])], "doc_id long, text string")
    assert {r.lang_pred for r in language_id.predicted(asked, model).collect()} == {"es"}


def test_scores_are_those_of_the_whole_model_in_memory(spark, docs):
    train = docs.select("_text", F.col("text").alias("t"), F.when(F.col("doc_id") % 20 == 0, "x").otherwise("y").alias("lang"))
    train = train.where("t is not null").select(F.expr("substring(t, 1, 300)").alias("_text"), "lang")
    model = language_id.trained(language_id.word_counts(train))
    tables = {
        n: {r.gram: tuple(r["values"]) for r in model.of_size(n).collect()} for n in range(language_id.LONGEST + 1)
    }
    scorer = language_id.Scorer(language_id.Model(model.langs, tables))
    few = language_id.predicted(docs, model, keep=["doc_id", "text"], hot=5)
    whole = language_id.predicted(docs, model, keep=["doc_id", "text"])
    assert by_row(few, "doc_id", "lang_pred", "score") == by_row(whole, "doc_id", "lang_pred", "score")
    for r in few.collect():
        words = language_id.LETTERS.findall((r.text or "").lower())
        total = sum((np.zeros(2) + scorer.word(w) for w in words), np.zeros(2))
        if words and abs(total[0] - total[1]) > 1e-3:
            assert r.lang_pred == model.langs[int(total.argmax())]
            assert abs(r.score - 1 / (1 + np.exp(-abs(total[0] - total[1]) / len(words) ** 0.5))) < 1e-4


def test_held_out_languages(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.language_query(spark, sf).join(queries.documents(spark, sf, "doc_id", "lang"), "doc_id")
    held = got.where("held_out")
    assert held.where("lang = lang_pred").count() >= 0.97 * held.count()


def test_shards_are_contiguous_and_near_equal(spark, docs):
    rows = sharding.measured(docs)
    got = sharding.shards(rows, 7).collect()
    sizes, slots, ids = Counter(), {}, {}
    for r in got:
        sizes[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
        ids.setdefault(r.shard, []).append(-1 if r.doc_id is None else r.doc_id)
    assert len(got) == docs.count()
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    ordered = [x for s in sorted(ids) for x in (min(ids[s]), max(ids[s]))]
    assert ordered == sorted(ordered)
    share, largest = sum(sizes.values()) / 7, max(r.size for r in got)
    assert all(abs(sum(sizes[s] for s in range(k + 1)) - (k + 1) * share) <= largest for k in range(7))
    import zlib

    texts = sorted((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for _, t, _ in corpus.texts())
    assert sorted((r.size, r.text_crc32) for r in got) == texts


def test_shards_of_nothing_and_of_few(spark, docs):
    assert sharding.shards(sharding.measured(corpus.empty(spark))).count() == 0
    one = sharding.shards(sharding.measured(docs.limit(1))).collect()
    assert len(one) == 1 and one[0].slot == 0 and 0 <= one[0].shard < 40


def quality_by_hand(limits):
    rows = corpus.texts()
    hosts, holders = {}, {}
    for i, text, host in rows:
        hosts.setdefault(host, set()).add(text)
        for line in (text or "").split("\n"):
            if corpus.spaced(line):
                first, bodies = holders.setdefault((host, norm(line)), (set(), set()))
                first.add((i is not None, i or 0, text))
                bodies.add(text)
    out = []
    for i, text, host in rows:
        words = corpus.spaced(text)
        n_symbols = sum((text or "").count(s) for s in quality_rules.SYMBOLS)
        lines = [x for x in (text or "").split("\n") if corpus.spaced(x)]
        windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
        again = {k + j for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for j in range(8)}
        lost = set()
        for line in lines:
            first, bodies = holders[host, norm(line)]
            often = len(bodies) > limits.max_docs and len(bodies) > limits.max_share * len(hosts[host])
            # the smallest id; nulls do not count where there is another
            named = min([f for f in first if f[0]] or list(first), key=lambda f: f[1])
            if often and (i, text) != ((named[1] if named[0] else None), named[2]):
                lost.add(norm(line))
        kept = sum(len(corpus.spaced(x)) for x in lines if norm(x) not in lost)
        failed = len(words) < 20 or 100 * len(again) > 30 * len(words)
        gone = bool(lost) and (kept < limits.min_words or kept < limits.min_kept * len(words))
        out.append((i, len(words), sum(map(len, words)), n_symbols, len(lines) - len(set(lines)), len(again), failed, not failed and not gone, len(lost), kept))
    return sorted(out, key=repr)


def norm(line):
    return "".join("0" if c in "123456789" else c for c in " ".join(corpus.spaced(line)).lower())


@pytest.mark.parametrize("max_docs", [3, 2, 1000])
def test_quality_equals_counting_by_hand(docs, max_docs):
    limits = quality_rules.LineLimits(max_docs=max_docs, max_share=0.01)
    got = by_row(
        quality_rules.judged(docs.where("doc_id is not null"), limits), "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", "kept", "n_frequent_lines", "kept_words",
    )
    rows, corpus_texts = corpus.texts(), corpus.texts
    try:
        corpus.texts = lambda: [r for r in rows if r[0] is not None]
        want = quality_by_hand(limits)
    finally:
        corpus.texts = corpus_texts
    assert got == want
    assert (max_docs == 1000) == (not any(w[8] for w in want))


def test_quality_keeps_rows_without_an_id(docs):
    got = quality_rules.judged(docs)
    assert got.count() == docs.count()
    assert got.where("row.doc_id is null").count() == 2


def test_native_quality_and_shards_run_no_python(spark, docs):
    for rows in (quality_rules.judged(docs), sharding.shards(sharding.measured(docs))):
        assert "Python" not in rows._jdf.queryExecution().toString() and "Arrow" not in rows._jdf.queryExecution().toString()


def finding_docs(spark):
    rows = []
    for i in range(60):
        digest = hashlib.sha1(str(i).encode()).hexdigest()
        rows.append((i, f'config: token = "{digest}" and more words here', "src/app"))
        rows.append((1000 + i, f"the number {10**15 + 7919 * i} and incomprehensibilities{'ab' * (i % 3)} follow", "docs/test"))
    rows += [(5000, None, None), (5001, "", "x"), (5002, "x" * 100000, None), (None, "nothing here", "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_assigned_values_are_candidates_however_written(spark):
    texts = {
        1: ('{"password": "hunter2pass1"}', "hunter2pass1"),
        2: ("{'api_key': 'abc123def456'}", "abc123def456"),
        3: ('password = "S3cr3t!pass99"', "S3cr3t!pass99"),
        4: ('password      =      "abcd1234xyz"', "abcd1234xyz"),
        5: ("token: abc123def456", "abc123def456"),
        6: ('secret = "abc123def456', "abc123def456"),
    }
    docs = spark.createDataFrame([(k, t, "src") for k, (t, _) in texts.items()], "doc_id long, text string, source string")
    found = secret_scan.scan(docs).collect()
    assert {r.doc_id: texts[r.doc_id][0][r.start : r.end] for r in found} == {k: v for k, (_, v) in texts.items()}
    assert all(r.assigned == 1 and r.secret_name == 1 for r in found)


def test_secrets_are_told_from_numbers_and_words(spark):
    found = secret_scan.scan(finding_docs(spark)).collect()
    secrets = {r.doc_id for r in found if r.is_secret}
    assert secrets == set(range(60))
    assert {r.doc_id for r in found} >= set(range(1000, 1060)) | {5002}


def test_hard_negatives_and_spelled_secrets_are_told_apart(spark):
    rng = random.Random(2)
    rows = []
    for i in range(60):
        digest, letters = hashlib.sha1(str(i).encode()).hexdigest(), "".join(rng.choices("bcdfghjklmnpqrstvwxz", k=20))
        # a third of each kind is written in a way that no label is given for
        held_out = i % 3 == 0
        name = f"{digest[:8]}-{digest[8:12]}-{digest[12:16]}-{digest[16:20]}-{digest[20:32]}"
        rows += [
            (i, f'config: token = "{digest}" and more words here'),
            (100 + i, f'config: password = "{letters[:14] if held_out else letters}" and more words here'),
            (200 + i, f"the change {'' if held_out else 'commit '}{digest[::-1]} was merged"),
            (300 + i, f"the row {name + 'x' if held_out else name} was read"),
            (400 + i, f"the number {10**15 + 7919 * i} and incomprehensibilities follow"),
        ]
    docs = spark.createDataFrame([(*r, "src/app") for r in rows], "doc_id long, text string, source string")
    found = secret_scan.scan(docs).collect()
    assert {r.doc_id for r in found if r.is_secret} == set(range(60)) | set(range(100, 160))
    assert {r.doc_id for r in found} >= {i for i, _ in rows}


def test_secret_scan_follows_given_labels(spark):
    docs = finding_docs(spark)
    found = secret_scan.scan(docs)
    labels = found.where("doc_id is not null").select(
        "doc_id", "start", F.when(F.col("doc_id") >= 1000, 1.0).otherwise(0.0).alias("label")
    )
    again = secret_scan.scan(docs, labels=labels).collect()
    assert all(r.is_secret == (r.doc_id >= 1000) for r in again)


def test_without_both_labels_every_candidate_stays(spark):
    docs = finding_docs(spark).where("doc_id >= 1000 and doc_id < 2000")
    found = secret_scan.scan(docs).collect()
    assert found and all(r.is_secret and r.score is None for r in found)


def test_empty_tables(spark):
    nothing = corpus.empty(spark)
    assert token_counts.with_token_counts(nothing, queries.BYTE_BPE).count() == 0
    assert bpe_codec.round_trips(nothing, queries.WORD_BPE).count() == 0
    assert quality_rules.judged(nothing).count() == 0
    assert decontamination.scan(nothing, benchmark(spark)).count() == 0
    assert secret_scan.scan(nothing).count() == 0
