"""Work of the pipeline's stages that is done once: base counts, line hashes, ids of words."""

import random
from pathlib import Path

from pyspark.sql import functions as F

import corpus_pipeline
from levelscope.llm import bpe_codec, quality_rules, queries


def test_base_counts_and_lines_are_made_once(spark, monkeypatch):
    calls = []
    made = quality_rules._lines
    monkeypatch.setattr(quality_rules, "_lines", lambda *a: calls.append(1) or made(*a))
    rows = [(k, f"line {k} of words\nwhat all have\n" + "word " * k, "en", "a", 9) for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.quality(spark, docs, "")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert len(calls) == 1
    assert plan.count(quality_rules.SYMBOLS) == 1  # not in a filter and once more above it


def test_words_and_digits_of_lines(spark):
    rng = random.Random(4)
    kinds = ["a", "B1", "0", "987", "é٣", "漢", " ", "  ", "\t", "\x0b", "\x0c", "\r", "\x1c", "\xa0", "\x85", "ΑΣ", "İ", "😀", "$|", "^"]
    lines = ["".join(rng.choices(kinds, k=rng.randint(0, 12))) for _ in range(3000)]
    table = spark.createDataFrame([(x,) for x in lines], "line string")
    line = F.col("line")
    squeezed = F.btrim(F.regexp_replace(line, r"[ \t-\r]+", " "))
    short = quality_rules.normalised(line)
    n_symbols = F.length(line) - F.length(F.translate(line, quality_rules.SYMBOLS, ""))
    got = table.select(
        quality_rules.has_word(line).alias("there"),
        (F.length(F.btrim(line, F.lit(quality_rules.BLANKS))) > 0).alias("want_there"),
        short.alias("short"),
        F.translate(F.lower(squeezed), "123456789", "000000000").alias("want_short"),
        quality_rules.normalised_words(short).alias("words"),
        F.size(quality_rules.words_of(line)).alias("want_words"),
    ).collect()
    for r in got:
        assert r.there == r.want_there and r.short == r.want_short
        assert not r.there or r.words == r.want_words
    assert 100 < sum(r.there for r in got) < 3000
    counted = quality_rules.base_counts(table, "line").select("line", "_base.n_symbols", n_symbols.alias("want")).collect()
    assert len(counted) == 3000 and all(r.n_symbols == r.want for r in counted)


def test_words_of_a_full_cache_are_taken_over(monkeypatch):
    tables = bpe_codec.Codec(Path(queries.WORD_BPE).read_text())
    encoded = []
    whole = tables.encode_words
    monkeypatch.setattr(tables, "encode_words", lambda words: encoded.extend(words) or whole(words))
    monkeypatch.setattr(bpe_codec, "CACHE_ENTRIES", 60)
    rng = random.Random(2)
    texts = ["the unbelievable blocks " + "".join(rng.choices("abcdefgh ", k=200)) for _ in range(40)]
    want = [tables.encode([text])[0].tolist() for text in texts]
    assert encoded.count("unbelievable") == 1 and len(tables.codes) < 120
    for text, ids in zip(texts, want):
        fresh = [i for word in tables.words(text) for i in whole([word])[0]]
        assert ids == fresh
