"""The pipeline against plain versions of its stages, one after the other."""

import hashlib

from tokenizers import Tokenizer

import corpus_pipeline
from levelscope.llm import queries
from tests.llm import corpus
from tests.llm.test_duplicates import lines_by_hand
from tests.llm.test_single_documents import benchmark

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def written(spark, folder):
    docs = corpus.documents(spark).where("doc_id is not null").select(*COLUMNS)
    docs.write.parquet(f"{folder}/documents.parquet")
    benchmark(spark).write.parquet(f"{folder}/benchmark.parquet")
    return docs


def passes_base_rules(text):
    words = corpus.spaced(text)
    runs = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    again = {k + j for k, run in enumerate(runs) if runs.count(run) > 1 for j in range(8)} if len(words) < 1000 else ()
    return len(words) >= 20 and 100 * len(again) <= 30 * len(words)


def by_hand(spark, rows):
    rows = [(i, t) for i, t in rows if passes_base_rules(t)]
    lost = lines_by_hand(sorted(set(rows)))
    short = []
    for i, text in rows:
        kept = [x for n, x in enumerate(text.split("\n")) if n not in set(lost.get(i, ()))]
        if corpus.spaced("\n".join(kept)):
            short.append((i, "\n".join(kept)))
    forest, distinct = corpus.Forest(), sorted(set(short))
    bags = {row: corpus.bag(row[1]) for row in distinct}
    for x, a in enumerate(distinct):
        forest.find(a)
        for b in distinct[:x]:
            if corpus.jaccard(bags[a], bags[b]) >= 0.8:
                forest.join(a, b)
    alone = [row for row in distinct if forest.find(row) == row]
    passages = set()
    for row in benchmark(spark).collect():
        words = corpus.alnum(row.text)
        n = min(10, len(words))
        passages |= {tuple(words[k : k + n]) for k in range(len(words) - n + 1 if n else 0)}
    sizes = {len(p) for p in passages}

    def clean(text):
        words = corpus.alnum(text)
        return not any(tuple(words[k : k + n]) in passages for n in sizes for k in range(len(words) - n + 1))

    return [(i, t) for i, t in alone if clean(t)]


def test_run_equals_the_stages_by_hand(spark, tmp_path):
    docs = written(spark, str(tmp_path))
    want = by_hand(spark, [(r.doc_id, r.text) for r in docs.collect()])
    library = Tokenizer.from_file(queries.WORD_BPE)
    digests = []
    for i, text in want:
        ids = library.encode(text, add_special_tokens=False).ids
        spelled = library.decode(ids, skip_special_tokens=False)
        digests.append(
            (i, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), spelled)))
        )
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == sorted(digests)
    assert 10 < len(got) < docs.count()


def test_stages_return_documents(spark, tmp_path):
    docs = written(spark, str(tmp_path))
    for _, apply in corpus_pipeline.STAGES[:-1]:
        rows = apply(spark, docs, str(tmp_path))
        assert rows.columns == COLUMNS and rows.dtypes == docs.dtypes
        assert rows.where("n_chars <> length(text)").isEmpty()


def test_stages_bear_an_empty_table(spark, tmp_path):
    nothing = written(spark, str(tmp_path)).limit(0)
    for _, apply in corpus_pipeline.STAGES:
        assert apply(spark, nothing, str(tmp_path)).count() == 0


def test_stages_keep_clashing_columns(spark, tmp_path):
    written(spark, str(tmp_path))
    docs = corpus.documents(spark).where("doc_id is not null")
    for _, apply in corpus_pipeline.STAGES[:-1]:
        rows = apply(spark, docs, str(tmp_path))
        assert rows.columns == docs.columns and rows.count() > 0
