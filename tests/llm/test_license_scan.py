"""Signature rules and their suppression, against a plain version."""

import re

import pytest

from levelscope.llm import license_scan, queries
from levelscope.llm.license_rules import Rule, rules
from tests.llm import corpus

BASE = {("cc", "by"): "cc-by", ("general", "public", "license"): "gpl", ("all", "rights", "reserved"): "reserved"}


def plain(text, signatures):
    """n_words, places of base phrases with labels, and the detections that stay."""
    words = corpus.alnum(text)
    base = [(i, label) for i in range(len(words)) for phrase, label in BASE.items()
            if tuple(words[i : i + len(phrase)]) == phrase]
    best = {}
    for rank, rule in enumerate(signatures):
        for i in range(len(words)):
            found = re.match(rule.anchored, " ".join(words[i:]))
            if found:
                key = (-len(found[0].split()), rank)
                best[i] = min(best.get(i, (1, 0)), key)
    hits = [(i, i - minus, rank) for i, (minus, rank) in sorted(best.items())]
    hits = [d for d in hits if not any(a[0] < d[0] and a[1] >= d[1] for a in hits)]
    hits = [d for d in hits if not any(a[0] < d[1] and a[1] > d[0] and a[2] < d[2] for a in hits)]
    return len(words), base, hits


TEXTS = [
    "Licensed under CC BY-NC 4.0.\nall the rest",
    "licensed under the terms of the GNU General Public License, version 2 or any later version",
    "GNU Lesser General Public License v2.1; see www.gnu.org/licenses/old-licenses/lgpl-2.1.html",
    "SPDX-License-Identifier: Apache-2.0 OR MIT\nCopyright (c) 2019 somebody. All rights reserved.",
    "CC BY CC BY cc by-sa 3.0 unported",
    "All Rights Reserved all rights reserved. all rights",
    "the general public license general public licence",
    "the MIT license, new BSD License, bsd-3-clause license released under the Unlicense",
    "cc", "by", "cc  by", "license", "licensed under", "éall rights reserved", "all\trights\n\nreserved",
    "creative commons attribution non-commercial no derivatives works version 4.0 international",
    None, "", "  ", "x" * 5000, "All rights reserved. " * 700, "licensed under the mit license " * 300,
]


def test_detections_equal_the_law(spark):
    signatures = rules()
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    docs = spark.createDataFrame(rows + rows[:3], "doc_id long, text string")
    got = license_scan.scan(docs).collect()
    assert len(got) == len(rows) + 3
    for row in got:
        n, base, hits = plain(row.row.text, signatures)
        assert row.n_words == n
        assert [(b.start, b.label) for b in row.base] == base, row.row.text[:80]
        assert [(d.start, d.start + d.size, d["rank"]) for d in row.detections] == hits, row.row.text[:80]
        sure = max((signatures[h[2]].confidence for h in hits), default=0.0)
        assert row.score == max(sure, 0.5 if base else 0.0)


def test_containment_and_priority(spark):
    """Of overlapping detections the containing one stays, else the one of the earlier rule."""
    made = [
        Rule("late-part", "two three", 0.9), Rule("early", "three four", 0.8), Rule("whole", "one two three", 0.7),
        Rule("same", "three( four)?", 0.6), Rule("alone", "nine", 0.4),
    ]
    docs = spark.createDataFrame([(1, "zero one two three four five nine")], "doc_id long, text string")
    row = license_scan.scan(docs, signatures=made).first()
    # "two three" lies within "one two three", which overlaps "three four" of the earlier rule
    assert [(d.label, d.start, d.size) for d in row.detections] == [("early", 3, 2), ("alone", 6, 1)]
    assert row.score == 0.8


def test_every_rule_finds_its_own_words(spark):
    """A text made of the plain words of a rule's pattern is found by it or by one that is as long."""
    signatures = rules()
    assert len(signatures) > 300 and len({r.label for r in signatures}) > 80
    for rule in signatures:
        assert rule.plain and rule.keyword in rule.plain and rule.head.split() == rule.plain[:2]
        assert re.match(rf"{rule.head}(?![a-z0-9])", rule.pattern.replace("(?: version", " (?: version") + " ")

    def widest(pattern):  # words of the longest text that a pattern matches: all options, the longest choice
        while "(" in pattern:
            pattern = re.sub(r"\((?:\?:)?([^()]*)\)\??", lambda m: max(m[1].split("|"), key=lambda o: o.count(" ")), pattern)
        return len(pattern.replace("?", "").split())

    assert max(widest(r.pattern) for r in signatures) <= license_scan.SPAN


def test_no_python_on_executors(spark):
    docs = spark.createDataFrame([(1, "x")], "doc_id long, text string")
    plan = license_scan.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_clashing_columns_and_empty_tables(spark):
    docs = corpus.documents(spark).withColumnsRenamed({"hits": "base", "ids": "detections", "node": "_found"})
    got = license_scan.scan(docs)
    assert got.count() == docs.count()
    assert {r.row.source for r in got.collect()} == {r.source for r in docs.collect()}
    assert license_scan.scan(corpus.empty(spark)).collect() == []


@pytest.mark.parametrize(
    "text, base, labels",
    [
        ("Licensed under CC BY-NC 4.0.", "cc-by", "cc-by,cc-by-nc-4.0"),
        ("GNU General Public License", "gpl", "gpl"),
        ("SPDX-License-Identifier: BSD-3-Clause", "", "bsd-3-clause"),
        ("no license at all", "", ""),
    ],
)
def test_the_query_lists_labels(spark, tmp_path, text, base, labels):
    spark.createDataFrame([(1, text)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = queries.license_query(spark, str(tmp_path)).first()
    assert (row.base_labels, row.labels) == (base, labels)
