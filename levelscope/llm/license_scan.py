"""License scans by ordered signature rules.

Texts become words (A-Z lowered; runs of ASCII letters and digits or non-ASCII characters). A text is looked at
only if it holds a keyword of some rule, and a rule is tried only where its first words stand; it is then
matched against the words from there on. Of the detections that begin at one word the longest stays, and of equally long
ones that of the first rule. Then two suppressions are made, each on the detections as they are before it:
a detection goes if another one contains its words, and one that overlaps another goes if that comes from
an earlier rule. What is left gives labels, and the score is the greatest confidence of a rule among them.

Base phrases are counted apart, at every place: suppression takes no base label away, and a
text with a base phrase has a score of ``BASE_SCORE`` at least.

All is done within a row, by built-in functions: nothing is shuffled, and no Python runs on executors. The rules are a fixed list, and
work on a detection looks at the ``SPAN`` words around it only.

Null and empty texts have no words, empty labels and score 0. Equal rows get equal results. An empty
table gives an empty result; other columns may have any names.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levelscope.llm.license_rules import Rule, rules

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: Words that a rule may match at most.
SPAN = 24
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
BASE_SCORE = 0.5
_RULE = "array<struct<rank:int,label:string,pattern:string,confidence:double>>"


def _table(signatures: list[Rule]) -> Column:
    """The rules by their first words, a constant."""
    by_head: dict[str, list] = {}
    for rank, rule in enumerate(signatures):
        entry = {"rank": rank, "label": rule.label, "pattern": rule.anchored, "confidence": rule.confidence}
        by_head.setdefault(rule.head, []).append(entry)
    return F.from_json(F.lit(json.dumps(by_head)), f"map<string,{_RULE}>")


def _bound(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _word(w: Column, at) -> Column:
    return F.get(w, at.cast("int"))


def _window(w: Column, at: Column, size: int) -> Column:
    return F.array_join(F.slice(w, at.cast("int") + 1, size), " ")


def _detections(w: Column, places: Column, table: Column) -> Column:
    """The best detection at each place where there is one: ``start``, ``size``, ``rank``, ``label``, ``confidence``."""
    none = F.array().cast(_RULE)

    def best(place):
        two = F.concat_ws(" ", _word(w, place), _word(w, place + 1))
        tried = F.concat(
            F.coalesce(F.try_element_at(table, _word(w, place)), none),
            F.when(place + 1 < F.size(w), F.coalesce(F.try_element_at(table, two), none)).otherwise(none),
        )

        def matches(window):
            def match(rule):
                text = F.rtrim(F.call_function("regexp_extract", window, rule.pattern, F.lit(0)))
                return F.struct(
                    F.when(text != "", -F.size(F.split(text, " "))).alias("minus"),
                    rule["rank"].alias("rank"), rule["label"].alias("label"), rule["confidence"].alias("confidence"),
                )

            return F.filter(F.transform(tried, match), lambda m: m.minus.isNotNull())

        found = F.when(F.size(tried) > 0, _bound(_window(w, place, SPAN), matches))
        return F.struct(place.alias("start"), F.array_min(found).alias("hit"))

    hits = F.filter(F.transform(places, best), lambda d: d.hit.isNotNull())
    return F.transform(
        hits,
        lambda d: F.struct(
            d.start.alias("start"), (-d.hit.minus).alias("size"), d.hit["rank"].alias("rank"),
            d.hit["label"].alias("label"), d.hit["confidence"].alias("confidence"),
        ),
    )


def _without(found: Column, beats) -> Column:
    """The detections, in the order of their starts, that none near them beats."""

    def stays(all_):
        return F.filter(
            all_,
            lambda d, i: ~F.exists(
                F.slice(all_, F.greatest(F.lit(1), i + 1 - SPAN), F.lit(2 * SPAN)), lambda other: beats(other, d)
            ),
        )

    return _bound(found, stays)


def scan(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, signatures: list[Rule] | None = None
) -> DataFrame:
    """``row`` (the document, or its columns ``keep``, as a struct), ``n_words``, ``base`` (``start`` and ``label`` of each base
    phrase), ``detections`` (``start``, ``size``, ``rank``, ``label``, ``confidence``, by start) and ``score``."""
    signatures = rules() if signatures is None else signatures
    table = _table(signatures)
    keywords = sorted({rule.keyword for rule in signatures} | {phrase.split()[-1] for phrase in BASE})
    firsts = sorted({rule.head.split(" ")[0] for rule in signatures} | {phrase.split()[0] for phrase in BASE})

    def base_label(w, at):
        out = F.lit(None).cast("string")
        for phrase, label in BASE.items():
            parts = phrase.split()
            there = _word(w, at) == parts[0]
            for k, part in enumerate(parts[1:], 1):
                there &= F.coalesce(_word(w, at + k) == part, F.lit(False))
            out = F.when(there, label).otherwise(out)
        return out

    def judged(w):
        n = F.size(w)

        def looked_at(places):
            base = F.filter(
                F.transform(places, lambda i: F.struct(i.alias("start"), base_label(w, i).alias("label"))),
                lambda b: b.label.isNotNull(),
            )
            found = _without(
                _detections(w, places, table),
                lambda a, d: (a.start < d.start) & (a.start + a.size >= d.start + d.size),
            )
            found = _without(
                found,
                lambda a, d: (a.start < d.start + d.size) & (a.start + a.size > d.start) & (a["rank"] < d["rank"]),
            )
            return F.struct(base.alias("base"), found.alias("detections"))

        places = F.filter(F.sequence(F.lit(0), n - 1), lambda i: _word(w, i).isin(firsts))
        looked = F.when(
            F.arrays_overlap(w, F.array(*[F.lit(k) for k in keywords])), _bound(places, looked_at)
        )
        return F.struct(n.cast("long").alias("n_words"), looked.alias("looked"))

    names = keep or docs.columns
    words = F.regexp_extract_all(F.translate(F.coalesce(F.col(text), F.lit("")), UPPER, LOWER), F.lit(WORD), 0)
    rows = docs.select(F.struct(*names).alias("row"), _bound(words, judged).alias("_found"))
    no_base = F.array().cast("array<struct<start:int,label:string>>")
    no_hits = F.array().cast("array<struct<start:int,size:int,rank:int,label:string,confidence:double>>")
    parted = rows.select(
        "row", F.col("_found.n_words").alias("n_words"),
        F.coalesce("_found.looked.base", no_base).alias("base"),
        F.coalesce("_found.looked.detections", no_hits).alias("detections"),
    )
    sure = F.array_max(F.transform("detections", lambda d: d.confidence))
    lowest = F.when(F.size("base") > 0, F.lit(BASE_SCORE)).otherwise(F.lit(0.0))
    return parted.withColumn("score", F.greatest(lowest, F.coalesce(sure, F.lit(0.0))))
