"""Secret scans: candidates by pattern, false positives removed by a random forest.

A candidate is a value of at least ``SHORTEST_VALUE`` characters assigned to a name, quoted or not
(``name = "value"``, ``"name": "value"``; between quotes any characters but blanks;
a name that is assigned to itself is no value), or a free run of at least ``SHORTEST_RUN`` characters of the alphabets that keys are
written in, which includes long words and numbers. Each is described by

* its length,
* its character transitions: the mean log probability of its neighbouring characters in the words of
  the corpus, the share of changes between letters, digits and others, and its entropy,
* dictionary coverage: the share of its characters within the corpus's frequent words,
* the path (source) it was found in: whether it names tests, examples or documentation,
* neighbouring words: whether it is assigned, quoted, and called by a name that secrets have, in the
  words before it, and whether the words around it are frequent words.

The dictionary (the ``DICTIONARY_WORDS`` most frequent words) and the transitions come from the
words of all documents. A Spark ML random forest is trained from labelled findings, of which at most
``TRAINING_ROWS`` of each label are used, those smallest by hash. Labels may be given (``labels``:
doc_id, start, label); else findings are labelled by evidence, much of which is not among the
features. Secrets are keys of known formats, mixed values of letters and digits assigned to a secret's
name, and long quoted ones of letters made up of few words. None are, unless assigned to a secret's
name, UUIDs, hashes named as a commit's or file's or within links, dated paths, and candidates of
letters only or digits only. What is assigned to a secret's name is never labelled none. All
candidates are then judged by the forest; without both labels there is none, and every candidate
stays (``score`` null).

Null texts have no candidates, a null path says nothing. Repeated rows give equal findings each.
Texts of any length are scanned whole. An empty table has no findings.
"""

from __future__ import annotations

import re
from collections import Counter
from math import log2

import pyarrow as pa
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levelscope.llm.language_id import word_counts
from levelscope.llm.token_counts import parts, texts_of
from levelscope.llm.workers import mapped
from levelscope.session import stage

SHORTEST_VALUE = 8
SHORTEST_RUN = 16
DICTIONARY_WORDS = 50_000
SHORTEST_WORD, LONGEST_WORD = 3, 12
TRAINING_ROWS = 20_000
#: Fixed word lists of the description: names that secrets go by, and paths that hold samples.
SECRET_NAMES = (
    "token", "secret", "passw", "pwd", "apikey", "api_key", "access_key", "private_key", "credential",
    "auth",
)
SAMPLE_PATHS = ("test", "example", "sample", "doc", "mock", "fixture")

CANDIDATE = re.compile(
    rf"""(?P<name>[A-Za-z][\w.\-]{{0,40}})["']?\s*+(?:=>|:=|[:=])\s*+
        (?:"(?P<double>[^\s"]{{{SHORTEST_VALUE},}}+)"|'(?P<single>[^\s']{{{SHORTEST_VALUE},}}+)'
        |["']?(?![A-Za-z][\w.\-]{{0,40}}+["']?(?:\s++(?:=>|:=|[:=])|:|=["'\w]))(?P<value>[A-Za-z0-9+/_\-=.]{{{SHORTEST_VALUE},}}))
    |(?<!\w)(?P<run>[A-Za-z0-9+/_\-=]{{{SHORTEST_RUN},}})(?!\w)""",
    re.VERBOSE,
)
KNOWN_KEY = re.compile(
    r"(?:AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|[sr]k_live_[A-Za-z0-9]{16,}"
    r"|xox[abpr]-[A-Za-z0-9-]{10,}|AIza[\w-]{35}|eyJ[\w-]{8,}\.[\w-]{8,}(?:\.[\w-]*)?"
)
UUID = re.compile(r"[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}", re.IGNORECASE)
HEX = re.compile(r"[0-9a-f]{7,128}", re.IGNORECASE)
#: What stands before a hash that names a commit or file, or is part of a link.
HASH_CONTEXT = re.compile(
    r"""(?:\b(?:commit|revision|rev|tree|parent|blob|index|sha\d*|md5|checksum)[\s:="'/\-]{1,4}|https?://\S*)$""",
    re.IGNORECASE,
)
DATED_PATH = re.compile(r"[^\s]*\b(?:19|20)\d\d[/\-]\d\d?[/\-][^\s]*/[^\s]*|[^\s]*/(?:19|20)\d\d/\d\d?/[^\s]*")
NEAR = 60
FEATURES = (
    "length", "transitions", "changes", "entropy", "coverage", "sample_path", "assigned", "quoted",
    "secret_name", "known_before", "known_after", "digits", "upper",
)


def statistics(words: DataFrame) -> tuple[set[str], dict[str, float]]:
    """The dictionary, and log probabilities of a character after another (bounded by the letters of
    the ASCII alphabet; others count as one)."""
    best = words.groupBy("word").agg(F.sum("n").alias("n"))
    best = best.where(F.length("word").between(SHORTEST_WORD, LONGEST_WORD))
    rows = best.orderBy(F.desc("n"), "word").limit(DICTIONARY_WORDS).select("word")
    dictionary = {r["word"] for r in rows.toLocalIterator()}

    def pairs(batches):
        out: Counter = Counter()
        for batch in batches:
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                plain = "".join(c if c.isascii() else "*" for c in f"^{word}$")
                for i in range(len(plain) - 1):
                    out[plain[i : i + 2]] += n
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.int64())], ["pair", "n"]
        )

    counts = mapped(words.select("word", "n"), pairs, "pair string, n long")
    found = {r["pair"]: r["n"] for r in counts.groupBy("pair").agg(F.sum("n").alias("n")).collect()}
    firsts: Counter = Counter()
    for pair, n in found.items():
        firsts[pair[0]] += n
    return dictionary, {pair: log2(n / firsts[pair[0]]) for pair, n in found.items()}


UNSEEN = -14.0


def _kind(c: str) -> str:
    return "d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "o"


def evidence(text: str, start: int, end: int) -> float | None:
    """1 for a key of a known format, 0 for what is known to be something else."""
    value = text[start:end]
    if KNOWN_KEY.fullmatch(value):
        return 1.0
    named = HEX.fullmatch(value) and HASH_CONTEXT.search(text[max(0, start - NEAR) : start])
    return 0.0 if named or UUID.fullmatch(value) or DATED_PATH.fullmatch(value) else None


def described(text: str, match: re.Match, path: str, dictionary: set[str], table: dict[str, float]):
    """Start, end and features of a candidate."""
    group = match.lastgroup
    value, (start, end) = match[group], match.span(group)
    low, n = value.lower(), len(value)
    marked = f"^{low}$"
    transitions = sum(table.get(marked[i : i + 2], UNSEEN) for i in range(n + 1)) / (n + 1)
    kinds = [_kind(c) for c in value]
    changes = sum(a != b for a, b in zip(kinds, kinds[1:])) / n
    entropy = -sum(k / n * log2(k / n) for k in Counter(low).values())
    known = i = 0
    while i < n:  # the longest frequent word from here on
        sizes = range(min(LONGEST_WORD, n - i), SHORTEST_WORD - 1, -1)
        size = next((s for s in sizes if low[i : i + s] in dictionary), 0)
        known += size
        i += size or 1
    before = re.findall(r"[^\W\d_]+", text[max(0, match.start() - NEAR) : match.start()].lower())
    after = re.findall(r"[^\W\d_]+", text[end : end + NEAR].lower())
    name = (match["name"] or " ".join(before[-2:])).lower()
    return start, end, [
        float(n),
        transitions,
        changes,
        entropy,
        known / n,
        float(any(p in path for p in SAMPLE_PATHS)),
        float(group != "run"),
        float(text[start - 1 : start] in ('"', "'") and start > 0),
        float(any(s in name for s in SECRET_NAMES)),
        float(bool(before) and before[-1] in dictionary),
        float(bool(after) and after[0] in dictionary),
        kinds.count("d") / n,
        kinds.count("u") / n,
    ]


def candidates(
    docs: DataFrame,
    dictionary: set[str],
    table: dict[str, float],
    *,
    key: str,
    text: str,
    path: str | None,
) -> DataFrame:
    """``doc_id``, ``start``, ``end`` (in characters), ``features`` and ``evidence``."""
    shared = docs.sparkSession.sparkContext.broadcast((dictionary, table))
    rows = docs.select(
        F.col(key).alias("doc_id"),
        F.col(text).alias("_text"),
        (F.coalesce(F.lower(F.col(path).cast("string")), F.lit("")) if path else F.lit("")).alias("_path"),
    )

    def run(batches):
        words, pairs = shared.value
        for part in (part for batch in batches for part in parts(batch)):
            owner, found = [], []
            for k, (body, where) in enumerate(zip(texts_of(part), part.column("_path").to_pylist())):
                for match in CANDIDATE.finditer(body):
                    owner.append(k)
                    start, end, features = described(body, match, where, words, pairs)
                    found.append((start, end, features, evidence(body, start, end)))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(owner, pa.int64())),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.int64()),
                    pa.array([f[2] for f in found], pa.list_(pa.float64())),
                    pa.array([f[3] for f in found], pa.float64()),
                ],
                ["doc_id", "start", "end", "features", "evidence"],
            )

    zero = F.lit(0).cast("long")
    schema = rows.select(
        "doc_id", zero.alias("start"), zero.alias("end"), F.array(F.lit(0.0)).alias("features"),
        F.lit(0.0).alias("evidence"),
    ).schema
    for field in schema:
        field.nullable = True
    return mapped(rows, run, schema)


def plain_labels(found: DataFrame) -> DataFrame:
    """Adds ``label`` to findings with evidence for it, null to the others."""
    at = {name: F.get("features", F.lit(i)) for i, name in enumerate(FEATURES)}
    mixed = (at["digits"] > 0) & (at["digits"] < 1)
    spelled = (at["digits"] == 0) & (at["quoted"] == 1) & (at["coverage"] < 0.5)
    called = (at["assigned"] == 1) & (at["secret_name"] == 1)
    plain = (at["digits"] == 0) | (at["digits"] == 1)
    return found.withColumn(
        "label",
        F.when(F.col("evidence") == 1, F.lit(1.0))
        .when(called & (mixed | spelled) & (at["length"] >= SHORTEST_RUN), F.lit(1.0))
        .when(~called & (plain | (F.coalesce("evidence", F.lit(1.0)) == 0)), F.lit(0.0)),
    )


def trained(labelled: DataFrame):
    """A forest from ``features`` and ``label``; None without both labels."""
    order = F.xxhash64("doc_id", "start", "end")
    rows = [
        labelled.where(F.col("label") == value).orderBy(order, "doc_id", "start").limit(TRAINING_ROWS)
        for value in (0.0, 1.0)
    ]
    sample = stage(
        rows[0].union(rows[1]).select(F.col("label"), array_to_vector("features").alias("vector")), "findings"
    )
    if sample.select("label").distinct().count() < 2:
        return None
    forest = RandomForestClassifier(
        featuresCol="vector", labelCol="label", probabilityCol="chance", predictionCol="found",
        numTrees=20, maxDepth=6, seed=7,
    )
    return forest.fit(sample)


def judged(found: DataFrame, forest) -> DataFrame:
    """Adds ``score``, the chance that a finding is a secret, and ``is_secret``."""
    if forest is None:
        return found.withColumn("score", F.lit(None).cast("double")).withColumn("is_secret", F.lit(True))
    rows = forest.transform(found.withColumn("vector", array_to_vector("features")))
    return (
        rows.withColumn("score", F.round(F.get(vector_to_array("chance"), F.lit(1)), 6))
        .withColumn("is_secret", F.col("score") >= 0.5)
        .drop("vector", "rawPrediction", "chance", "found")
    )


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    path: str | None = "source",
    labels: DataFrame | None = None,
) -> DataFrame:
    words = docs.select(F.lit("").alias("lang"), F.col(text).alias("_text"))
    counted = stage(word_counts(words), "corpus-words")
    found = stage(
        candidates(docs, *statistics(counted), key=key, text=text, path=path), "candidates"
    )
    labelled = plain_labels(found) if labels is None else found.join(labels, ["doc_id", "start"])
    return judged(found, trained(labelled)).select(
        "doc_id", "start", "end", *[F.get("features", F.lit(i)).alias(n) for i, n in enumerate(FEATURES)],
        "score", "is_secret",
    )
