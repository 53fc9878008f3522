"""A small corpus with the cases that every operator has to bear, and plain versions of results."""

from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: Other columns, with names that the operators use themselves.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row string, _row string, "
    "_text string, n_words long, hits string, ids string, node long, lost string, shard int, size long"
)


def prose(rng: random.Random, words: int) -> str:
    stems = ["ta", "ri", "mon", "é", "su", "la", "ber", "ñi", "ok", "dra", "Fel", "ün"]
    out = ["".join(rng.choice(stems) for _ in range(rng.randint(1, 4))) for _ in range(words)]
    for i in range(9, words, 10):
        out[i] += rng.choice([".", ".\n", ",", "\n"])
    return " ".join(out)


def texts() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, source): copies, near copies, shared passages and lines, and odd texts."""
    rng = random.Random(5)
    out: list[tuple[int | None, str | None, str | None]] = []
    plain = [prose(rng, rng.choice([30, 80, 200])) for _ in range(24)]
    passage, line = prose(rng, 70).replace("\n", " "), "Share this page with all of your friends today."
    for i, text in enumerate(plain):
        body = text + ("\n" + line if i % 3 == 0 else "")
        if i in (4, 9, 15):
            body = f"{body[: len(body) // 2]} {passage} {body[len(body) // 2 :]}"
        out.append((10 * i, body, "hot" if i % 2 else f"src{i % 5}"))
    for k in range(12):  # copies and near copies of one text
        words = plain[7].split(" ")
        if k % 2:
            words[(11 * k) % len(words)] = f"changed{k}"
        out.append((500 + k, " ".join(words), "hot"))
    repeated = "one two three four five six seven eight nine ten " * 12
    odd = [None, "", " ", "\n\n\t", "x", "a b c d", "É È é", repeated, "z" * 3000, "tail\n" * 30]
    out += [(800 + i, text, None if i % 2 else "odd") for i, text in enumerate(odd)]
    out.append((900, prose(rng, 20000), "long"))
    out.append((None, plain[3], "hot"))
    out.append((None, "a text without an id, of a few words", None))
    out += [out[2]] * 3  # repeated rows
    return out


def documents(spark: SparkSession) -> DataFrame:
    rows = [
        (i, t, None if i is None or i % 7 == 0 else "en", s, None if t is None else len(t), *["x"] * 3, 1, "x", "x", 2, "x", 3, 4)
        for i, t, s in texts()
    ]
    return spark.createDataFrame(rows, SCHEMA)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def spaced(text: str | None) -> list[str]:
    return SPACED.findall(text or "")


def alnum(text: str | None) -> list[str]:
    return ALNUM.findall((text or "").translate(UPPER))


class Forest:
    """Union-find over anything that sorts."""

    def __init__(self):
        self.parent: dict = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y) -> None:
        a, b = self.find(x), self.find(y)
        self.parent[max(a, b)] = min(a, b)


def bag(text: str | None, size: int = 5) -> Counter:
    words = [w.translate(UPPER) for w in spaced(text)]
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))) if words else Counter()


def jaccard(a: Counter, b: Counter) -> float:
    return sum((a & b).values()) / max(1, sum((a | b).values()))
