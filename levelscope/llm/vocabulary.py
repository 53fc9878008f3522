"""Vocabulary files of public tokenizers: sent to the executors as text, read there."""

from __future__ import annotations

import regex
from pyspark import Broadcast
from pyspark.sql import SparkSession


def shipped(spark: SparkSession, path: str) -> Broadcast:
    """The content of a vocabulary file (a few MB, whatever the size of the corpus)."""
    with open(path, encoding="utf-8") as file:
        return spark.sparkContext.broadcast(file.read())


def byte_symbols() -> list[str]:
    """How byte-level files write each byte.

    Printable characters of Latin-1 stand for themselves; the others, in order, for the characters
    from code point 256 on.
    """
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(256, 512))
    return [chr(b if b in plain else next(rest)) for b in range(256)]


def special_pattern(spec: dict):
    """Matches the strings that are tokens wherever they stand in a text."""
    strings = [regex.escape(t["content"]) for t in spec["added_tokens"]]
    return regex.compile("|".join(strings)) if strings else None
