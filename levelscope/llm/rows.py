"""Carrying a document's other columns past a shuffle or a task, with its text only once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Carried:
    """Columns ``_rest`` and ``_text`` for a document, and the struct ``row`` made of them again."""

    def __init__(self, docs: DataFrame, text: str, keep: list[str] | None = None):
        self.names, self.text = list(keep or docs.columns), text

    @property
    def columns(self) -> list[Column]:
        others = [F.col(name) for name in self.names if name != self.text]
        return [F.struct(*others, F.lit(True).alias("_pad")).alias("_rest"), F.col(self.text).alias("_text")]

    @property
    def row(self) -> Column:
        fields = [
            (F.col("_text") if name == self.text else F.col("_rest").getField(name)).alias(name)
            for name in self.names
        ]
        return F.struct(*fields).alias("row")
