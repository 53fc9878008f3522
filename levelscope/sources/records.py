"""What a write of corrected events leaves beside its day folders: the schema, the number of files of each
day, and whether all timestamps are readable. Spark does not read folders with an underscore as data.

A record lets a reader unite columns by name without opening every file's footer, and a report skip the
scan for unreadable timestamps. It speaks for a table only as long as every file of every day is accounted
for: when others have added or removed files there is no answer, and readers look at the files.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levelscope.functions.payload import to_utc_timestamp
from levelscope.session import file_system, remove

FOLDER = "_records"


def facts(df: DataFrame) -> list[Column]:
    """Aggregates that are the same however often a task is run again: usable on a running write."""
    if not {"app_id", "event_ts"} <= set(df.columns):
        return []
    ts = to_utc_timestamp(F.col("event_ts"), df.schema["event_ts"].dataType)
    return [
        F.coalesce(F.max(ts.isNull()), F.lit(False)).alias("unreadable"),
        F.min("app_id").alias("first_app"),
        F.max("app_id").alias("last_app"),
        F.max(ts).cast("string").alias("last_ts"),  # in UTC, as the jobs set it
    ]


def _folders(spark: SparkSession, path: str) -> dict[str, int]:
    """Files in each folder of a table, and under ``""`` those beside the folders."""
    system, place = file_system(spark, path)
    found = {"": 0}
    for status in system.listStatus(place):
        name = status.getPath().getName()
        if name[0] in "_.":
            continue
        if status.isDirectory():
            found[name] = system.getContentSummary(status.getPath()).getFileCount()
        else:
            found[""] += 1
    return found


def merged_facts(*observed: dict) -> dict:
    """What several writes have observed, as of one; nothing if one has observed nothing."""
    if not all(observed):
        return {}
    folds = {"unreadable": any, "first_app": min, "last_app": max, "last_ts": max}
    values = {name: [f[name] for f in observed if f[name] is not None] for name in folds}
    return {name: fold(values[name]) if values[name] else None for name, fold in folds.items()}


def replace_records(spark: SparkSession, path: str, schema: T.StructType, observed: dict) -> None:
    """One record of the table as it is now, for all that there were."""
    remove(spark, f"{path}/{FOLDER}")
    write_record(spark, path, schema, observed)


def write_record(spark: SparkSession, path: str, schema: T.StructType, observed: dict) -> None:
    """The record of a table that was just written as a whole."""
    record = {"schema": json.loads(schema.json()), "folders": _folders(spark, path), "facts": observed}
    system, place = file_system(spark, f"{path}/{FOLDER}/{uuid.uuid4().hex}.json")
    out = system.create(place, False)
    try:
        out.write(bytearray(json.dumps(record).encode()))
    finally:
        out.close()


@dataclass(frozen=True)
class Record:
    schema: T.StructType
    facts: tuple[dict, ...]

    def all_readable(self, app_id: str) -> bool:
        """Whether it is sure that no event of the app has an unreadable timestamp."""
        return bool(self.facts) and all(
            f["unreadable"] is False or f["first_app"] is None or not f["first_app"] <= app_id <= f["last_app"]
            for f in self.facts
        )

    def last_event(self, app_id: str) -> datetime | None:
        """The time of the app's last event, if the events of other apps are told apart."""
        times = []
        for f in self.facts:
            if f.get("first_app") != app_id or f.get("last_app") != app_id or not f.get("last_ts"):
                return None
            times.append(datetime.fromisoformat(f["last_ts"]))
        return max(times, default=None)


def _united(schemas: list[T.StructType]) -> T.StructType | None:
    """All columns by name; none if one name has two types."""
    fields: dict[str, T.StructField] = {}
    for field in (f for schema in schemas for f in schema):
        if fields.setdefault(field.name, field).dataType != field.dataType:
            return None
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in fields.values()])


def table_record(spark: SparkSession, path: str) -> Record | None:
    """What the records say of a table, or None: without any, or when they do not account for its files."""
    if any(c in path for c in "*?[{"):
        return None
    system, place = file_system(spark, f"{path}/{FOLDER}")
    if not system.exists(place):
        return None
    records = []
    for status in system.listStatus(place):
        stream = system.open(status.getPath())
        try:
            records.append(json.loads(bytes(stream.readAllBytes()).decode()))
        finally:
            stream.close()
    counted: dict[str, int] = {}
    for record in records:
        for name, files in record["folders"].items():
            counted[name] = counted.get(name, 0) + files
    schema = _united([T.StructType.fromJson(record["schema"]) for record in records])
    if schema is None or counted != _folders(spark, path):
        return None
    return Record(schema, tuple(record["facts"] for record in records if record["facts"]))
