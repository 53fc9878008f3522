"""Reading raw and corrected events."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from levelscope.sources.records import table_record

FORMATS = ("parquet", "orc", "delta", "json", "csv")
# The CSV profile of raw exports.
CSV_PROFILE = {
    "header": "true",
    "inferSchema": "false",
    "multiLine": "true",
    "quote": '"',
    "escape": '"',
    "mode": "FAILFAST",
}


def read_raw(
    spark: SparkSession, path: str, fmt: str = "parquet", options: Mapping[str, str] | None = None
) -> DataFrame:
    """Raw events in any of :data:`FORMATS`. Delta needs its connector on the cluster."""
    if fmt not in FORMATS:
        raise ValueError(f"unsupported source format {fmt!r}; use one of {', '.join(FORMATS)}")
    settings = dict(options or {})
    if fmt == "csv":
        settings.update(CSV_PROFILE)
    return spark.read.format(fmt).options(**settings).load(path)


def read_corrected(spark: SparkSession, path: str, union_by_name: bool = True) -> DataFrame:
    """Corrected events from a folder, a file or a glob.

    Files may have different columns, which are united by name. Tables that stage 1 has written carry a record of
    their columns; of others every file footer is read, by a job of its own, unless ``union_by_name`` is
    off: then the columns are those of one file. Date folders written by stage 1 come
    back as the partition column ``analysis_date_utc7``.
    """
    record = table_record(spark, path) if union_by_name else None
    if record:
        return spark.read.schema(record.schema).parquet(path)
    return spark.read.option("mergeSchema", str(union_by_name).lower()).parquet(path)
