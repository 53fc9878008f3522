"""Cutting the report window out of the corrected history."""

from __future__ import annotations

from datetime import timedelta
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levelscope.config import CORRECTED_COLUMNS, PAYLOAD_COLUMNS, REPORT_EVENTS, ReportConfig
from levelscope.functions.game import utc_literal
from levelscope.functions.payload import to_utc_timestamp
from levelscope.sources.gates import corrected_gate

TIMESTAMPS = ("event_ts", "first_clear_650_ts")
PUSHED_NAMES = 6  # Spark passes on lists of up to 10 values by default


def app_events(df: DataFrame, cfg: ReportConfig) -> DataFrame:
    """The eleven needed columns of the app's events, with proper timestamps."""
    corrected_gate(df)
    columns = []
    for name in CORRECTED_COLUMNS:
        if name in TIMESTAMPS:
            columns.append(to_utc_timestamp(F.col(name), df.schema[name].dataType).alias(name))
        elif name in PAYLOAD_COLUMNS:
            columns.append(F.col(name))
        else:
            columns.append(F.col(name).cast("string").alias(name))
    return df.where(F.col("app_id") == cfg.app_id).select(*columns)


def report_window(df: DataFrame, cfg: ReportConfig) -> DataFrame:
    """App events from report start to the end of observation.

    The bounds sit on the bare ``event_ts``, so they reach the Parquet scan. Date folders of
    stage 1 are pruned as well, with two days to spare on either side: they were cut by the offset
    of stage 1, which may differ from the report's by up to 26 hours.
    """
    start, stop = cfg.window_utc()
    events = df
    by_day = "analysis_date_utc7"
    if by_day in df.columns and isinstance(df.schema[by_day].dataType, T.DateType):
        spare = timedelta(days=2)
        last_day = max(cfg.report_end, cfg.observation_end) + spare
        events = events.where(F.col(by_day).between(cfg.report_start - spare, last_day))
    events = app_events(events, cfg)
    kind = events.schema["event_ts"].dataType.simpleString()
    return events.where(
        (F.col("event_ts") >= utc_literal(start, kind))
        & (F.col("event_ts") < utc_literal(stop, kind))
    )


def only_report_events(df: DataFrame) -> DataFrame:
    """Drop event kinds no report looks at, before their payloads are decoded.

    The list is asked in parts: of longer lists only the smallest and the greatest name reach the
    Parquet scan, which would keep nearly all kinds.
    """
    parts = [REPORT_EVENTS[i : i + PUSHED_NAMES] for i in range(0, len(REPORT_EVENTS), PUSHED_NAMES)]
    return df.where(reduce(or_, [F.col("event_name").isin(*part) for part in parts]))
