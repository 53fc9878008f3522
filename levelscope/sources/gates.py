"""Checks that stop a run before anything is computed. Each returns the frame it was given."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from levelscope.config import ADDED_COLUMNS, CORRECTED_COLUMNS, PAYLOAD_COLUMNS, RAW_COLUMNS, USER
from levelscope.functions.payload import check_payload_type

PARSED_TIME = "_event_ts_utc"  # fixed value: another column of corrected exports


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError("missing columns: " + ", ".join(missing))
    return df


def refuse_corrected(df: DataFrame) -> DataFrame:
    """Stage 1 must start from original events, not from its own output."""
    present = [name for name in (*ADDED_COLUMNS, PARSED_TIME) if name in df.columns]
    if present:
        raise ValueError("input is already corrected, it has " + ", ".join(present))
    return df


def require_timestamps(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps or UTC text only; epoch numbers are ambiguous."""
    allowed = (T.TimestampType, T.TimestampNTZType, T.StringType)
    for name in columns:
        kind = df.schema[name].dataType
        if not isinstance(kind, allowed):
            raise ValueError(
                f"{name} must be a UTC timestamp or timestamp text, not {kind.simpleString()}"
            )
    return df


def require_payloads(df: DataFrame) -> DataFrame:
    for name in PAYLOAD_COLUMNS:
        check_payload_type(df, name)
    return df


def raw_gate(df: DataFrame) -> DataFrame:
    require_columns(df, RAW_COLUMNS)
    refuse_corrected(df)
    require_timestamps(df, "event_ts")
    return require_payloads(df)


def corrected_gate(df: DataFrame) -> DataFrame:
    require_columns(df, CORRECTED_COLUMNS)
    require_timestamps(df, "event_ts", "first_clear_650_ts")
    return require_payloads(df)


def refuse_identity(report: DataFrame) -> DataFrame:
    if USER in report.columns:
        raise ValueError("a report must not carry user identities")
    return report


def refuse_over_cap(report: DataFrame, row_cap: int) -> DataFrame:
    """Fail rather than cut a report short."""
    if report.limit(row_cap + 1).count() > row_cap:
        raise ValueError(f"report has more than {row_cap} rows; raise the cap, rows are never cut")
    return report


def refuse_empty(report: DataFrame) -> DataFrame:
    if report.isEmpty():
        raise ValueError("the report is empty: check mode correction, period and variants")
    return report
