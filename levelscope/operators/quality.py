"""Audits: one-row or report-sized frames that say whether the input can be trusted."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levelscope.config import USER, CorrectionConfig, ReportConfig
from levelscope.functions.game import local_date
from levelscope.functions.payload import payload_field, to_utc_timestamp


def timestamp_audit(df: DataFrame, app_id: str) -> DataFrame:
    """Rows of the app and how many of them have no readable timestamp."""
    ts = to_utc_timestamp(F.col("event_ts"), df.schema["event_ts"].dataType)
    return df.where(F.col("app_id") == app_id).agg(
        F.count("*").alias("rows"), F.count_if(ts.isNull()).alias("invalid_timestamps")
    )


def bad_timestamps(df: DataFrame, app_id: str) -> DataFrame:
    """Rows of the app without a readable timestamp: on timestamps a pushed IsNull, on text a scan
    of two columns."""
    ts = to_utc_timestamp(F.col("event_ts"), df.schema["event_ts"].dataType)
    return df.where((F.col("app_id") == app_id) & ts.isNull()).select("event_ts")


def refuse_null_timestamps(df: DataFrame, cfg: CorrectionConfig) -> DataFrame:
    """Stage 1 never drops a row silently. Stops at the first bad row it meets."""
    if not bad_timestamps(df, cfg.app_id).isEmpty():
        raise ValueError("event_ts has null or unreadable values; supply UTC timestamps")
    return df


def wrongly_kept_mode(events: DataFrame, cfg: ReportConfig) -> Column:
    """An originally classic event after the user's cutoff that was not re-labelled.

    The payload is looked at last, only for rows past a cutoff.
    """
    return (
        ~F.col("mode_fixed").eqNullSafe(cfg.mode_after)
        & (F.col("event_ts") > F.col("first_clear_650_ts"))
        & (payload_field(events, "event_params", "mode") == cfg.mode)
    )


def profile_columns(events: DataFrame, cfg: ReportConfig) -> list[Column]:
    """Aggregates of the input profile; also usable as observed metrics of a running write."""
    day = local_date(F.col("event_ts"), cfg.utc_offset_hours)
    return [
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("event_ts").isNull()).alias("invalid_timestamps"),
        F.min(day).alias("min_date"),
        F.max(day).alias("max_date"),
        F.count_if(wrongly_kept_mode(events, cfg)).alias("inconsistent_mode"),
    ]


def input_profile(events: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Rows, local date range, bad timestamps and the window they were taken from."""
    start, stop = cfg.window_utc()
    return events.agg(*profile_columns(events, cfg)).select(
        "*",
        F.lit(start.isoformat(" ")).alias("utc_start"),
        F.lit(stop.isoformat(" ")).alias("utc_end_exclusive"),
    )


def coverage(events: DataFrame, cfg: ReportConfig) -> DataFrame:
    """First and last local date; the last one is the natural end of observation."""
    day = local_date(F.col("event_ts"), cfg.utc_offset_hours)
    return events.agg(F.min(day).alias("min_date"), F.max(day).alias("observation_end"))


def mode_consistency(events: DataFrame, cfg: ReportConfig) -> DataFrame:
    return events.agg(F.count_if(wrongly_kept_mode(events, cfg)).alias("inconsistent_mode"))


def missing_cutoffs(cohort: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Classic cohort events of users past the milestone level for whom no clear is recorded."""
    return (
        cohort.where(
            (F.col("property_level") > float(cfg.milestone_level))
            & F.col("first_clear_650_ts").isNull()
        )
        .groupBy("event_name", USER)
        .agg(F.count("*").alias("events"))
        .groupBy("event_name")
        .agg(
            F.sum("events").alias("classic_events_with_missing_clear650"),
            F.count(USER).alias("affected_users"),
        )
    )


def check_profile(profile: dict, cfg: ReportConfig, whole_history: bool = False) -> dict:
    """Stop on an unusable input: empty, bad timestamps, too short, or not corrected."""
    if not profile["rows"] or profile["invalid_timestamps"]:
        raise ValueError(
            f"input is empty or has bad timestamps: rows={profile['rows']}, "
            f"invalid_timestamps={profile['invalid_timestamps']}"
        )
    if profile["max_date"] < cfg.observation_end:
        raise ValueError(
            f"input ends on {profile['max_date']}, before observation_end {cfg.observation_end}"
        )
    if whole_history and profile["min_date"] > cfg.report_start:
        raise ValueError(f"input starts on {profile['min_date']}, after the report start")
    if profile["inconsistent_mode"]:
        raise ValueError(
            f"{profile['inconsistent_mode']} classic events after a cutoff are not re-labelled; "
            "run the mode correction again"
        )
    return profile


def observation_end(last_date: date | None, declared: date | None) -> date:
    """The declared end of observation if the input reaches it, else the input's last date."""
    if last_date is None:
        raise ValueError("empty input")
    if declared is None:
        return last_date
    if declared > last_date:
        raise ValueError(f"observation end {declared} is after the last date in the input")
    return declared
