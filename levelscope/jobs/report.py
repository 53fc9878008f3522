"""spark-submit levelscope/jobs/report.py --input raw_fixed --output reports --config report.json

The JSON holds ``preset`` (``attempt_range`` or ``all_levels``) and the fields of
:class:`levelscope.config.ReportConfig`. Without ``observation_end`` the input's last date is used.
"""

from __future__ import annotations

import argparse
import json
from datetime import datetime, timedelta, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from levelscope.config import ReportConfig, to_date
from levelscope.operators.quality import (
    check_profile,
    coverage,
    missing_cutoffs,
    observation_end,
)
from levelscope.operators.retention import maturity_windows
from levelscope.plans.reports import levelplay_report, loss_report, prepare
from levelscope.session import published, run_key, scratch, stage, use_utc
from levelscope.sources.gates import (
    corrected_gate,
    refuse_empty,
    refuse_identity,
    refuse_over_cap,
)
from levelscope.sources.readers import read_corrected
from levelscope.sources.records import Record, table_record
from levelscope.sources.sinks import NOT_AVAILABLE, ROW_CAP, write_report_csv
from levelscope.sources.staging import app_events

# settings of the job itself
SETTINGS = ("preset", "row_cap", "union_by_name", "whole_history", "take_over")
PRESETS = {"attempt_range": ReportConfig.attempt_range, "all_levels": ReportConfig.all_levels}


def last_day(corrected, cfg: ReportConfig, record: Record | None = None):
    """The last local day of the app's events: as recorded, or else read; with date folders only
    the last ones are looked at."""
    last = record.last_event(cfg.app_id) if record else None
    if last is not None:
        return (last + timedelta(hours=cfg.utc_offset_hours)).date()
    by_day = "analysis_date_utc7"
    if by_day in corrected.columns and isinstance(corrected.schema[by_day].dataType, T.DateType):
        latest = corrected.agg(F.max(by_day)).first()[0]  # folder names, no columns
        if latest is not None:
            near = corrected.where(F.col(by_day) >= latest - timedelta(days=2))
            found = coverage(app_events(near, cfg), cfg).first()["observation_end"]
            if found is not None:
                return found
    return coverage(app_events(corrected, cfg), cfg).first()["observation_end"]


def report_config(corrected, settings: dict, record: Record | None = None) -> ReportConfig:
    fields = {k: v for k, v in settings.items() if k not in SETTINGS}
    make = PRESETS[settings.get("preset", "all_levels")]
    if "as_of_date" not in fields:
        local = timezone(timedelta(hours=fields.get("utc_offset_hours", 7)))
        fields["as_of_date"] = datetime.now(local).date()
    if "observation_end" not in fields:
        anyday = make(**fields, observation_end=fields["report_end"])
        fields["observation_end"] = observation_end(last_day(corrected, anyday, record), None)
    return make(**fields)


def run(spark: SparkSession, source: str, target: str, settings: dict) -> dict[str, str]:
    """Write the three reports and the missing-cutoff audit; the paths by name."""
    use_utc(spark)
    target = target.rstrip("/")
    row_cap = settings.get("row_cap", ROW_CAP)
    record = table_record(spark, source)
    corrected = corrected_gate(read_corrected(spark, source, settings.get("union_by_name", True)))
    cfg = report_config(corrected, settings, record)
    null_value = NOT_AVAILABLE if cfg.null_missing_ads else ""

    with scratch(spark):
        # with a level range, the audit of missing cutoffs counts every kind of event
        data = prepare(corrected, cfg, every_event=cfg.level_min is not None, record=record)
        check_profile(data.profile, cfg, whole_history=settings.get("whole_history", False))
        ends = spark.createDataFrame([(to_date(cfg.observation_end),)], "observation_end date")
        maturity_windows(ends, cfg).show(truncate=False)

        # Reports are small; each is computed once, and all are checked before any is published.
        levelplay = refuse_empty(stage(levelplay_report(data), "levelplay"))
        losses = stage(loss_report(data), "loss")
        missing = stage(missing_cutoffs(data.cohort, cfg), "missing")

        def losses_of(kind):
            return losses.where(F.col("loss_kind") == kind).drop("loss_kind")

        exports = {
            "levelplay_report": (levelplay, ("ab_group", "level")),
            "loss_report": (losses_of("first"), ("ab_group", "level")),
            "loss_all_attempts_report": (losses_of("all"), ("ab_group", "level")),
            "qa_missing_clear650": (missing, ("event_name",)),
        }
        for report, _ in exports.values():
            refuse_over_cap(refuse_identity(report), row_cap)
        run_of = {name: value for name, value in settings.items() if name != "take_over"}
        key = run_key({"input": source, "settings": run_of})
        with published(spark, target, key, settings.get("take_over", False)) as mode:
            paths = {name: f"{target}/{name}_csv" for name in exports}
            for name, (report, keys) in exports.items():
                write_report_csv(report, paths[name], keys, null_value, row_cap, mode)
    return paths


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--input", required=True, help="corrected events: folder, file or glob")
    parser.add_argument("--output", required=True, help="new folder for the CSV reports")
    parser.add_argument("--config", required=True)
    args = parser.parse_args()
    with open(args.config, encoding="utf-8") as handle:
        settings = json.load(handle)
    spark = SparkSession.builder.appName("levelscope-report").getOrCreate()
    try:
        for name, path in run(spark, args.input, args.output, settings).items():
            print(f"{name}: {path}")
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
