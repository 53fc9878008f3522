"""What a written table says of itself, and when nobody may rely on it."""

from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from levelscope.jobs.report import last_day
from levelscope.plans.reports import prepare
from levelscope.sources.gates import raw_gate
from levelscope.sources.readers import read_corrected
from levelscope.sources.records import table_record
from levelscope.sources.sinks import write_corrected
from levelscope.sources.staging import report_window
from tests.golden import ALL, APP, base_rows, frame

DAY = "analysis_date_utc7"


def dated(df, offset=7):
    return df.withColumn(DAY, F.to_date(F.col("event_ts").cast("timestamp") + F.make_dt_interval(hours=F.lit(offset))))


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "fixed")
    write_corrected(dated(frame(spark, base_rows())), path)
    return path


def jobs_of(spark, label, action):
    """Spark jobs that an action starts."""
    spark.sparkContext.setJobGroup(label, label)
    try:
        result = action()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(label)), result


def test_a_recorded_table_is_read_without_footers(spark, table, tmp_path):
    n, events = jobs_of(spark, "recorded", lambda: read_corrected(spark, table))
    assert n == 0
    assert set(events.columns) == {*frame(spark, []).columns, DAY} and events.count() == len(base_rows())
    assert dict(events.dtypes)[DAY] == "date"
    frame(spark, base_rows()).write.parquet(str(tmp_path / "plain"))
    n, _ = jobs_of(spark, "plain", lambda: read_corrected(spark, str(tmp_path / "plain")))
    assert n == 1


def test_files_of_others_are_seen(spark, table):
    """A file with one more column, put into a day's folder: the record no longer speaks for the table."""
    more = frame(spark, base_rows()[:2]).withColumn("city", F.lit("Oslo"))
    more.write.mode("append").parquet(f"{table}/{DAY}=2026-03-09")
    assert table_record(spark, table) is None
    events = read_corrected(spark, table)
    assert "city" in events.columns
    assert events.count() == len(base_rows()) + 2 and events.where("city = 'Oslo'").count() == 2


def test_lost_files_are_seen(spark, table):
    assert table_record(spark, table) is not None
    one = next(Path(table).glob(f"{DAY}=2026-03-09/*.parquet"))
    one.rename(one.with_name("_put_aside"))
    assert table_record(spark, table) is not None  # it is still a file of that folder: moved, not counted away
    moved = next(Path(table).glob(f"{DAY}=2026-03-10/*.parquet"))
    moved.rename(Path(table).parent / "gone.parquet")
    assert table_record(spark, table) is None


def test_folders_of_other_days_are_seen(spark, table):
    dated(frame(spark, base_rows()[:1])).withColumn(DAY, F.lit(date(2026, 5, 1))).write.mode("append").partitionBy(
        DAY
    ).parquet(table)
    assert table_record(spark, table) is None


def test_readable_timestamps_need_no_scan(spark, table):
    record = table_record(spark, table)
    assert record.all_readable(APP) and record.all_readable("another")
    events = read_corrected(spark, table)
    with_record, data = jobs_of(spark, "with", lambda: prepare(events, ALL, record=record))
    without, same = jobs_of(spark, "without", lambda: prepare(events, ALL))
    assert data.profile == same.profile and data.profile["invalid_timestamps"] == 0
    assert with_record < without


def test_unreadable_timestamps_are_recorded(spark, tmp_path):
    rows = frame(spark, base_rows()).withColumn("event_ts", F.col("event_ts").cast("string"))
    bad = rows.limit(1).withColumn("event_ts", F.lit("soon"))
    path = str(tmp_path / "fixed")
    write_corrected(rows.union(bad).withColumn(DAY, F.lit(date(2026, 3, 9))), path)
    record = table_record(spark, path)
    assert not record.all_readable(APP)
    assert prepare(read_corrected(spark, path), ALL, record=record).profile["invalid_timestamps"] == 1


def test_the_last_day_is_recorded(spark, table):
    record, events = table_record(spark, table), read_corrected(spark, table)
    latest = max(r[2] for r in base_rows())
    assert record.last_event(APP) == latest and record.last_event("another") is None
    for offset in (7, -12, 14):
        cfg = ALL.with_(utc_offset_hours=offset)
        want = (latest + timedelta(hours=offset)).date()
        n, day = jobs_of(spark, f"last{offset}", lambda: last_day(events, cfg, record))
        assert (n, day) == (0, want)
        assert last_day(events, cfg) == want


def test_apps_are_told_apart(spark, tmp_path):
    two = frame(spark, base_rows()).union(frame(spark, base_rows()).withColumn("app_id", F.lit("zoo")))
    path = str(tmp_path / "fixed")
    write_corrected(dated(two), path)
    assert table_record(spark, path).last_event(APP) is None
    assert last_day(read_corrected(spark, path), ALL, table_record(spark, path)) == date(2026, 3, 15)


def test_globs_and_single_files_have_no_record(spark, table):
    assert table_record(spark, f"{table}/{DAY}=*") is None
    one = next(Path(table).glob(f"{DAY}=2026-03-09/*.parquet"))
    assert table_record(spark, str(one)) is None
    assert read_corrected(spark, str(one)).count() > 0


@pytest.mark.parametrize("made, asked", [(14, -12), (-12, 14), (7, 7), (0, 14)])
def test_day_folders_of_any_offset(spark, tmp_path, made, asked):
    """A report sees all events of its window, however far its days are from those of the folders."""
    start = datetime(2026, 3, 5)
    rows = spark.range(24 * 14).select(
        F.lit(APP).alias("app_id"), F.concat(F.lit("p"), "id").alias("user_pseudo_id"),
        (F.lit(start) + F.make_dt_interval(hours=F.col("id"))).alias("event_ts"),
        *[F.lit(None).cast("string").alias(c) for c in ("event_name", "event_params", "user_properties", "mode_fixed")],
        F.lit(None).cast("timestamp").alias("first_clear_650_ts"),
        *[F.lit(None).cast("string").alias(c) for c in ("app_version", "country", "platform")],
    )
    write_corrected(dated(rows, made), str(tmp_path / "fixed"))
    cfg = ALL.with_(utc_offset_hours=asked)
    got = report_window(read_corrected(spark, str(tmp_path / "fixed")), cfg).count()
    assert got == 24 * 7  # 9 to 15 March


def test_corrected_exports_are_refused(spark):
    raw = frame(spark, base_rows()).drop("mode_fixed", "first_clear_650_ts")
    assert raw_gate(raw) is raw
    for name in ("_event_ts_utc", "fix_reason"):
        with pytest.raises(ValueError, match=f"already corrected, it has {name}"):
            raw_gate(raw.withColumn(name, F.lit(1)))
