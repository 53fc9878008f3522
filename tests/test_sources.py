"""Readers, gates and writers on real files."""

import csv
from datetime import date
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from levelscope.config import CORRECTED_COLUMNS, ReportConfig
from levelscope.operators.quality import check_profile, observation_end
from levelscope.sources.gates import (
    corrected_gate, refuse_empty, refuse_identity, refuse_over_cap, require_columns,
)
from levelscope.sources.readers import read_corrected, read_raw
from levelscope.sources.sinks import write_corrected, write_cutoffs, write_report_csv
from tests.golden import ALL, PERIOD, base_rows, frame

RAW = ["app_id", "user_pseudo_id", "event_ts", "event_name", "event_params", "user_properties"]


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_raw_formats(spark, tmp_path, fmt):
    raw = frame(spark, base_rows()).select(*RAW)
    writer = raw.write.format(fmt)
    if fmt == "csv":
        writer = writer.option("header", "true").option("quote", '"').option("escape", '"')
    writer.save(str(tmp_path / "raw"))
    back = read_raw(spark, str(tmp_path / "raw"), fmt).select(*RAW)
    shape = [F.col(c).cast("string") if c != "event_ts" else F.col(c).cast("timestamp") for c in RAW]
    left = sorted(str(r) for r in raw.select(*shape).collect())
    assert sorted(str(r) for r in back.select(*shape).collect()) == left


def test_csv_profile(spark, tmp_path):
    """Quotes and line breaks inside fields; a ragged line stops the read."""
    path = tmp_path / "a.csv"
    path.write_text('app_id,event_params\nx,"{""a"":\n1}"\n007,"{}"\n')
    rows = [tuple(r) for r in read_raw(spark, str(path), "csv").collect()]
    assert rows == [("x", '{"a":\n1}'), ("007", "{}")]
    bad = tmp_path / "b.csv"
    bad.write_text("a,b\n1,2\n3,4,5\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_raw(spark, str(bad), "csv").collect()


def test_unknown_format(spark):
    with pytest.raises(ValueError, match="unsupported"):
        read_raw(spark, "/nowhere", "avro")


def test_corrected_reader(spark, tmp_path):
    """Date folders become a column again; files with other columns are united by name; globs."""
    one = frame(spark, base_rows()).withColumn("analysis_date_utc7", F.to_date("event_ts"))
    write_corrected(one, str(tmp_path / "fixed"))
    back = read_corrected(spark, str(tmp_path / "fixed"))
    assert dict(back.dtypes)["analysis_date_utc7"] == "date"
    assert back.count() == one.count()
    one.drop("analysis_date_utc7").write.parquet(str(tmp_path / "parts/a"))
    one.drop("analysis_date_utc7", "country").write.parquet(str(tmp_path / "parts/b"))
    both = read_corrected(spark, str(tmp_path / "parts/*"), union_by_name=True)
    assert set(CORRECTED_COLUMNS) <= set(both.columns) and both.count() == 2 * one.count()
    corrected_gate(both)


def test_rebalanced_write(spark, tmp_path):
    df = frame(spark, base_rows()).withColumn("analysis_date_utc7", F.to_date("event_ts"))
    write_corrected(df.repartition(8), str(tmp_path / "fixed"), rebalance=True)
    assert read_corrected(spark, str(tmp_path / "fixed")).count() == df.count()
    for day in (tmp_path / "fixed").glob("analysis_date_utc7=*"):
        assert len(list(day.glob("*.parquet"))) == 1


def test_nothing_is_overwritten(spark, tmp_path):
    df = spark.createDataFrame([("0", 1.0)], "ab_group string, level double")
    day = df.withColumn("analysis_date_utc7", F.lit(date(2026, 1, 1)))
    for write in (
        lambda path: write_cutoffs(df, path),
        lambda path: write_report_csv(df, path),
        lambda path: write_corrected(day, path),
    ):
        path = str(tmp_path / f"out{id(write)}")
        write(path)
        with pytest.raises(Exception, match="(?i)already exists"):
            write(path)


def test_report_csv(spark, tmp_path):
    schema = "ab_group string, level double, rate double"
    df = spark.createDataFrame([("1", 2.0, None), ("0", 10.0, 0.5), ("0", 9.0, 1.0)], schema)
    write_report_csv(df.repartition(3), str(tmp_path / "r"), null_value="N/A")
    files = list(Path(tmp_path / "r").glob("part-*.csv"))
    assert len(files) == 1
    rows = list(csv.reader(files[0].open()))
    assert rows == [["ab_group", "level", "rate"], ["0", "9.0", "1.0"], ["0", "10.0", "0.5"],
                    ["1", "2.0", "N/A"]]


def test_report_gates(spark):
    df = spark.range(5)
    assert refuse_over_cap(df, 5) is df
    with pytest.raises(ValueError, match="more than 4 rows"):
        refuse_over_cap(df, 4)
    with pytest.raises(ValueError, match="identities"):
        refuse_identity(df.withColumn("user_pseudo_id", F.lit("u")))
    with pytest.raises(ValueError, match="empty"):
        refuse_empty(df.where("id < 0"))
    with pytest.raises(ValueError, match="missing columns: b, c"):
        require_columns(spark.range(1), ["id", "c", "b"])


def test_config_rules():
    with pytest.raises(ValueError, match="report_start"):
        ReportConfig.all_levels(**{**PERIOD, "report_start": "2026-03-14"})
    with pytest.raises(ValueError, match="observation_end"):
        ReportConfig.all_levels(**{**PERIOD, "observation_end": "2026-03-12"})
    with pytest.raises(ValueError, match="as_of_date"):
        ReportConfig.all_levels(**{**PERIOD, "as_of_date": "2026-03-15"})
    with pytest.raises(ValueError, match="list of strings"):
        ReportConfig.all_levels(**PERIOD, versions="9.9.9")
    with pytest.raises(ValueError, match="ads_denominator"):
        ReportConfig.all_levels(**PERIOD, ads_denominator="users")
    with pytest.raises(ValueError, match="version list"):
        ReportConfig.attempt_range(**PERIOD, versions=(), level_min=1, level_max=2)
    with pytest.raises(ValueError, match="version list"):
        ReportConfig.attempt_range(**PERIOD, level_min=1, level_max=2)
    with pytest.raises(ValueError, match="level_min and level_max"):
        ReportConfig.attempt_range(**PERIOD, versions=("2.4",))
    with pytest.raises(ValueError, match="report_horizons"):
        ReportConfig.all_levels(**PERIOD, day_horizons=(3,), report_horizons=(7,))
    assert ReportConfig.all_levels(**PERIOD, day_horizons=(5,)).report_horizons == (5,)
    assert str(ALL.eligible_end(3)) == "2026-03-12" and str(ALL.eligible_end(7)) == "2026-03-08"
    assert [str(b) for b in ALL.window_utc()] == ["2026-03-08 17:00:00", "2026-03-15 17:00:00"]


def test_profile_rules():
    good = dict(rows=1, invalid_timestamps=0, min_date=ALL.report_start,
                max_date=ALL.observation_end, inconsistent_mode=0)
    assert check_profile(good, ALL, whole_history=True) is good
    for change, message in (
        (dict(rows=0), "empty"),
        (dict(invalid_timestamps=2), "bad timestamps"),
        (dict(max_date=date(2026, 3, 14)), "before observation_end"),
        (dict(min_date=date(2026, 3, 10)), "after the report start"),
        (dict(inconsistent_mode=1), "not re-labelled"),
    ):
        with pytest.raises(ValueError, match=message):
            check_profile({**good, **change}, ALL, whole_history=True)
    assert observation_end(date(2026, 1, 5), None) == date(2026, 1, 5)
    assert observation_end(date(2026, 1, 5), date(2026, 1, 4)) == date(2026, 1, 4)
    with pytest.raises(ValueError, match="after the last date"):
        observation_end(date(2026, 1, 5), date(2026, 1, 6))
    with pytest.raises(ValueError, match="empty"):
        observation_end(None, None)
