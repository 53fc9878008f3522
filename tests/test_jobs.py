"""Both submit scripts end to end on files."""

import csv
from pathlib import Path

import pytest

from checks.telemetry import MILESTONE, raw_table
from levelscope.jobs import correct, report
from levelscope.session import shared_folder
from tests.golden import PERIOD, as_struct, base_rows, frame

SF_DIR = "/root/testdata/sf0.01"


def table(path):
    files = list(Path(path).glob("part-*.csv"))
    assert len(files) == 1
    return list(csv.DictReader(files[0].open()))


def test_correct_then_report(spark, tmp_path):
    raw_table(spark, SF_DIR).write.parquet(str(tmp_path / "raw"))
    settings = {
        "source": {"format": "parquet", "path": str(tmp_path / "raw")},
        "output_path": str(tmp_path / "out"),
        "correction": dict(app_id="app_main", history_start="2024-01-01", history_end="2024-02-15",
                           experiment_key="exp_group", milestone_level=MILESTONE),
        "rebalance": True,
    }
    fixed = correct.run(spark, settings)
    assert spark.read.parquet(str(tmp_path / "out/user_clear650_cutoffs")).count() == 49
    assert spark.read.parquet(fixed).count() == 9800
    with pytest.raises(Exception, match="(?i)already exists"):
        correct.run(spark, settings)

    # no observation end, no as-of date: taken from the input and from today
    paths = report.run(spark, fixed, str(tmp_path / "reports"), dict(
        preset="attempt_range", app_id="app_main", report_start="2024-01-10",
        report_end="2024-01-20", versions=["1.0", "1.1"], level_min=1, level_max=4,
        experiment_key="exp_group", milestone_level=MILESTONE,
    ))
    levelplay = table(paths["levelplay_report"])
    assert levelplay and [(r["ab_group"], float(r["level"])) for r in levelplay] == sorted(
        (r["ab_group"], float(r["level"])) for r in levelplay
    )
    assert all(r["churn_rate_d7_pct"] for r in levelplay)  # the whole period is observed
    assert table(paths["loss_report"]) and table(paths["loss_all_attempts_report"])
    assert table(paths["qa_missing_clear650"])


def test_report_with_missing_values(spark, tmp_path):
    as_struct(frame(spark, base_rows())).write.parquet(str(tmp_path / "fixed"))
    settings = {"preset": "all_levels", **PERIOD}
    paths = report.run(spark, str(tmp_path / "fixed"), str(tmp_path / "reports"), settings)
    levelplay = table(paths["levelplay_report"])
    assert [r["level"] for r in levelplay] == ["12.0", "13.0", "40.0"]
    assert levelplay[1]["rwd_per_lau"] == "N/A" and levelplay[0]["churn_rate_d7_pct"] == "N/A"
    assert "loss_kind" not in table(paths["loss_report"])[0]
    with pytest.raises(Exception, match="(?i)already exists"):
        report.run(spark, str(tmp_path / "fixed"), str(tmp_path / "reports"), settings)


def test_uncorrected_input_is_refused(spark, tmp_path):
    settings = {"preset": "all_levels", **PERIOD}
    frame(spark, base_rows(mode_past="classic")).write.parquet(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="not re-labelled"):
        report.run(spark, str(tmp_path / "bad"), str(tmp_path / "out"), settings)
    frame(spark, base_rows()).drop("mode_fixed").write.parquet(str(tmp_path / "raw"))
    with pytest.raises(ValueError, match="missing columns: mode_fixed"):
        report.run(spark, str(tmp_path / "raw"), str(tmp_path / "out"), settings)
    assert not (tmp_path / "out").exists()
    with pytest.raises(ValueError, match="before observation_end"):
        frame(spark, [r for r in base_rows() if r[3] != "session_start"]).write.parquet(
            str(tmp_path / "short"))
        report.run(spark, str(tmp_path / "short"), str(tmp_path / "out"), settings)


def test_nothing_is_published_unless_all_is(spark, tmp_path):
    """The loss report of all attempts is over the cap; a later run writes everything."""
    frame(spark, base_rows()).write.parquet(str(tmp_path / "fixed"))
    settings = {"preset": "all_levels", **PERIOD}
    target = tmp_path / "out"
    with pytest.raises(ValueError, match="more than 1 rows"):
        report.run(spark, str(tmp_path / "fixed"), str(target), {**settings, "row_cap": 1})
    assert not target.exists()
    report.run(spark, str(tmp_path / "fixed"), str(target), settings)
    assert (target / "_COMPLETE").exists()


def test_staged_tables_are_deleted(spark, tmp_path):
    frame(spark, base_rows()).write.parquet(str(tmp_path / "fixed"))
    shared = Path(shared_folder(spark).removeprefix("file:")) / "levelscope" / spark.sparkContext.applicationId
    before = set(shared.glob("*")) if shared.exists() else set()
    report.run(spark, str(tmp_path / "fixed"), str(tmp_path / "out"), {"preset": "all_levels", **PERIOD})
    assert set(shared.glob("*")) <= before


def test_history_must_reach_back_if_asked(spark, tmp_path):
    rows = [r for r in base_rows() if r[2].day != 9]
    frame(spark, rows).write.parquet(str(tmp_path / "short"))
    settings = {"preset": "all_levels", "whole_history": True, **PERIOD}
    with pytest.raises(ValueError, match="after the report start"):
        report.run(spark, str(tmp_path / "short"), str(tmp_path / "out"), settings)


def test_unreadable_timestamps_stop_the_report(spark, tmp_path):
    from pyspark.sql import functions as F

    rows = frame(spark, base_rows()).withColumn("event_ts", F.col("event_ts").cast("string"))
    bad = rows.limit(2).withColumn("event_ts", F.lit("soon"))
    rows.union(bad).write.parquet(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="invalid_timestamps=2"):
        report.run(spark, str(tmp_path / "bad"), str(tmp_path / "out"), {"preset": "all_levels", **PERIOD})
