"""Stage 1 in increments equals stage 1 on everything."""

from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from levelscope.config import CorrectionConfig
from levelscope.jobs import correct
from levelscope.plans.correct import correct_history
from levelscope.plans.increment import changed_cutoffs, increment, merged_cutoffs
from levelscope.session import CLAIMS, COMPLETE
from levelscope.sources import sinks
from levelscope.sources.readers import read_corrected
from levelscope.sources.records import table_record

SCHEMA = (
    "app_id string, user_pseudo_id string, event_ts timestamp, event_name string, event_params string,"
    " user_properties string, extra long"
)
CFG = CorrectionConfig("app", "2026-03-01", "2026-04-01", experiment_key="exp", milestone_level=9)
CORRECTION = dict(app_id="app", history_start="2026-03-01", history_end="2026-04-01", experiment_key="exp", milestone_level=9)


def event(user, day, hour, name="level_start", level=9, mode="classic", extra=0, **more):
    fields = {"level": level, "mode": mode} | more
    params = "{" + ",".join(f'"{k}":"{v}"' for k, v in fields.items()) + "}"
    when = datetime(2026, 3, day) + timedelta(hours=hour)
    return ("app", user, when, name, params, f'{{"level":"{level}","exp":"1"}}', extra)


def clear(user, day, hour):
    return event(user, day, hour, "level_end", success="true")


def history():
    """Users with no clear, one, several, in any order; rows without a user, and repeated rows."""
    rows = [event(u, d, h, extra=100 * d + h) for u in ("a", "b", "c", "d", None) for d in range(2, 9) for h in (1, 13)]
    rows += [clear("a", 3, 2), clear("b", 6, 2), clear("b", 4, 5), clear("c", 7, 9), event("e", 5, 5, mode="sl")]
    return rows + rows[:4]


def cut(rows, which):
    return [r for i, r in enumerate(rows) if which(i, r)], [r for i, r in enumerate(rows) if not which(i, r)]


SPLITS = {
    "by time": lambda i, r: r[2] < datetime(2026, 3, 5),
    "late events": lambda i, r: i % 3 != 1,
    "clears last": lambda i, r: r[3] != "level_end",
    "clears first": lambda i, r: r[3] == "level_end",
    "only days that are not there yet": lambda i, r: r[2] < datetime(2026, 3, 8),
    "nothing new": lambda i, r: True,
}


def key(row):
    return tuple(map(str, row))


def written(spark, rows, path, cfg=CFG):
    raw = spark.createDataFrame(rows, SCHEMA)
    sinks.write_corrected(correct_history(raw, cfg), f"{path}/raw_fixed")
    from levelscope.operators.correction import history_window, milestone_cutoffs

    sinks.write_cutoffs(milestone_cutoffs(history_window(raw, cfg), cfg), f"{path}/user_clear650_cutoffs")
    return read_corrected(spark, f"{path}/raw_fixed"), spark.read.parquet(f"{path}/user_clear650_cutoffs")


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("broadcast", [32 << 20, -1])
def test_an_increment_equals_one_run(spark, tmp_path, split, broadcast):
    first, second = cut(history(), SPLITS[split])
    fixed, cutoffs = written(spark, first, tmp_path)
    cfg = CorrectionConfig(**CORRECTION, broadcast_bytes=broadcast, busy_share=0.4)
    got = increment(fixed, cutoffs, spark.createDataFrame(second, SCHEMA), cfg)
    whole = correct_history(spark.createDataFrame(history(), SCHEMA), CFG)
    columns = whole.columns
    rest = fixed.where(~F.col("analysis_date_utc7").isin(*got.touched)) if got.touched else fixed
    both = rest.select(*columns).union(got.days.select(*columns))
    assert sorted(map(key, both.collect())) == sorted(map(key, whole.collect()))
    want = {("a", datetime(2026, 3, 3, 2)), ("b", datetime(2026, 3, 4, 5)), ("c", datetime(2026, 3, 7, 9))}
    assert {tuple(r) for r in got.cutoffs.collect()} == want


def test_only_touched_days_are_rewritten(spark, tmp_path):
    rows = [event("a", d, 1) for d in range(2, 9)] + [event("b", 3, 1), event("b", 5, 1)]
    fixed, cutoffs = written(spark, rows, tmp_path)
    got = increment(fixed, cutoffs, spark.createDataFrame([clear("b", 6, 3)], SCHEMA), CFG)
    assert [d.day for d in got.touched] == [3, 5, 6]  # the days of b, whose cutoff is new
    got = increment(fixed, cutoffs, spark.createDataFrame([event("a", 7, 3)], SCHEMA), CFG)
    assert [d.day for d in got.touched] == [7]


def test_cutoffs_merge_in_any_order(spark):
    schema = "user_pseudo_id string, first_clear_650_ts timestamp"
    at = [datetime(2026, 3, d) for d in range(1, 5)]
    one = spark.createDataFrame([("a", at[1]), ("b", at[2])], schema)
    two = spark.createDataFrame([("a", at[0]), ("b", at[3]), ("c", at[1])], schema)
    merged = {tuple(r) for r in merged_cutoffs(one, two).collect()}
    assert merged == {tuple(r) for r in merged_cutoffs(two, one, two).collect()} == {("a", at[0]), ("b", at[2]), ("c", at[1])}
    assert {r[0] for r in changed_cutoffs(one, merged_cutoffs(one, two)).collect()} == {"a", "c"}


def settings_of(tmp_path, name, **more):
    return {
        "source": {"path": str(tmp_path / name)}, "output_path": str(tmp_path / "out"), "correction": CORRECTION, **more
    }


def outputs(spark, tmp_path):
    fixed = read_corrected(spark, str(tmp_path / "out/raw_fixed"))
    columns = [c for c in correct_history(spark.createDataFrame(history(), SCHEMA), CFG).columns]
    return sorted(map(key, fixed.select(*columns).collect()))


@pytest.fixture
def parts(spark, tmp_path):
    first, second = cut(history(), SPLITS["late events"])
    spark.createDataFrame(first, SCHEMA).write.parquet(str(tmp_path / "first"))
    spark.createDataFrame(second, SCHEMA).write.parquet(str(tmp_path / "second"))
    correct.run(spark, settings_of(tmp_path, "first"))
    whole = correct_history(spark.createDataFrame(history(), SCHEMA), CFG)
    return sorted(map(key, whole.collect()))


def test_the_job_brings_outputs_up_to_date(spark, tmp_path, parts):
    settings = settings_of(tmp_path, "second", increment=True)
    correct.run_increment(spark, settings)
    assert outputs(spark, tmp_path) == parts
    assert (tmp_path / "out" / COMPLETE).exists() and not (tmp_path / "out/_increment").exists()
    record = table_record(spark, str(tmp_path / "out/raw_fixed"))
    assert record.all_readable("app") and record.last_event("app") == max(r[2] for r in history())
    with pytest.raises(ValueError, match="has these changes already"):
        correct.run_increment(spark, settings)
    assert outputs(spark, tmp_path) == parts


def test_a_change_that_broke_off_is_finished(spark, tmp_path, parts, monkeypatch):
    """The run dies when some days are replaced: others are refused, the same one ends the work."""
    settings = settings_of(tmp_path, "second", increment=True)

    def half(df, path):
        sinks.write_days(df.where(F.dayofmonth("analysis_date_utc7") < 5), path)
        raise RuntimeError("lost")

    monkeypatch.setattr(correct, "write_days", half)
    with pytest.raises(RuntimeError, match="lost"):
        correct.run_increment(spark, settings)
    monkeypatch.undo()
    assert not (tmp_path / "out" / COMPLETE).exists()
    with pytest.raises(ValueError, match="must be finished"):
        correct.run_increment(spark, settings_of(tmp_path, "first", increment=True))
    correct.run_increment(spark, settings)
    assert outputs(spark, tmp_path) == parts and (tmp_path / "out" / COMPLETE).exists()


def test_a_refused_input_changes_nothing(spark, tmp_path, parts):
    before = outputs(spark, tmp_path)
    bad = spark.createDataFrame([("app", "a", None, "x", "{}", "{}", 1)], SCHEMA)
    bad.write.parquet(str(tmp_path / "bad"))
    with pytest.raises(ValueError, match="event_ts"):
        correct.run_increment(spark, settings_of(tmp_path, "bad", increment=True))
    assert outputs(spark, tmp_path) == before and (tmp_path / "out" / COMPLETE).exists()
    assert not list(Path(tmp_path / "out" / CLAIMS).glob("*.broken"))
    correct.run_increment(spark, settings_of(tmp_path, "second", increment=True))
    assert outputs(spark, tmp_path) == parts


def test_increments_need_finished_outputs(spark, tmp_path):
    spark.createDataFrame(history(), SCHEMA).write.parquet(str(tmp_path / "first"))
    with pytest.raises(ValueError, match="not complete"):
        correct.run_increment(spark, settings_of(tmp_path, "first", increment=True))
    assert not (tmp_path / "out").exists()
