"""What the physical plans must and must not contain."""

import re

import pytest
from pyspark.sql import functions as F

from checks import registry
from checks.telemetry import ALL_LEVELS, CORRECTION, RANGE, corrected_table, raw_table
from levelscope.operators import loss
from levelscope.operators.correction import history_window, milestone_cutoffs
from levelscope.plans.correct import correct_history
from levelscope.operators.filters import used_by_reports
from levelscope.operators.quality import timestamp_audit
from levelscope.plans.reports import (
    clean_events, levelplay_report, loss_report, open_input, prepare,
)
from levelscope.sources.staging import only_report_events, report_window

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def corrected(spark):
    return corrected_table(spark, SF_DIR)


def test_window_is_pushed_down(corrected):
    text = plan(report_window(corrected, RANGE))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "GreaterThanOrEqual(event_ts" in pushed and "LessThan(event_ts" in pushed
    assert "EqualTo(app_id" in pushed
    assert re.search(r"PartitionFilters: \[[^\]]*analysis_date_utc7", text)


def test_only_needed_columns_are_read(corrected):
    data = open_input(corrected.withColumn("unused", F.lit(1)), RANGE)
    text = plan(data.days)
    schema = re.search(r"ReadSchema: struct<(.*?)>", text).group(1)
    assert "unused" not in schema and "fix_reason" not in schema


def test_cutoffs_read_milestone_events_only(spark):
    text = plan(milestone_cutoffs(history_window(raw_table(spark, SF_DIR), CORRECTION), CORRECTION))
    assert "EqualTo(event_name,level_end)" in text and "IsNotNull(user_pseudo_id)" in text


def test_small_cutoffs_leave_events_unshuffled(spark):
    text = plan(correct_history(raw_table(spark, SF_DIR), CORRECTION))
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text and "SortMergeJoin" not in text


def test_one_decode_per_payload(corrected):
    """Filters on decoded fields do not bring further parses of the same text."""
    text = plan(open_input(corrected, RANGE).metric)
    assert len(re.findall(r"Generate json_tuple\(event_params", text)) == 1
    assert len(re.findall(r"Generate json_tuple\(user_properties", text)) == 1
    assert "get_json_object" not in text


def test_rows_outside_the_experiment_skip_the_event_payload(corrected):
    """The variant is known from the user's payload and filtered before the event's is decoded."""
    events = only_report_events(report_window(corrected, RANGE))
    text = plan(clean_events(events, RANGE, lean=True).where(used_by_reports(RANGE)))
    top_down = re.findall(r"Generate json_tuple\((?:if|user)|Filter \(.*", text)
    assert top_down[0].startswith("Filter") and "e_coin" in top_down[0]
    assert top_down[1].startswith("Generate json_tuple(if")
    assert "variant" in top_down[2]
    assert top_down[3].startswith("Generate json_tuple(user")


def test_bad_timestamps_are_found_from_statistics(spark):
    """On timestamps the audit is a pushed IsNull over two columns."""
    raw = raw_table(spark, SF_DIR)
    text = plan(raw.where((raw.app_id == "app_main") & raw.event_ts.isNull()))
    assert "IsNull(event_ts)" in text and "event_params:" not in plan(
        timestamp_audit(raw, "app_main")
    )


@pytest.mark.parametrize("cfg", [RANGE, ALL_LEVELS], ids=["range", "all_levels"])
def test_reports_read_the_staged_table_only(spark, corrected, cfg):
    data = prepare(corrected, cfg)
    for report in (levelplay_report(data), loss_report(data)):
        text = plan(report)
        assert "raw_fixed" not in text and "json_tuple" not in text
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
        assert "Expand" not in text
        assert "Python" not in text


@pytest.mark.parametrize("cfg", [RANGE, ALL_LEVELS], ids=["range", "all_levels"])
def test_level_report_scans(spark, corrected, cfg):
    """Player facts, play days, starters (with their drop) and ads base: one scan each."""
    report = levelplay_report(prepare(corrected, cfg))
    report.collect()
    final = plan(report).split("== Initial Plan ==")[0]
    assert len(re.findall(r"FileScan parquet", final)) == 4


def test_profile_comes_with_the_staging_pass(corrected):
    data = prepare(corrected, RANGE)
    assert data.profile["rows"] > 0 and data.profile["inconsistent_mode"] == 0
    assert str(data.profile["max_date"]) == "2024-01-21"


def test_loss_distribution_counts_without_expand(corrected):
    data = open_input(corrected, ALL_LEVELS)
    text = plan(loss.loss_distribution(loss.lost_turns(data.cohort, data.metric, data.cfg)))
    assert "Expand" not in text
    assert len(re.findall(r"Exchange hashpartitioning", text)) == 2


@pytest.mark.parametrize("name", list(registry.queries()))
def test_no_nested_loops_and_no_python(spark, name):
    text = plan(registry.queries()[name](spark, SF_DIR))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


@pytest.mark.parametrize("name", list(registry.queries()))
def test_payloads_are_decoded_once(spark, name):
    """One json_tuple per payload in the plan of a query; over the staged window there is none."""
    text = plan(registry.queries()[name](spark, SF_DIR))
    decoded = re.findall(r"Generate json_tuple\(", text)
    both_sides = 2 if name.startswith(("mode_correction", "fix_reason")) else 1
    assert len(decoded) <= 2 * both_sides


def test_shuffled_cutoffs_move_no_row_without_a_user(spark):
    far = registry.queries()["mode_correction_shuffled"](spark, SF_DIR)
    text = plan(far)
    assert "SortMergeJoin" in text and "isnotnull(user_pseudo_id" in text
    assert "Union" in text and "isnull(user_pseudo_id" in text
