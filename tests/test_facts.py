"""Reports from day by day facts equal those from the events."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from levelscope.plans import facts
from levelscope.plans.reports import levelplay_report, loss_report, prepare
from levelscope.session import scratch
from tests.golden import ALL, CRAB, EEL, RANGE, base_rows, collected, frame, unreadable_rows

FIRST, LAST = date(2026, 3, 1), date(2026, 3, 25)


def events(spark):
    more = [EEL("level_start", 10, state=11), CRAB("level_end_turn", 12, success=False, start_count=1, completion=61)]
    return frame(spark, base_rows() + more * 3 + unreadable_rows()[::40])


def written(spark, path, cfg, cuts):
    """Facts of the days between the cuts, written one stretch after the other."""
    for first, last in zip(cuts, [c - timedelta(days=1) for c in cuts[1:]]):
        days = cfg.with_(report_start=first, report_end=last, observation_end=last, strict_dates=False)
        clean = prepare(events(spark), days).clean
        facts.write_facts(facts.daily_facts(clean, cfg, first, last), path, cfg)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("facts"))
    for cfg in (ALL, RANGE):
        written(spark, path, cfg, [FIRST, date(2026, 3, 10), date(2026, 3, 11), LAST + timedelta(days=1)])
    return path


def shown(report):
    def plain(value):
        return round(value, 9) if isinstance(value, float) else value

    rows = collected(report, ("loss_kind", "ab_group", "level"))
    return [{k: plain(v) for k, v in row.items()} for row in rows]


WINDOWS = {
    "the period": {},
    "fewer days": dict(report_start="2026-03-10", report_end="2026-03-11", observation_end="2026-03-14"),
    "one day": dict(report_start="2026-03-09", report_end="2026-03-09"),
    "other horizons": dict(day_horizons=(1, 2), report_horizons=(2, 1)),
    "no such days": dict(report_start="2026-03-20", report_end="2026-03-21", observation_end="2026-03-22", as_of_date="2026-03-24"),
}


@pytest.mark.parametrize("window", WINDOWS)
@pytest.mark.parametrize("preset", [ALL, RANGE])
def test_reports_of_any_window(spark, stored, preset, window):
    cfg = preset.with_(**WINDOWS[window])
    data, found = prepare(events(spark), cfg), facts.read_facts(spark, stored, cfg)
    assert shown(facts.levelplay_from(found)) == shown(levelplay_report(data))
    assert shown(facts.loss_from(found)) == shown(loss_report(data))


def test_other_ways_to_show_the_same_facts(spark, stored):
    cfg = ALL.with_(ads_denominator="event", null_missing_ads=False, loss_churn="last_start", null_missing_loss_churn=False)
    assert facts.facts_key(cfg) == facts.facts_key(ALL) != facts.facts_key(RANGE)
    data, found = prepare(events(spark), cfg), facts.read_facts(spark, stored, cfg)
    assert shown(facts.levelplay_from(found)) == shown(levelplay_report(data))
    assert shown(facts.loss_from(found, "first")) == shown(loss_report(data, "first"))


def test_a_day_is_replaced_by_its_new_facts(spark, tmp_path):
    written(spark, str(tmp_path), ALL, [FIRST, LAST + timedelta(days=1)])
    before = facts.read_facts(spark, str(tmp_path), ALL).rows.count()
    written(spark, str(tmp_path), ALL, [date(2026, 3, 9), date(2026, 3, 12)])
    found = facts.read_facts(spark, str(tmp_path), ALL)
    assert found.rows.count() == before
    assert shown(facts.levelplay_from(found)) == shown(levelplay_report(prepare(events(spark), ALL)))


def test_a_busy_player_has_few_facts(spark, tmp_path):
    """Thousands of events on a day are as many rows as some."""
    rows = base_rows()
    some = prepare(frame(spark, rows), ALL).clean
    many = prepare(frame(spark, rows * 300), ALL).clean
    counts = [facts.daily_facts(clean, ALL, ALL.report_start, ALL.observation_end).count() for clean in (some, many)]
    assert counts[0] == counts[1]


def exchanges_by_user(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "Exchange" in line and "user_pseudo_id" in line]


def test_reports_by_user_do_not_shuffle_users(spark, stored):
    for cfg in (ALL, RANGE):
        with scratch(spark):
            found = facts.by_user(facts.read_facts(spark, stored, cfg), 4)
            level, loss = facts.levelplay_from(found), facts.loss_from(found)
            data = prepare(events(spark), cfg)
            assert exchanges_by_user(levelplay_report(data)) and exchanges_by_user(loss_report(data))
            assert not exchanges_by_user(level)
            assert not exchanges_by_user(loss)
            assert shown(level) == shown(levelplay_report(data)) and shown(loss) == shown(loss_report(data))
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("levelscope_")]


def test_facts_keep_no_event_columns(spark, stored):
    rows = facts.read_facts(spark, stored, ALL).rows
    kinds = {r.kind: r["count"] for r in rows.groupBy("kind").count().collect()}
    assert set(kinds) == {"player", "loss", "start", "ads", "day", "end"}
    assert not {"event_params", "user_properties", "event_ts", "event_name"} & set(rows.columns)
    assert rows.where(F.col("local_date").isNull()).count() == 0
