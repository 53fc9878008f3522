"""Report values worked out by hand on the golden period, for both presets."""

from datetime import datetime, time, timedelta
from itertools import product

import pytest

from levelscope.config import REPORT_EVENTS, SESSION_EVENTS, CorrectionConfig
from levelscope.operators.correction import history_window
from levelscope.operators.funnel import level_starters
from levelscope.plans.reports import (
    LOSS_COLUMNS, ReportInput, clean_events, levelplay_report, loss_report, prepare,
)
from levelscope.sources.staging import report_window
from tests.golden import (
    ALL, CRAB, EEL, GULL, OTTER, RANGE, UNREADABLE, Player, around, as_map, as_struct, base_rows,
    collected, frame, local_day, local_midnights, unreadable_rows,
)


def reports(corrected, cfg):
    data = prepare(corrected, cfg)
    return {
        "levelplay": collected(levelplay_report(data)),
        "first": collected(loss_report(data, "first")),
        "all": collected(loss_report(data, "all")),
    }


@pytest.fixture(scope="module")
def all_levels(spark):
    return reports(frame(spark, base_rows()), ALL)


@pytest.fixture(scope="module")
def ranged(spark):
    return reports(frame(spark, base_rows()), RANGE)


def test_rows_of_all_levels(all_levels):
    rows = all_levels["levelplay"]
    assert [(r["ab_group"], r["level"]) for r in rows] == [("1", 12.0), ("1", 13.0), ("2", 40.0)]
    assert list(rows[0]) == [
        "ab_group", "level", "user_start_count", "churn_rate_pct", "churn_rate_d3_pct",
        "churn_rate_d7_pct", "aps_avg", "completion_rate_first_attempt_pct", "coin_spend_per_user",
        "total_coin_spend_per_user", "coin_balance_per_user", "total_coin_balance_per_user",
        "avg_booster_per_user", "booster_usage_rate_pct", "pay_rate_pct", "imp_per_lau",
        "inter_imp_per_lau", "rwd_per_lau",
    ]


def test_funnel(all_levels):
    twelve, thirteen, forty = all_levels["levelplay"]
    assert [r["user_start_count"] for r in (twelve, thirteen, forty)] == [4, 2, 1]
    assert twelve["churn_rate_pct"] == 50.0  # eel and seal never start 13
    assert thirteen["churn_rate_pct"] == forty["churn_rate_pct"] == 100.0
    # 12: crab, eel and gull start on days with three more; only the eel's day ends there for good
    assert twelve["churn_rate_d3_pct"] == pytest.approx(100 / 3)
    assert thirteen["churn_rate_d3_pct"] == 50.0  # the crab is away for four days, the gull for none
    assert forty["churn_rate_d3_pct"] == 0.0  # back on the third day
    assert all(r["churn_rate_d7_pct"] is None for r in (twelve, thirteen, forty))


def test_attempts_and_economy(all_levels):
    twelve, thirteen, _ = all_levels["levelplay"]
    assert twelve["aps_avg"] == 3.0  # crab 3, gull 1 and 5; the second win at attempt 1 is the same
    assert twelve["completion_rate_first_attempt_pct"] == 80.0  # 90, 80, 70; not after continues
    assert twelve["coin_spend_per_user"] == 10.0  # 30 + 10 over four
    assert twelve["total_coin_spend_per_user"] == 20.0  # with 25 gems and a booster for 15
    # first attempts: 90 of the gull, 60 and 30 of the seal; the eel, at its third, only counts as a player
    assert twelve["coin_balance_per_user"] == 60.0
    assert twelve["total_coin_balance_per_user"] == 65.0  # 11 tickets and 4 bombs more; a count is no balance
    assert twelve["avg_booster_per_user"] == 1.5
    assert twelve["booster_usage_rate_pct"] == 25.0 and twelve["pay_rate_pct"] == 25.0
    assert thirteen["aps_avg"] == thirteen["coin_spend_per_user"] == thirteen["pay_rate_pct"] == 0.0


def test_ads_per_viewer(spark, all_levels):
    twelve, thirteen, _ = all_levels["levelplay"]
    # by the state of the user, the eel starts at level 11: crab, gull and seal remain
    assert twelve["imp_per_lau"] == 1.0
    assert twelve["inter_imp_per_lau"] == pytest.approx(2 / 3)
    assert twelve["rwd_per_lau"] == pytest.approx(1 / 3)
    assert thirteen["imp_per_lau"] == 0.0
    assert thirteen["inter_imp_per_lau"] is None and thirteen["rwd_per_lau"] is None
    by_starters = collected(
        levelplay_report(prepare(frame(spark, base_rows()), ALL.with_(ads_denominator="event")))
    )
    assert by_starters[0]["imp_per_lau"] == 0.75


def test_losses(all_levels):
    first, every = all_levels["first"], all_levels["all"]
    assert list(first[0]) == list(LOSS_COLUMNS)
    assert [(r["level"], r["user_count"], r["lose_count"]) for r in first] == [(12.0, 2, 3), (20.3, 1, 1)]
    assert [(r["level"], r["user_count"], r["lose_count"]) for r in every] == [(12.0, 2, 4), (20.3, 1, 1)]
    shares = {k: v for k, v in first[0].items() if "-" in k and v}
    assert shares == {"0-10": 50.0, "30-40": 50.0}
    assert {k: v for k, v in every[0].items() if "-" in k and v} == shares | {"80-90": 50.0}
    # the eel left level 12 unfinished and was not seen again, of three mature starters
    for row in (first[0], every[0]):
        assert row["churn_users_d3"] == 1 and row["churn_rate_d3_pct"] == pytest.approx(100 / 3)
    assert first[1]["churn_users_d3"] is None and first[1]["churn_rate_d3_pct"] is None


def test_level_range(ranged):
    rows = ranged["levelplay"]
    assert [(r["ab_group"], r["level"]) for r in rows] == [("1", 12.0), ("1", 13.0)]
    assert "inter_imp_per_lau" not in rows[0]
    assert rows[0]["imp_per_lau"] == 1.0 and rows[1]["rwd_per_lau"] == 0.0
    assert [r["level"] for r in ranged["first"]] == [12.0]  # later phases are no metric events
    # last starts: the eel's at 12, and the crab's at 13, whose next session is past the report
    assert ranged["first"][0]["churn_users_d3"] == 1
    assert ranged["first"][0]["churn_rate_d3_pct"] == pytest.approx(100 / 3)


def test_a_level_that_was_ended_is_not_left(spark):
    ended = [EEL("level_end", 10, success=False, start_count=2, completion=20, continue_times=1)]
    for cfg in (ALL, RANGE):
        losses = reports(frame(spark, base_rows() + ended), cfg)["first"]
        assert losses[0]["churn_users_d3"] == 0


@pytest.mark.parametrize("form", [as_struct, as_map])
def test_payload_forms_agree(spark, all_levels, form):
    assert reports(form(frame(spark, base_rows())), ALL) == all_levels


@pytest.mark.parametrize("kind", ["string", "timestamp_ntz"])
def test_timestamp_forms_agree(spark, all_levels, kind):
    corrected = frame(spark, base_rows())
    for name in ("event_ts", "first_clear_650_ts"):
        corrected = corrected.withColumn(name, corrected[name].cast(kind))
    assert reports(corrected, ALL) == all_levels


def test_unreadable_payloads_change_nothing(spark, all_levels):
    assert reports(frame(spark, base_rows() + unreadable_rows()), ALL) == all_levels


def test_sessions_count_without_payloads(spark, all_levels):
    """Coming back needs no payload, whatever stands in its place."""
    pairs = iter(list(product(UNREADABLE, UNREADABLE))[::7] * 9)
    rows = [r[:4] + next(pairs) + r[6:] if r[3] in SESSION_EVENTS else r for r in base_rows()]
    assert reports(frame(spark, rows), ALL) == all_levels


def test_busy_player_changes_nothing(spark, all_levels):
    """Thousands of further sessions and starts on days a player was active anyway."""
    busy = [CRAB("session_start", 10), EEL("level_start", 9, state=11)]
    assert reports(frame(spark, base_rows() + busy * 2000), ALL) == all_levels


def test_rows_outside_the_window_change_nothing(spark, all_levels):
    """Every kind of event right before the report and right after observation, by known players."""
    first, last = local_midnights(ALL)[0], local_midnights(ALL)[-1]
    outside = (first - timedelta(microseconds=1), last, last + timedelta(days=3))
    rows = [player(kind, moment) for player in (CRAB, EEL, GULL) for kind in REPORT_EVENTS for moment in outside]
    assert reports(frame(spark, base_rows() + rows), ALL) == all_levels


@pytest.mark.parametrize("offset", [7, 0, -11, 13])
def test_the_window_ends_at_local_midnights(spark, offset):
    """Every kind of event on both sides of every midnight that bounds a report, in any zone."""
    cfg = ALL.with_(utc_offset_hours=offset)
    moments = around(local_midnights(cfg))
    rows = [Player(f"{kind} {i}")(kind, moment) for kind in REPORT_EVENTS for i, moment in enumerate(moments)]
    inside = {r[1] for r in rows if cfg.report_start <= local_day(r[2], cfg) <= cfg.observation_end}
    assert 0 < len(inside) < len(rows)
    window = report_window(frame(spark, rows), cfg)
    assert sorted(r.user_pseudo_id for r in window.collect()) == sorted(inside)
    # starters are those of report days, however far observation goes
    data = ReportInput(clean_events(window, cfg), cfg)
    started = {r.user_pseudo_id for r in level_starters(data.cohort, cfg).collect()}
    assert started == {
        r[1] for r in rows if r[3] == "level_start" and cfg.report_start <= local_day(r[2], cfg) <= cfg.report_end
    }


@pytest.mark.parametrize("offset", [7, -11])
def test_sessions_count_to_the_end_of_observation(spark, offset):
    """Of players who start on the first report day, those return whose session lies on a later day
    that is observed."""
    cfg = ALL.with_(utc_offset_hours=offset)
    noon = local_midnights(cfg)[0] + timedelta(hours=12)
    moments = around(local_midnights(cfg))
    rows = []
    for i, (kind, moment) in enumerate(product(SESSION_EVENTS, moments)):
        player = Player(f"p{i}")
        rows += [player("level_start", noon), player(kind, moment)]
    data = ReportInput(clean_events(report_window(frame(spark, rows), cfg), cfg), cfg)
    back = {r.user_pseudo_id: r.next_session for r in data.days.where("next_session is not null").collect()}
    days = {r[1]: local_day(r[2], cfg) for r in rows if r[3] in SESSION_EVENTS}
    assert back == {p: d for p, d in days.items() if cfg.report_start < d <= cfg.observation_end}


def test_the_history_ends_at_local_midnights(spark):
    for offset in (7, 0, -11, 13):
        cfg = CorrectionConfig("harbour", "2026-03-01", "2026-03-20", utc_offset_hours=offset)
        first, last = cfg.utc_bounds()
        rows = [Player(f"{i}")(kind, m) for kind in REPORT_EVENTS for i, m in enumerate(around([first, last]))]
        got = history_window(frame(spark, rows), cfg)
        assert {r.user_pseudo_id for r in got.collect()} == {"0", "3"}  # at the start, and just before the end


def test_a_mature_week(spark):
    """Observed for a week after the report, all its days have seven more; nobody else comes back."""
    end = ALL.report_end + timedelta(days=7)
    cfg = ALL.with_(observation_end=end, as_of_date=end + timedelta(days=1))
    late = [OTTER("session_start", datetime.combine(end, time(12)))]
    rows = {r["level"]: r for r in reports(frame(spark, base_rows() + late), cfg)["levelplay"]}
    assert rows[12.0]["churn_rate_d7_pct"] == 50.0  # eel and seal of four
    assert rows[13.0]["churn_rate_d7_pct"] == rows[40.0]["churn_rate_d7_pct"] == 0.0


def test_other_horizons(spark):
    cfg = ALL.with_(day_horizons=(1,), report_horizons=(1,))
    rows = reports(frame(spark, base_rows()), cfg)["levelplay"]
    assert "churn_rate_d3_pct" not in rows[0]
    # all four are mature now (13 + 1 <= 15): eel and seal
    assert rows[0]["churn_rate_d1_pct"] == 50.0


def test_level_with_only_unknown_users_has_no_ratio(spark):
    only = [(r[0], None, *r[2:]) if r[1] == "otter" else r for r in base_rows()]
    lone = [r for r in collected(levelplay_report(prepare(frame(spark, only), ALL))) if r["level"] == 40.0]
    assert len(lone) == 1 and lone[0]["user_start_count"] == 0
    assert lone[0]["churn_rate_pct"] is None and lone[0]["coin_spend_per_user"] is None
