"""Stage 2: from corrected events to the level report and the loss reports."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from levelscope.config import USER, ReportConfig
from levelscope.functions.game import BUCKETS, per, percent
from levelscope.operators.align import fold
from levelscope.operators.economy import level_columns, player_facts
from levelscope.operators.filters import (
    cohort_events,
    metric_events,
    system_clean,
    used_by_reports,
)
from levelscope.operators.funnel import (
    LEVEL_KEYS,
    ads_players,
    drop_count,
    dropped_players,
    level_starters,
)
from levelscope.operators.loss import ALL, FIRST, loss_distribution, loss_with_churn, lost_turns
from levelscope.operators.normalize import CLEAN_COLUMNS, normalize, parse_fields
from levelscope.operators.quality import bad_timestamps, profile_columns
from levelscope.operators.retention import (
    gone_counts,
    gone_players,
    incomplete_churn,
    play_days,
)
from levelscope.session import stage
from levelscope.sources.records import Record
from levelscope.sources.staging import only_report_events, report_window


def clean_events(events: DataFrame, cfg: ReportConfig, lean: bool = False) -> DataFrame:
    """Window events to narrow, typed, system-filtered rows."""
    typed = normalize(parse_fields(events, cfg, lean), cfg)
    return system_clean(typed, cfg).select(*CLEAN_COLUMNS)


@dataclass(frozen=True)
class ReportInput:
    """The shared relations behind all reports."""

    clean: DataFrame
    cfg: ReportConfig
    profile: dict | None = None

    @cached_property
    def cohort(self) -> DataFrame:
        return cohort_events(self.clean, self.cfg)

    @cached_property
    def metric(self) -> DataFrame:
        return metric_events(self.cohort, self.cfg)

    @cached_property
    def days(self) -> DataFrame:
        return play_days(self.clean, self.cfg)


def prepare(
    corrected: DataFrame,
    cfg: ReportConfig,
    every_event: bool = False,
    record: Record | None = None,
) -> ReportInput:
    """Read the window once: decode, filter and stage it, and profile it in the same pass.

    Every report then reads the few columns it needs from the staged table. Unreadable timestamps, which
    the window cannot show, are known from the ``record`` of the table (``sources.records``); without one they are
    counted over all of the app's rows, where row groups without nulls are passed over if timestamps are
    no text. ``every_event`` keeps event kinds that only the missing-cutoff audit looks at.
    """
    window = report_window(corrected, cfg)
    observed = Observation("input_profile")
    window = window.observe(observed, *profile_columns(window, cfg))
    events = window if every_event else only_report_events(window)
    clean = clean_events(events, cfg, lean=True).where(used_by_reports(cfg)).drop("resources")
    clean = stage(clean, "clean")
    sure = record is not None and record.all_readable(cfg.app_id)
    bad = 0 if sure else bad_timestamps(corrected, cfg.app_id).count()
    return ReportInput(clean, cfg, dict(observed.get) | {"invalid_timestamps": bad})


def open_input(corrected: DataFrame, cfg: ReportConfig) -> ReportInput:
    """The same relations without staging, for a single operator over one scan."""
    events = only_report_events(report_window(corrected, cfg))
    return ReportInput(clean_events(events, cfg), cfg)


# Columns of the level report in order; the rates by horizon follow churn_rate_pct.
LEVELPLAY_COLUMNS = (
    "ab_group", "level", "user_start_count", "churn_rate_pct", "aps_avg", "completion_rate_first_attempt_pct", "coin_spend_per_user",
    "total_coin_spend_per_user", "coin_balance_per_user", "total_coin_balance_per_user",
    "avg_booster_per_user", "booster_usage_rate_pct", "pay_rate_pct", "imp_per_lau",
    "inter_imp_per_lau", "rwd_per_lau",
)


def levelplay_report(data: ReportInput) -> DataFrame:
    """One row per variant and level that has starters."""
    cfg = data.cfg
    return levelplay_of(
        player_facts(data.metric), level_starters(data.cohort, cfg), ads_players(data.clean, cfg), data.days, cfg
    )


def levelplay_of(
    facts: DataFrame, starters: DataFrame, viewers: DataFrame, days: DataFrame, cfg: ReportConfig
) -> DataFrame:
    """The level report from the relations that it rests on: ``player_facts``, ``level_starters``, ``ads_players`` and
    ``play_days``."""
    ads_users = F.count(F.when(F.col("ads_start"), F.col(USER))).alias("ads_users")
    merged = fold(
        LEVEL_KEYS,
        (facts, level_columns(cfg)),
        (dropped_players(starters), [drop_count()]),
        (viewers.withColumn("ads_start", F.lit(True)), [ads_users]),
        (gone_players(days, cfg), gone_counts(cfg)),
    ).where(F.col("has_start"))

    starters = F.col("user_start_count")
    viewers = F.col("ads_users") if cfg.ads_denominator == "property" else starters

    def known(name):
        return F.coalesce(F.col(name), F.lit(0))

    def or_zero(ratio):
        return F.coalesce(ratio, F.lit(0.0))

    def per_viewer(name):
        return per(F.col(name), viewers)

    cells = {
        "ab_group": F.col("variant"),
        "level": F.col("level"),
        "user_start_count": starters,
        "churn_rate_pct": percent(F.col("dropped_users"), starters),
        "aps_avg": or_zero(F.col("aps_avg")),
        "completion_rate_first_attempt_pct": or_zero(F.col("avg_completion")),
        "coin_spend_per_user": per(known("coin_spend"), starters),
        "total_coin_spend_per_user": per(known("total_coin_spend"), starters),
        "coin_balance_per_user": or_zero(per(F.col("selected_balance"), F.col("balance_users"))),
        "total_coin_balance_per_user": or_zero(per(F.col("total_balance"), F.col("balance_users"))),
        "avg_booster_per_user": per(known("booster_count"), starters),
        "booster_usage_rate_pct": percent(known("booster_users"), starters),
        "pay_rate_pct": percent(known("payers"), starters),
        "imp_per_lau": or_zero(per_viewer("impressions")),
        "inter_imp_per_lau": per_viewer("inter_impressions"),
        "rwd_per_lau": per_viewer("reward_impressions")
        if cfg.null_missing_ads
        else or_zero(per_viewer("reward_impressions")),
    }
    shown = [
        name for name in LEVELPLAY_COLUMNS if name != "inter_imp_per_lau" or cfg.interstitial_column
    ]
    rates = [
        percent(F.col(f"churned_{n}"), F.col(f"mature_{n}")).alias(f"churn_rate_d{n}_pct")
        for n in cfg.report_horizons
    ]
    columns = [cells[name].alias(name) for name in shown]
    after = shown.index("churn_rate_pct") + 1
    return merged.select(*columns[:after], *rates, *columns[after:])


def loss_report(data: ReportInput, kind: str | None = None) -> DataFrame:
    """One row per variant and level with losers, for one kind or for both (column loss_kind)."""
    cfg, metric = data.cfg, data.metric
    asked = (FIRST, ALL) if kind is None else (kind,)
    distribution = loss_distribution(lost_turns(data.cohort, metric, cfg), asked)
    churn = incomplete_churn(data.clean, metric, data.days, cfg)
    return _of_kind(loss_with_churn(distribution, churn, cfg), kind)


def _of_kind(report: DataFrame, kind: str | None) -> DataFrame:
    return report if kind is None else report.drop("loss_kind")


LOSS_COLUMNS = (
    "ab_group", "level", "user_count", "lose_count", "churn_users_d3", "churn_rate_d3_pct",
) + BUCKETS
