"""Row filters between the normalised events and the metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levelscope.config import PURCHASE_EVENTS, SESSION_EVENTS, ReportConfig
from levelscope.functions.game import first_phase


def allowed_market(cfg: ReportConfig) -> Column:
    """Not (country and platform excluded), or no country.

    SQL's three-valued logic is intended: the excluded country without a platform is dropped.
    """
    excluded = (F.col("country") == cfg.excluded_country) & (
        F.col("platform") == cfg.excluded_platform
    )
    return ~excluded | F.col("country").isNull()


def sane_balance(cfg: ReportConfig) -> Column:
    opening = F.when(F.col("event_name") == "level_start_turn", F.col("start_coin"))
    return F.coalesce(opening, F.lit(0.0)) <= cfg.balance_limit


def sane_purchase(cfg: ReportConfig) -> Column:
    """Purchases in a currency without a rate count as zero and stay."""

    def add(chain, pair):
        currency, rate = pair
        amount = F.coalesce("currency_value", F.lit(0.0))
        return chain.when(F.col("purchase_currency") == currency, amount * F.lit(float(rate)))

    start = F.when(~F.col("event_name").eqNullSafe("in_app_purchase"), F.lit(0.0))
    return reduce(add, cfg.purchase_rates, start).otherwise(F.lit(0.0)) < cfg.purchase_limit


def earned_amount_known() -> Column:
    """Currency earnings need a non-negative amount; other events pass."""
    earned = F.col("event_name") == "earn_virtual_currency"
    return F.when(earned, F.col("game_currency_value")).otherwise(F.lit(1)) >= 0


def system_clean(normalized: DataFrame, cfg: ReportConfig) -> DataFrame:
    return normalized.where(
        allowed_market(cfg) & sane_balance(cfg) & sane_purchase(cfg) & earned_amount_known()
    )


def in_versions(cfg: ReportConfig) -> Column:
    """No version list means every version."""
    return F.col("app_version").isin(*cfg.versions) if cfg.versions else F.lit(True)


def in_report(cfg: ReportConfig) -> Column:
    return F.col("local_date").between(cfg.report_start, cfg.report_end) & in_versions(cfg)


def in_cohort(cfg: ReportConfig) -> Column:
    return in_report(cfg) & F.col("variant").isin(*cfg.variants)


def is_cohort(cfg: ReportConfig) -> Column:
    """Report dates, versions, variants and the report's mode; a missing mode does not count."""
    return in_cohort(cfg) & (F.col("metric_mode") == cfg.mode)


def cohort_events(clean: DataFrame, cfg: ReportConfig) -> DataFrame:
    return clean.where(is_cohort(cfg))


def level_in_range(cfg: ReportConfig, level: str = "level", beyond: int = 0) -> Column:
    if cfg.level_min is None:
        return F.col(level).isNotNull()
    return F.col(level).between(float(cfg.level_min), float(cfg.level_max + beyond))


def is_metric(cfg: ReportConfig) -> Column:
    """At a level of the report and in its first phase. Ads have no phase."""
    name = F.col("event_name")
    by_user_phase = [e for e in cfg.property_events if e in PURCHASE_EVENTS + ("app_remove",)]
    phase = (
        F.when(name == "paid_ad_impression", F.lit(True))
        .when(name.isin(*by_user_phase), first_phase(F.col("property_phase")))
        .otherwise(first_phase(F.col("event_phase")))
    )
    return level_in_range(cfg) & phase


def metric_events(cohort: DataFrame, cfg: ReportConfig) -> DataFrame:
    return cohort.where(is_metric(cfg))


def is_session(cfg: ReportConfig) -> Column:
    """Activity that counts as coming back: any mode, level or variant."""
    return (
        F.col("event_name").isin(*SESSION_EVENTS)
        & F.col("local_date").between(cfg.report_start, cfg.observation_end)
        & in_versions(cfg)
        & first_phase(F.col("property_phase"))
    )


def is_play(cfg: ReportConfig) -> Column:
    """A level start among the metric events."""
    return (F.col("event_name") == "level_start") & is_cohort(cfg) & is_metric(cfg)


def used_by_reports(cfg: ReportConfig) -> Column:
    """Rows some report looks at; stated on few columns, so that it applies before most decoding.

    Every report keeps to the versions. Sessions count from anybody and up to the end of
    observation, level ends from any variant; the rest is only ever read for the report's variants.
    """
    of_variant = F.col("variant").isin(*cfg.variants) | (F.col("event_name") == "level_end")
    return in_versions(cfg) & (
        F.col("event_name").isin(*SESSION_EVENTS)
        | (F.col("local_date").between(cfg.report_start, cfg.report_end) & of_variant)
    )
