"""Spend, balances, boosters, ads, purchases and attempts per level."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levelscope.config import USER, ReportConfig
from levelscope.functions.game import INTERSTITIAL, REWARDED, SHOWN_ADS
from levelscope.operators.funnel import LEVEL_KEYS, PLAYER_KEYS, users_per_level
from levelscope.operators.retention import mature_users


SPENT = "event_name = 'spend_virtual_currency'"
SHOWN = "event_name = 'paid_ad_impression'"
ENDED_STRAIGHT = "event_name = 'level_end' AND coalesce(continues, 0) = 0"
WON = "event_name = 'level_end' AND success = 'true' AND attempt > 0"
BOOSTER = "currency_type = 'booster' AND currency_name != ''"

PLAYER_FACTS = (
    "min(if(event_name = 'level_start', local_date, NULL)) AS first_start",
    "max(if(event_name = 'level_start_turn', 1, NULL)) AS turn_started",
    "max(if(event_name = 'in_app_purchase', 1, NULL)) AS paid",
    "max(if(event_name = 'level_end', 1, NULL)) AS ended",
    "max(if(event_name = 'level_end_turn' AND used_boosters > 0, 1, NULL)) AS used_booster",
    f"sum(if({SPENT} AND currency_name = 'coin', game_currency_value, 0)) AS coin_spend",
    f"sum(if({SPENT}, game_currency_value, 0)) AS total_coin_spend",
    f"sum(if({SPENT} AND {BOOSTER}, currency_value, 0)) AS booster_count",
    f"count_if({SHOWN} AND ad_format RLIKE '{SHOWN_ADS}') AS impressions",
    f"count_if({SHOWN} AND ad_format RLIKE '{INTERSTITIAL}') AS inter_impressions",
    f"count_if({SHOWN} AND ad_format NOT RLIKE '{INTERSTITIAL}' AND ad_format RLIKE '{REWARDED}')"
    " AS reward_impressions",
    f"sum(if({ENDED_STRAIGHT}, completion, NULL)) AS completion_sum",
    f"count(if({ENDED_STRAIGHT}, completion, NULL)) AS completions",
    "sum(selected_balance) AS selected_balance",
    "sum(total_balance) AS total_balance",
)


def player_facts(metric: DataFrame, *more: str) -> DataFrame:
    """Metric events folded to one row per variant, level, user and winning attempt (and ``more``).

    All level metrics are sums and counts over these rows, so the events are shuffled once, after
    being combined on the map side, for any number of metrics. Wins carry their attempt in the key;
    every other event of a user falls into the row without one.
    """
    won_at = F.expr(f"if({WON}, attempt, NULL) AS win_attempt")
    return metric.groupBy(*PLAYER_KEYS, won_at, *more).agg(*map(F.expr, PLAYER_FACTS))


#: How rows of ``player_facts`` are folded again; what is not named is summed.
FOLD_AGAIN = {"first_start": F.min, "turn_started": F.max, "paid": F.max, "ended": F.max, "used_booster": F.max}


def merged_facts(facts: DataFrame) -> DataFrame:
    """Facts of several parts of the events, of each day for example, as those of all of them."""
    keys = [*PLAYER_KEYS, "win_attempt"]
    names = [text.rsplit(" AS ", 1)[1] for text in PLAYER_FACTS]
    return facts.groupBy(*keys).agg(*[FOLD_AGAIN.get(name, F.sum)(name).alias(name) for name in names])


# A user weighs once per attempt at which they won.
APS = (
    f"try_divide(CAST(sum(if({USER} IS NOT NULL, CAST(win_attempt AS BIGINT), NULL)) AS DOUBLE),"
    f" CAST(count(if({USER} IS NOT NULL, win_attempt, NULL)) AS DOUBLE)) AS aps_avg"
)
LEVEL_SUMS = (
    "max(first_start IS NOT NULL) AS has_start",
    f"count(if(first_start IS NOT NULL, {USER}, NULL)) AS user_start_count",
    f"count(if(used_booster = 1, {USER}, NULL)) AS booster_users",
    f"count(if(paid = 1 AND first_start IS NOT NULL, {USER}, NULL)) AS payers",
    f"count(if(turn_started = 1, {USER}, NULL)) AS balance_users",
    "sum(coin_spend) AS coin_spend",
    "sum(total_coin_spend) AS total_coin_spend",
    "sum(booster_count) AS booster_count",
    "sum(impressions) AS impressions",
    "try_divide(sum(completion_sum), CAST(sum(completions) AS DOUBLE)) AS avg_completion",
    "sum(selected_balance) AS selected_balance",
    "sum(total_balance) AS total_balance",
    APS,
)


def level_columns(cfg: ReportConfig) -> list[Column]:
    """Everything the level report takes from metric events, as aggregates of player facts."""
    ads = "nullif(sum({0}), 0) AS {0}" if cfg.null_missing_ads else "sum({0}) AS {0}"
    kinds = [ads.format(name) for name in ("inter_impressions", "reward_impressions")]
    return [
        *map(F.expr, (*LEVEL_SUMS, *kinds)),
        *mature_users(F.col("first_start"), cfg),
    ]


LEVEL_STATS = (
    "booster_users", "coin_spend", "total_coin_spend", "booster_count", "impressions",
    "inter_impressions", "reward_impressions", "avg_completion",
)


def level_stats(metric: DataFrame, cfg: ReportConfig) -> DataFrame:
    levels = player_facts(metric).groupBy(*LEVEL_KEYS).agg(*level_columns(cfg))
    return levels.select(*LEVEL_KEYS, *LEVEL_STATS)


def payers(metric: DataFrame) -> DataFrame:
    """Purchasers among the starters of the same level."""
    paying = player_facts(metric).where(
        (F.col("paid") == 1) & F.col("first_start").isNotNull() & F.col(USER).isNotNull()
    )
    return users_per_level(paying, "payers")


def attempts_per_success(metric: DataFrame) -> DataFrame:
    """Mean winning attempt per level."""
    wins = player_facts(metric).where(F.col("win_attempt").isNotNull())
    return wins.groupBy(*LEVEL_KEYS).agg(F.expr(APS))


def balance_starters(metric: DataFrame) -> DataFrame:
    """Users with a turn start at any attempt."""
    return users_per_level(player_facts(metric).where(F.col("turn_started") == 1), "users")


def resource_rows(metric: DataFrame) -> DataFrame:
    """Payload entries of first-attempt turn starts as rows."""
    return metric.where(F.col("resources").isNotNull()).select(
        *PLAYER_KEYS, F.explode("resources").alias("k", "v")
    )


def balance_sums(metric: DataFrame) -> DataFrame:
    """Summed first-attempt balances of the selected resources and of all of them."""
    return (
        metric.where(F.col("total_balance").isNotNull())
        .groupBy(*LEVEL_KEYS)
        .agg(
            F.sum("selected_balance").alias("selected_balance"),
            F.sum("total_balance").alias("total_balance"),
        )
    )
