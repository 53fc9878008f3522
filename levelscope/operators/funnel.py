"""Who starts a level, who reaches the next one, who removes the app.

Distinct users are counted in two steps everywhere: one row per group and user, combined before
the shuffle, then a plain count. Rows without a user keep their group but are never counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from levelscope.config import USER, ReportConfig
from levelscope.functions.game import first_phase
from levelscope.operators.align import fold
from levelscope.operators.filters import in_cohort, level_in_range

LEVEL_KEYS = ["variant", "level"]
PLAYER_KEYS = ["variant", "level", USER]


def users_per_level(players: DataFrame, name: str) -> DataFrame:
    """Count users of a relation that is distinct on (variant, level, user)."""
    return players.groupBy(*LEVEL_KEYS).agg(F.count(USER).alias(name))


def level_starters(cohort: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Distinct (variant, level, user) of first-phase starts, one level past the range."""
    return (
        cohort.where(
            (F.col("event_name") == "level_start")
            & level_in_range(cfg, beyond=1)
            & first_phase(F.col("event_phase"))
        )
        .select(*PLAYER_KEYS)
        .distinct()
    )


def start_counts(starters: DataFrame, cfg: ReportConfig) -> DataFrame:
    return users_per_level(starters.where(level_in_range(cfg)), "user_start_count")


def dropped_players(starters: DataFrame) -> DataFrame:
    """Starters with a flag ``dropped``: never started the next level in the period and variant.

    The relation is distinct, so a user has one row per level and a window over these rows
    sees the next level, the one past the range included. Starters without a user keep their group
    but are not dropped.
    """
    next_level = Window.partitionBy("variant", USER).orderBy("level").rangeBetween(1, 1)
    stayed_away = F.count(F.lit(1)).over(next_level) == 0
    return starters.select(*PLAYER_KEYS, (F.col(USER).isNotNull() & stayed_away).alias("dropped"))


def drop_count() -> Column:
    return F.count_if("dropped").alias("dropped_users")


def next_level_drop(starters: DataFrame, cfg: ReportConfig) -> DataFrame:
    drops = dropped_players(starters).groupBy(*LEVEL_KEYS).agg(drop_count())
    return drops.where(level_in_range(cfg))


def app_removers(clean: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Distinct (variant, level, user) of app removals, at the user's level and in any mode."""
    whole_level = F.instr("property_level_text", ".") == 0
    return (
        clean.where(
            (F.col("event_name") == "app_remove")
            & in_cohort(cfg)
            & (whole_level | first_phase(F.col("property_phase")))
        )
        .select("variant", F.col("property_bi_level").alias("level"), USER)
        .distinct()
    )


def removing_starters(
    starters: DataFrame, removers: DataFrame, cfg: ReportConfig
) -> DataFrame:
    return starters.where(level_in_range(cfg)).join(removers, PLAYER_KEYS, "left_semi")


def remove_counts(starters: DataFrame, removers: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Starters of a level who removed the app at that level; levels with none are absent."""
    return users_per_level(removing_starters(starters, removers, cfg), "user_remove_count")


def churn_components(starters: DataFrame, removers: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Started, dropped and removed users side by side; removals are not part of the drop."""
    shown = starters.withColumn("started", F.lit(True))
    removed = removing_starters(starters, removers, cfg).withColumn("removed", F.lit(True))
    return fold(
        LEVEL_KEYS,
        (shown, [F.count(F.when(F.col("started"), F.col(USER))).alias("user_start_count")]),
        (dropped_players(starters), [drop_count().alias("user_dropped_count")]),
        (removed, [F.count_if("removed").alias("user_remove_count")]),
    ).where(level_in_range(cfg))


def ads_players(clean: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Distinct level starters by the user's own level and mode."""
    starts = clean.where(
        (F.col("event_name") == "level_start")
        & in_cohort(cfg)
        & (F.col("property_mode_fixed") == cfg.mode)
    )
    if cfg.level_min is not None:
        starts = starts.where(level_in_range(cfg, "property_bi_level"))
    if cfg.ads_phase_filter:
        starts = starts.where(first_phase(F.col("event_phase")))
    return starts.select("variant", F.col("property_bi_level").alias("level"), USER).distinct()


def ads_denominator(clean: DataFrame, cfg: ReportConfig) -> DataFrame:
    """The base of ads per active user."""
    return users_per_level(ads_players(clean, cfg), "users")
