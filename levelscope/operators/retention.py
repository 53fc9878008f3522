"""Coming back or not: non-return per horizon, and levels left incomplete for good.

All of it rests on one relation, :func:`play_days`: per user and play day, the next day with any
session. It is built from day-level rows, so that a user contributes at most a few rows per day
however many events they have.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from levelscope.config import USER, ReportConfig
from levelscope.functions.game import percent
from levelscope.operators.align import align, fold
from levelscope.operators.filters import in_report, is_play, is_session
from levelscope.operators.funnel import LEVEL_KEYS, PLAYER_KEYS

LOSS_HORIZON = 3  # fixed value: incomplete-level churn looks at days observed for three more


def maturity_windows(days: DataFrame, cfg: ReportConfig) -> DataFrame:
    """``(n, report_start, eligible_end)`` from a one-row frame with ``observation_end``."""
    horizon = F.col("n")
    return days.select(
        F.explode(F.array(*[F.lit(n) for n in cfg.day_horizons])).alias("n"), "observation_end"
    ).select(
        "n",
        F.lit(cfg.report_start).alias("report_start"),
        F.least(
            F.lit(cfg.report_end),
            F.date_sub(F.lit(cfg.as_of_date), horizon + 1),
            F.date_sub("observation_end", horizon),
        ).alias("eligible_end"),
    )


def level_starts(metric: DataFrame) -> DataFrame:
    return metric.where(F.col("event_name") == "level_start")


def mature_cohort(metric: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Distinct (variant, level, user, day) starts, once per horizon observed in full."""
    plays = level_starts(metric).select(*PLAYER_KEYS, "local_date").distinct()
    mature = F.array_compact(
        F.array(
            *[
                F.when(F.col("local_date") <= F.lit(cfg.eligible_end(n)), F.lit(n))
                for n in cfg.day_horizons
            ]
        )
    )
    return plays.select(F.explode(mature).alias("n"), *PLAYER_KEYS, "local_date")


def mature_users(first_start: Column, cfg: ReportConfig) -> list[Column]:
    """Per horizon ``n``: users whose first start of the level lies on a mature day."""
    return [
        F.count(F.when(first_start <= F.lit(cfg.eligible_end(n)), F.col(USER))).alias(f"mature_{n}")
        for n in cfg.day_horizons
    ]


def daily_sessions(clean: DataFrame, cfg: ReportConfig) -> DataFrame:
    return clean.where(is_session(cfg)).select(USER, "local_date").distinct()


def last_level_per_day(metric: DataFrame) -> DataFrame:
    """Highest level each user starts on a day, per variant."""
    return (
        level_starts(metric)
        .groupBy("variant", USER, "local_date")
        .agg(F.max("level").alias("level"))
    )


def play_days(clean: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Per variant, user and play day: highest level of the day and the next session day, if any.

    Plays and sessions are folded to day rows in one pass and laid out on one day line per user,
    which is swept from the latest day backwards: no pairs of play and session days are formed. A
    user has at most one row per day and variant and one for sessions, so the line stays short.
    Events without a user can neither return nor be counted and are left out.
    """
    return laid_out(day_line(clean, cfg))


def day_line(clean: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Per user and day: a row for each variant played, with the highest level, and one without a variant
    if there is a session."""
    play, session = is_play(cfg), is_session(cfg)
    return (
        clean.where(F.col(USER).isNotNull() & (play | session))
        .groupBy(USER, "local_date", F.when(play, F.col("variant")).alias("variant"))
        .agg(
            F.max(F.when(play, F.col("level"))).alias("level"),
            F.max(F.when(session, F.col("local_date"))).alias("session_day"),
        )
    )


def laid_out(line: DataFrame) -> DataFrame:
    """The play days of a ``day_line``, each with the next session day."""
    return (
        line.withColumn("next_session", next_session())
        .where(F.col("level").isNotNull())
        .select("variant", "level", USER, "local_date", "next_session")
    )


def next_session() -> Column:
    """The next day with a session, of the rows of a user."""
    later = (
        Window.partitionBy(USER)
        .orderBy(F.unix_date("local_date").desc())
        .rangeBetween(Window.unboundedPreceding, -1)
    )
    return F.min("session_day").over(later)


def gone_players(days: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Per player and horizon n: a mature day that ended here with no session on the next n days.

    A user's day belongs to the highest level started that day. One flag per horizon.
    """

    def gone(n: int) -> Column:
        day, back = F.col("local_date"), F.col("next_session")
        stayed_away = back.isNull() | (back > F.date_add(day, n))
        return F.max((day <= F.lit(cfg.eligible_end(n))) & stayed_away).alias(f"gone_{n}")

    return days.groupBy(*PLAYER_KEYS).agg(*[gone(n) for n in cfg.day_horizons])


def gone_counts(cfg: ReportConfig) -> list[Column]:
    return [F.count_if(F.col(f"gone_{n}")).alias(f"churned_{n}") for n in cfg.day_horizons]


def player_progress(metric: DataFrame) -> DataFrame:
    """Per variant, level and user: day of the first start, and whether the level ever ended."""
    name = F.col("event_name")
    return (
        metric.where(name.isin("level_start", "level_end"))
        .groupBy(*PLAYER_KEYS)
        .agg(
            F.min(F.when(name == "level_start", F.col("local_date"))).alias("first_start"),
            F.max(name == "level_end").alias("ended"),
        )
    )


def non_return(metric: DataFrame, days: DataFrame, cfg: ReportConfig) -> DataFrame:
    """One row per horizon, variant and level with mature starters: users, lost users, rate."""
    first = F.min("first_start").alias("first_start")
    merged = fold(
        LEVEL_KEYS,
        (player_progress(metric), [first, *mature_users(F.col("first_start"), cfg)]),
        (gone_players(days, cfg), gone_counts(cfg)),
    )

    def horizon(n: int) -> Column:
        users = F.col(f"mature_{n}")
        lost = F.col(f"churned_{n}")
        return F.when(
            F.col("first_start") <= F.lit(cfg.eligible_end(n)),
            F.struct(
                F.lit(n).alias("n"),
                *LEVEL_KEYS,
                users.alias("total_users"),
                lost.alias("users_churned"),
                percent(lost, users).alias("rate"),
            ),
        )

    rows = F.array_compact(F.array(*[horizon(n) for n in cfg.day_horizons]))
    return merged.select(F.inline(rows))


def latest_start(days: DataFrame) -> DataFrame:
    """Each user's last play day in a variant, its level and the next session after it."""
    last = F.max(F.struct("local_date", "level", "next_session")).alias("last")
    return (
        days.groupBy("variant", USER)
        .agg(last)
        .select("variant", USER, "last.local_date", "last.level", "last.next_session")
    )


def ended_levels(clean: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Distinct (user, level) with a level end in the report, in any mode and variant."""
    ends = clean.where((F.col("event_name") == "level_end") & in_report(cfg))
    return ends.select(USER, "level").distinct()


def _over_mature_starters(progress: DataFrame, left: DataFrame, ended_counts: bool, cfg):
    """Players of ``left`` (distinct), counted per level over the level's mature starters."""
    players = align(PLAYER_KEYS, progress, left.withColumn("left", F.lit(True)))
    return left_per_level(players, ended_counts, cfg)


def left_per_level(players: DataFrame, ended_counts: bool, cfg: ReportConfig) -> DataFrame:
    """The churn of each level from its players: ``first_start``, ``ended`` and whether they ``left``."""
    end = F.lit(cfg.eligible_end(LOSS_HORIZON))
    lost_here = F.col("left") & ~F.coalesce("ended", F.lit(False)) if ended_counts else F.col("left")
    lost = F.count(F.when(lost_here, F.col(USER)))
    total = F.count(F.when(F.col("first_start") <= end, F.col(USER)))
    return (
        players.groupBy(*LEVEL_KEYS)
        .agg(
            F.min("first_start").alias("first_start"),
            total.alias("total_users"),
            lost.alias("users_churned"),
            percent(lost, total).alias("rate"),
        )
        .where(F.col("first_start") <= end)
        .drop("first_start")
    )


def incomplete_churn_last_start(
    progress: DataFrame, ended: DataFrame, days: DataFrame, cfg: ReportConfig
) -> DataFrame:
    """Users whose last start in the report was never ended and never followed by a session.

    The last start is taken over the whole report and only then held against the mature days. An
    end counts whatever its mode or variant; a session counts up to the end of the report.
    """
    back = F.col("next_session")
    left = (
        latest_start(days)
        .where(
            (F.col("local_date") <= F.lit(cfg.eligible_end(LOSS_HORIZON)))
            & (back.isNull() | (back > F.lit(cfg.report_end)))
        )
        .join(ended, [USER, "level"], "left_anti")
        .select(*PLAYER_KEYS)
    )
    return _over_mature_starters(progress, left, False, cfg)


def incomplete_churn_every_day(progress: DataFrame, days: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Users with a mature day that ended at a level never ended there and followed by no session."""
    left = (
        days.where(
            (F.col("local_date") <= F.lit(cfg.eligible_end(LOSS_HORIZON)))
            & F.col("next_session").isNull()
        )
        .select(*PLAYER_KEYS)
        .distinct()
    )
    return _over_mature_starters(progress, left, True, cfg)


def incomplete_churn(
    clean: DataFrame, metric: DataFrame, days: DataFrame, cfg: ReportConfig
) -> DataFrame:
    """``(variant, level, total_users, users_churned, rate)`` in the configured definition."""
    progress = player_progress(metric)
    if cfg.loss_churn == "last_start":
        return incomplete_churn_last_start(progress, ended_levels(clean, cfg), days, cfg)
    return incomplete_churn_every_day(progress, days, cfg)
