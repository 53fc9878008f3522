"""Day by day facts, from which reports of any window are made without its events.

``daily_facts`` folds the clean events of some days to a few rows per player and day. Sums, smallest and
greatest values and bit sets of days fold again to those of a window, so a day is worked on once, when it is
complete, and each report reads the small rows of its days. A row belongs to one relation of the reports:

======  ==================================================================================
kind    row
======  ==================================================================================
player  ``economy.player_facts`` of a day
loss    ``loss.loss_players`` of a day
start   a level starter of a day
ads     a starter at the user's own level, the base of ads per viewer
day     ``retention.day_line``: a variant played with the highest level, or a session
end     a level that a user ended, in any mode and variant
======  ==================================================================================

The rows depend on all settings but the dates and horizons; facts of other settings lie in other folders. A user has
few rows a day whatever they do, so facts can be kept together by user: read as ``by_user`` they are staged in buckets,
and no fold of a report over users is shuffled any more.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from levelscope.config import USER, ReportConfig
from levelscope.operators.align import union_all
from levelscope.operators.economy import merged_facts, player_facts
from levelscope.operators.filters import cohort_events, metric_events
from levelscope.operators.funnel import PLAYER_KEYS, ads_players, level_starters
from levelscope.operators.loss import ALL, FIRST, loss_players, loss_shares, loss_with_churn, lost_turns
from levelscope.operators.retention import (
    LOSS_HORIZON, day_line, ended_levels, laid_out, left_per_level, next_session,
)
from levelscope.plans.reports import _of_kind, levelplay_of
from levelscope.session import run_key, stage_by

#: Settings that choose days or horizons of a report, or how its numbers are shown: facts are the same for all.
OF_THE_REPORT = (
    "report_start", "report_end", "as_of_date", "observation_end", "day_horizons", "report_horizons", "strict_dates",
    "ads_denominator", "null_missing_ads", "interstitial_column", "loss_churn", "null_missing_loss_churn",
)
DAY = "local_date"


def facts_key(cfg: ReportConfig) -> str:
    """A name for the settings that facts depend on."""
    return run_key({name: value for name, value in asdict(cfg).items() if name not in OF_THE_REPORT})


def daily_facts(clean: DataFrame, cfg: ReportConfig, first: date, last: date) -> DataFrame:
    """Facts of the days ``first`` to ``last``; ``clean`` are the events of these days at least, of a
    ``plans.reports.ReportInput``. The dates of ``cfg`` do not matter."""
    open_cfg = cfg.with_(report_start=first, report_end=last, observation_end=last, strict_dates=False)
    cohort = cohort_events(clean, open_cfg)
    metric = metric_events(cohort, open_cfg)
    # distinct relations of a day
    starts = _by_day(cohort, lambda events: level_starters(events, open_cfg))
    ads = _by_day(clean, lambda events: ads_players(events, open_cfg))
    ends = _by_day(clean, lambda events: ended_levels(events, open_cfg))
    losses = loss_players(lost_turns(cohort, metric, open_cfg, DAY), (FIRST, ALL), DAY)
    kinds = {
        "player": player_facts(metric, DAY), "loss": losses, "start": starts, "ads": ads,
        "day": day_line(clean, open_cfg), "end": ends,
    }
    return union_all([rows.select(F.lit(kind).alias("kind"), "*") for kind, rows in kinds.items()])


def _by_day(events: DataFrame, relation) -> DataFrame:
    """A distinct relation of users, of each day: the day goes along as part of the user."""
    paired = events.withColumn(USER, F.struct(F.col(USER).alias("user"), F.col(DAY).alias("day")))
    found = relation(paired)
    return found.select(
        *[c for c in found.columns if c != USER], F.col(USER)["user"].alias(USER), F.col(USER)["day"].alias(DAY)
    )


def write_facts(facts: DataFrame, path: str, cfg: ReportConfig) -> str:
    """Writes facts below ``path``, by day; days that are there already are replaced, others stay."""
    folder = f"{path}/facts-{facts_key(cfg)}"
    (
        facts.hint("rebalance", DAY)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(folder)
    )
    return folder


@dataclass(frozen=True)
class Facts:
    """The facts of a report's days, as the relations that reports rest on."""

    rows: DataFrame
    cfg: ReportConfig

    def of_kind(self, kind: str) -> DataFrame:
        return self.rows.where(F.col("kind") == kind)

    def in_report(self, kind: str) -> DataFrame:
        return self.of_kind(kind).where(F.col(DAY).between(self.cfg.report_start, self.cfg.report_end))

    @property
    def _observed(self) -> Column:
        """Whether the day of a ``day`` row is one that counts for plays, or for sessions."""
        last = F.when(F.col("variant").isNotNull(), F.lit(self.cfg.report_end)).otherwise(
            F.lit(self.cfg.observation_end)
        )
        return F.col(DAY).between(F.lit(self.cfg.report_start), last)

    @property
    def players(self) -> DataFrame:
        return merged_facts(self.in_report("player"))

    @property
    def starters(self) -> DataFrame:
        return self.in_report("start").select(*PLAYER_KEYS).distinct()

    @property
    def viewers(self) -> DataFrame:
        return self.in_report("ads").select(*PLAYER_KEYS).distinct()

    @property
    def days(self) -> DataFrame:
        """Plays are those of the report, sessions those that are observed."""
        line = self.of_kind("day").where(self._observed)
        return laid_out(line.select(USER, DAY, "variant", "level", "session_day"))

    @property
    def incomplete_churn(self) -> DataFrame:
        """``retention.incomplete_churn``, with windows over one scan of a user's rows in place of joins."""
        cfg, kind, back = self.cfg, F.col("kind"), F.col("next_session")
        rows = self.rows.where(
            ((kind == "day") & self._observed)
            | (kind.isin("player", "end") & F.col(DAY).between(cfg.report_start, cfg.report_end))
        )
        play = (kind == "day") & F.col("variant").isNotNull()
        mature = F.col(DAY) <= F.lit(cfg.eligible_end(LOSS_HORIZON))
        rows = rows.withColumn("next_session", next_session())
        if cfg.loss_churn == "last_start":
            last = F.max(F.when(play, F.col(DAY))).over(Window.partitionBy("variant", USER))
            ended = F.max(kind == "end").over(Window.partitionBy(USER, "level"))
            gone = (F.col(DAY) == last) & ~ended & (back.isNull() | (back > F.lit(cfg.report_end)))
        else:
            gone = back.isNull()
        players = (
            rows.withColumn("left", play & mature & gone)
            .where(F.col("variant").isNotNull())
            .groupBy(*PLAYER_KEYS)
            .agg(
                F.min("first_start").alias("first_start"),
                (F.max("ended") == 1).alias("ended"),
                F.max("left").alias("left"),
            )
        )
        return left_per_level(players, cfg.loss_churn != "last_start", cfg)

    def losers(self, asked: tuple[str, ...]) -> DataFrame:
        folds: list[Column] = []
        for kind in asked:
            folds.append(F.bit_or(f"{kind}_buckets").alias(f"{kind}_buckets"))
            folds.append(F.sum(f"{kind}_losses").alias(f"{kind}_losses"))
        return self.in_report("loss").groupBy(*PLAYER_KEYS).agg(*folds)


def read_facts(spark: SparkSession, path: str, cfg: ReportConfig) -> Facts:
    """The facts written with these settings, of the days from report start to the end of observation.

    Which days there are is not looked at: a day without facts is one without events.
    """
    rows = spark.read.parquet(f"{path}/facts-{facts_key(cfg)}")
    last = max(cfg.report_end, cfg.observation_end)
    return Facts(rows.where(F.col(DAY).between(cfg.report_start, last)), cfg)


def by_user(facts: Facts, buckets: int | None = None) -> Facts:
    """The same facts, staged in buckets of users: the one shuffle that all reports share."""
    spark = facts.rows.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    return Facts(stage_by(facts.rows, "facts", USER, n), facts.cfg)


def levelplay_from(facts: Facts) -> DataFrame:
    """The level report."""
    return levelplay_of(facts.players, facts.starters, facts.viewers, facts.days, facts.cfg)


def loss_from(facts: Facts, kind: str | None = None) -> DataFrame:
    """The loss report of one kind, or of both."""
    asked = (FIRST, ALL) if kind is None else (kind,)
    distribution = loss_shares(facts.losers(asked), asked)
    return _of_kind(loss_with_churn(distribution, facts.incomplete_churn, facts.cfg), kind)
