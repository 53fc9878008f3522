"""How far lost attempts got."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levelscope.config import USER, ReportConfig
from levelscope.functions.game import BUCKETS, completion_bucket, percent
from levelscope.operators.funnel import PLAYER_KEYS

FIRST, ALL = "first", "all"  # fixed values of loss_kind


def lost_turns(cohort: DataFrame, metric: DataFrame, cfg: ReportConfig, *more: str) -> DataFrame:
    """Failed turn ends with a known completion and their bucket, with ``more`` columns if asked for.

    With ``loss_keep_phase`` later phases stay in as levels of their own (4.2).
    """
    source = cohort.where(F.col("level").isNotNull()) if cfg.loss_keep_phase else metric
    return source.where(
        (F.col("event_name") == "level_end_turn")
        & (F.col("success") == "false")
        & F.col("completion").isNotNull()
    ).select(*PLAYER_KEYS, *more, "attempt", completion_bucket(F.col("completion")).alias("bucket"))


def loss_kinds(losses: DataFrame) -> DataFrame:
    """One row per loss and kind: every loss is of kind ``all``, attempt 1 also of ``first``."""
    kinds = F.when(F.col("attempt") == 1, F.array(F.lit(FIRST), F.lit(ALL))).otherwise(
        F.array(F.lit(ALL))
    )
    return losses.select(F.explode(kinds).alias("loss_kind"), *losses.columns)


def loss_players(losses: DataFrame, asked: tuple[str, ...] = (FIRST, ALL), *more: str) -> DataFrame:
    """Losses folded to one row per player (and ``more``) with a set of buckets, one bit each, and a count for
    each of the asked kinds. Such rows can be folded again."""
    first = F.col("attempt") == 1
    if asked == (FIRST,):
        losses = losses.where(first)
    of_kind = {ALL: F.lit(True), FIRST: first}
    folds = [
        fold.alias(f"{kind}_{name}")
        for kind in asked
        for name, fold in (
            ("buckets", F.bit_or(F.when(of_kind[kind], F.col("bit")))),
            ("losses", F.count(F.when(of_kind[kind], 1))),
        )
    ]
    bits = losses.withColumn("bit", F.expr("shiftleft(1, bucket)"))
    return bits.groupBy(*PLAYER_KEYS, *more).agg(*folds)


def loss_distribution(losses: DataFrame, asked: tuple[str, ...] = (FIRST, ALL)) -> DataFrame:
    """Losers, losses and the share of losers per completion bucket, for the asked kinds.

    Counting players per bucket is a plain sum over their folded rows: one narrow shuffle instead of
    eleven distinct counts.
    """
    return loss_shares(loss_players(losses, asked), asked)


def loss_shares(players: DataFrame, asked: tuple[str, ...] = (FIRST, ALL)) -> DataFrame:
    """The distribution from the rows of ``loss_players``."""
    kinds = F.inline(
        F.array(
            *[
                F.struct(
                    F.lit(kind).alias("loss_kind"),
                    F.col(f"{kind}_buckets").alias("buckets"),
                    F.col(f"{kind}_losses").alias("losses"),
                )
                for kind in asked
            ]
        )
    )
    rows = players.select(*PLAYER_KEYS, kinds).where(F.col("losses") > 0)

    def share(i: int):
        lost_here = F.col("buckets").bitwiseAND(F.lit(1 << i)) != 0
        return percent(F.count(F.when(lost_here, F.col(USER))), F.count(USER))

    return (
        rows.withColumnRenamed("variant", "ab_group")
        .groupBy("loss_kind", "ab_group", "level")
        .agg(
            F.count(USER).alias("user_count"),
            F.sum("losses").alias("lose_count"),
            *[share(i).alias(name) for i, name in enumerate(BUCKETS)],
        )
    )


def loss_with_churn(distribution: DataFrame, churn: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Loss rows with the incomplete-level churn of their level, the same for both kinds."""
    lost = F.col("users_churned")
    if not cfg.null_missing_loss_churn:
        lost = F.coalesce(lost, F.lit(0))
    right = churn.select(
        F.col("variant").alias("ab_group"), "level", "users_churned", "rate"
    )
    return distribution.join(right, ["ab_group", "level"], "left").select(
        "loss_kind",
        "ab_group",
        "level",
        "user_count",
        "lose_count",
        lost.alias("churn_users_d3"),
        F.col("rate").alias("churn_rate_d3_pct"),
        *BUCKETS,
    )
