"""Stage 1: first milestone clear per user, and re-labelled modes after it."""

from __future__ import annotations

from functools import reduce
from math import ceil, log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levelscope.config import (
    BROADCAST_BYTES,
    BUSY_SHARE,
    FILTER_SLOTS,
    USER,
    USERS_A_SLOT,
    CorrectionConfig,
)
from levelscope.functions.game import local_date, utc_literal
from levelscope.functions.payload import (
    to_double,
    to_utc_timestamp,
    with_payload_fields,
)
from levelscope.session import stage

TS = "_utc"
# columns beside those of the events while cutoffs are attached
SLOT, BITS, BUSY, BUSY_TS = "_cutoff_slot", "_cutoff_bits", "_cutoff_busy", "_cutoff_busy_ts"


def history_window(df: DataFrame, cfg: CorrectionConfig) -> DataFrame:
    """The app's events in the half-open history interval. Text timestamps are compared parsed."""
    start, stop = cfg.utc_bounds()
    source = df.schema["event_ts"].dataType
    ts = to_utc_timestamp(F.col("event_ts"), source)
    kind = "timestamp_ntz" if source.simpleString() == "timestamp_ntz" else "timestamp"
    return df.where(
        (F.col("app_id") == cfg.app_id)
        & (ts >= utc_literal(start, kind))
        & (ts < utc_literal(stop, kind))
    )


def milestone_events(df: DataFrame, cfg: CorrectionConfig) -> DataFrame:
    """Won milestone levels: level number in the event and in the user state, original mode.

    The event name is compared first and on the bare column: only those rows are decoded.
    """
    ends = df.where((F.col("event_name") == cfg.milestone_event) & F.col(USER).isNotNull())
    ts = to_utc_timestamp(F.col("event_ts"), df.schema["event_ts"].dataType)
    ends = ends.select(USER, ts.alias(TS), "event_params", "user_properties")
    ends = with_payload_fields(
        ends, "event_params", {"_mode": "mode", "_success": "success", "_level": "level"}
    )
    ends = with_payload_fields(ends, "user_properties", {"_user_level": "level"})
    return ends.where(
        (F.lower("_success") == "true")
        & (to_double(F.col("_level")) == float(cfg.milestone_level))
        & (to_double(F.col("_user_level")) == float(cfg.milestone_level))
        & (F.col("_mode") == cfg.mode)
    )


def milestone_cutoffs(df: DataFrame, cfg: CorrectionConfig) -> DataFrame:
    """``(user_pseudo_id, first_clear_650_ts)``, one row per user who passed the milestone."""
    return (
        milestone_events(df, cfg)
        .groupBy(USER)
        .agg(F.min(TS).alias("first_clear_650_ts"))
    )


def cutoff_size(cutoffs: DataFrame) -> tuple[int, int]:
    """Rows of the cutoff table, and its bytes: row overhead, timestamp and the user text."""
    row = cutoffs.agg(
        F.sum(F.octet_length(USER).cast("long")).alias("text"), F.count("*").alias("rows")
    ).first()
    return row["rows"], (row["text"] or 0) + 48 * row["rows"]


def _slot(slots: int) -> Column:
    return F.pmod(F.xxhash64(USER), F.lit(slots)).alias(SLOT)


def _mask() -> Column:
    """Four of 64 bits, by another hash of the user than the slot's."""
    mixed = F.xxhash64(F.lit("bits"), USER)
    bits = [F.shiftright(mixed, 6 * k).bitwiseAND(F.lit(63)).cast("int") for k in range(4)]
    one = F.lit(1).cast("long")
    return reduce(Column.bitwiseOR, [F.call_function("shiftleft", one, bit) for bit in bits])


def member_filter(cutoffs: DataFrame, slots: int) -> DataFrame:
    """A Bloom filter of the users with a cutoff as a table: the slots in use, with 64 bits each. It says of every member that it may be one, and of others too by chance: of 3 % with
    four users a slot, of 25 % with ten."""
    return cutoffs.groupBy(_slot(slots)).agg(F.bit_or(_mask()).alias(BITS))


def may_be_member() -> Column:
    """Whether a user may have a cutoff, by the bits of the user's slot (null: none)."""
    return F.coalesce(F.col(BITS).bitwiseAND(_mask()) == _mask(), F.lit(False))


def busy_users(df: DataFrame, share: float) -> DataFrame:
    """``user`` of every user with at least this share of the rows that have one, and at most of some that
    come near it: a few times ``1 / share`` at the most, whatever the input. The partitions' sketches of heavy
    hitters are merged; no rows are shuffled."""
    tracked = 1 << max(5, ceil(log2(4 / share)))  # so the sketch is wrong by less than the share
    known = df.where(F.col(USER).isNotNull())
    top = F.expr(f"approx_top_k({USER}, {tracked // 2}, {tracked})")
    found = known.agg(top.alias("top"), F.count("*").alias("rows"))
    found = found.select("rows", F.explode("top").alias("t"))
    return found.where(F.col("t.count") >= share * F.col("rows")).select(F.col("t.item").alias("user"))


def attach_cutoffs(
    df: DataFrame,
    cutoffs: DataFrame,
    broadcast_bytes: int = BROADCAST_BYTES,
    busy_share: float = BUSY_SHARE,
    filter_slots: int = FILTER_SLOTS,
) -> DataFrame:
    """Left join of the cutoffs onto every event.

    ``cutoffs`` should be a written table, it is read once more to be measured. Up to the byte bound
    it is broadcast and the events are not shuffled at all. Beyond it events take one of two ways,
    and only those that need to are shuffled:

    * Events without a user, events of users whom the Bloom filter of the cutoffs does not know, and those
      of busy users stay where they are. The filter has at most ``filter_slots`` rows, and the busy users,
      who are few by definition, bring their cutoffs as a broadcast table.
    * The others are shuffled with the cutoffs by user; none of them has a great part of the rows.

    The input is scanned once for each way, and once more, the user column only, for the busy users.
    With more than ten users a slot the filter would know nearly everyone, and is left out.
    """
    rows, size = cutoff_size(cutoffs)
    if size <= broadcast_bytes:
        return df.join(F.broadcast(cutoffs), USER, "left")
    few = busy_users(df, busy_share)
    busy = few.join(cutoffs, few["user"] == cutoffs[USER], "left").select(
        F.col("user").alias(USER), F.col("first_clear_650_ts").alias(BUSY_TS), F.lit(True).alias(BUSY)
    )
    marked = df.join(F.broadcast(stage(busy, "busy-users")), USER, "left")
    member = F.col(USER).isNotNull() & F.col(BUSY).isNull()
    slots = min(filter_slots, 1 << max(10, (rows // USERS_A_SLOT).bit_length()))
    if rows <= 10 * slots:
        bloom = F.broadcast(member_filter(cutoffs, slots))
        marked = marked.withColumn(SLOT, _slot(slots)).join(bloom, SLOT, "left")
        member = member & may_be_member()
    plain = df.columns
    away = marked.where(member).select(*plain).join(cutoffs.hint("merge"), USER, "left")
    here = marked.where(~member).withColumn("first_clear_650_ts", F.col(BUSY_TS))
    columns = [*plain, "first_clear_650_ts"]
    return away.select(*columns).unionByName(here.select(*columns))


def is_mode_fixed(cfg: CorrectionConfig, ts: Column) -> Column:
    late = (F.col("mode_original") == cfg.mode) & (ts > F.col("first_clear_650_ts"))
    return F.coalesce(late, F.lit(False))


def mode_fixed(cfg: CorrectionConfig) -> Column:
    return F.when(F.col("is_mode_fixed"), F.lit(cfg.mode_after)).otherwise(F.col("mode_original"))


def fix_reason(cfg: CorrectionConfig) -> Column:
    """Fixed labels, first match wins."""
    return (
        F.when(F.col("is_mode_fixed"), "classic_after_clear650")
        .when(F.col("mode_original") == cfg.mode_after, "existing_sl")
        .when(F.col("first_clear_650_ts").isNull(), "no_clear650_in_history")
        .otherwise("unchanged")
    )


def corrected_events(df: DataFrame, with_cutoffs: DataFrame, cfg: CorrectionConfig) -> DataFrame:
    """All columns of ``df`` in their order, then the seven analysis columns."""
    decoded = with_payload_fields(with_cutoffs, "event_params", {"mode_original": "mode"})
    decoded = with_payload_fields(decoded, "user_properties", {"ab_group": cfg.experiment_key})
    return relabelled(decoded, df.columns, cfg)


def relabelled(df: DataFrame, columns: list[str], cfg: CorrectionConfig) -> DataFrame:
    """``columns`` and the seven analysis columns, by the original mode and the cutoff of each event."""
    ts = to_utc_timestamp(F.col("event_ts"), df.schema["event_ts"].dataType)
    return df.withColumn("is_mode_fixed", is_mode_fixed(cfg, ts)).select(
        *columns,
        "mode_original",
        mode_fixed(cfg).alias("mode_fixed"),
        "is_mode_fixed",
        "first_clear_650_ts",
        fix_reason(cfg).alias("fix_reason"),
        local_date(ts, cfg.utc_offset_hours).alias("analysis_date_utc7"),
        "ab_group",
    )
