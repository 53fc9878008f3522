"""Typed, report-ready columns from corrected events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levelscope.config import USER, ReportConfig
from levelscope.functions.game import balance_of, game_level, local_date, mode_after_cutoff
from levelscope.functions.payload import payload_map, whole, with_payload_fields

# Payload keys.
TURNS = ("level_start_turn", "level_end", "level_end_turn")
PLAYED = ("level_start", *TURNS, "spend_virtual_currency")
SPEND = ("spend_virtual_currency",)
# payload key: the events for which a filter or a report reads it
EVENT_FIELDS = {
    "level": PLAYED,
    "phase": PLAYED,
    "success": ("level_end", "level_end_turn"),
    "start_count": TURNS,
    "continue_times": ("level_end",),
    "completion": ("level_end", "level_end_turn"),
    "use_booster_count": ("level_end_turn",),
    "value": ("spend_virtual_currency", "in_app_purchase"),
    "value_game_currency": ("spend_virtual_currency", "earn_virtual_currency"),
    "virtual_currency_name": SPEND,
    "virtual_currency_type": SPEND,
    "ad_format": ("paid_ad_impression",),
    "coin": ("level_start_turn",),
    "currency": ("in_app_purchase",),
}
USER_FIELDS = ("level", "phase", "mode")


def typed_columns(rounded: bool) -> tuple[str, ...]:
    def number(column: str, kind: str = "int") -> str:
        return whole(column, kind, rounded)

    return (
        USER,
        "event_name",
        "app_version",
        "country",
        "platform",
        "mode_fixed",
        "first_clear_650_ts",
        "event_ts AS ts_utc",
        "variant",
        "e_level AS event_level_text",
        "u_level AS property_level_text",
        "try_cast(e_level AS double) AS raw_level",
        "try_cast(u_level AS double) AS property_level",
        f"{number('e_phase')} AS event_phase",
        f"{number('u_phase')} AS property_phase",
        "u_mode AS property_mode",
        "lower(e_success) AS success",
        f"{number('e_start_count')} AS attempt",
        f"{number('e_continue_times')} AS continues",
        "try_cast(e_completion AS double) AS completion",
        "try_cast(e_use_booster_count AS double) AS used_boosters",
        "try_cast(e_value AS double) AS currency_value",
        f"{number('e_value_game_currency', 'bigint')} AS game_currency_value",
        "lower(e_virtual_currency_name) AS currency_name",
        "lower(e_virtual_currency_type) AS currency_type",
        "lower(coalesce(e_ad_format, '')) AS ad_format",
        "try_cast(e_coin AS double) AS start_coin",
        "e_currency AS purchase_currency",
    )


def parse_fields(events: DataFrame, cfg: ReportConfig, lean: bool = False) -> DataFrame:
    """Decode both payloads once and type the fields. Unreadable values become NULL.

    ``lean`` leaves out what no report reads, see :data:`EVENT_FIELDS`.
    """
    # The user's payload comes first: a filter on the variant then spares the event's.
    decoded = with_payload_fields(
        events,
        "user_properties",
        {**{f"u_{name}": name for name in USER_FIELDS}, "variant": cfg.experiment_key},
    )
    decoded = with_payload_fields(
        decoded,
        "event_params",
        {f"e_{name}": name for name in EVENT_FIELDS},
        readers=EVENT_FIELDS if lean else None,
    )
    # only first-attempt turn starts carry a balance sheet; other payloads end here
    opening_turn = F.expr(
        "event_name = 'level_start_turn'"
        f" AND {whole('e_start_count', rounded=cfg.round_whole)} = 1"
    )
    resources = F.when(opening_turn, payload_map(events, "event_params")).alias("resources")
    return decoded.select(*map(F.expr, typed_columns(cfg.round_whole)), resources)


def normalize(parsed: DataFrame, cfg: ReportConfig) -> DataFrame:
    """Local date, level numbers and the level and mode that count for each kind of event.

    Ads, purchases and removals have no level of their own and take it from the user's state.
    """
    from_user = F.col("event_name").isin(*cfg.property_events)
    user_mode = mode_after_cutoff(
        F.col("property_mode"), F.col("ts_utc"), F.col("first_clear_650_ts"),
        cfg.mode, cfg.mode_after,
    )
    user_level = game_level(F.col("property_level_text"), F.col("property_phase"))
    event_level = game_level(F.col("event_level_text"), F.col("event_phase"))
    return parsed.withColumns(
        {
            "local_date": local_date(F.col("ts_utc"), cfg.utc_offset_hours),
            "property_bi_level": user_level,
            "property_mode_fixed": user_mode,
            "level": F.when(from_user, user_level).otherwise(event_level),
            "metric_mode": F.when(from_user, user_mode).otherwise(F.col("mode_fixed")),
            "selected_balance": balance_of(F.col("resources"), cfg.balance_resources),
            "total_balance": balance_of(F.col("resources")),
        }
    )


# What the operators after the system filters read; everything else ends at the staged table.
CLEAN_COLUMNS = (
    USER, "event_name", "app_version", "variant", "local_date", "level", "metric_mode",
    "property_bi_level", "property_level_text", "property_level", "property_mode_fixed",
    "event_phase", "property_phase", "success", "attempt", "continues", "completion",
    "used_boosters", "currency_value", "game_currency_value", "currency_name", "currency_type",
    "ad_format", "selected_balance", "total_balance", "resources", "first_clear_650_ts",
)
