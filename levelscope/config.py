"""Settings of the two pipelines. All calendar dates are local (UTC + ``utc_offset_hours``)."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date, datetime, timedelta

# --- Fixed values of the event format -------------------------------------------------------
RAW_COLUMNS = (
    "app_id", "user_pseudo_id", "event_ts", "event_name", "event_params", "user_properties",
)
CORRECTED_COLUMNS = RAW_COLUMNS + (
    "mode_fixed", "first_clear_650_ts", "app_version", "country", "platform",
)
ADDED_COLUMNS = (
    "mode_original", "mode_fixed", "is_mode_fixed", "first_clear_650_ts", "fix_reason",
    "analysis_date_utc7", "ab_group",
)
PAYLOAD_COLUMNS = ("event_params", "user_properties")
USER = "user_pseudo_id"

REPORT_EVENTS = (
    "level_start", "level_start_turn", "level_end", "level_end_turn",
    "spend_virtual_currency", "paid_ad_impression", "in_app_purchase", "in_app_purchase_v2",
    "app_remove", "session_start", "screen_view",
)
SESSION_EVENTS = ("session_start", "screen_view")
PURCHASE_EVENTS = ("in_app_purchase", "in_app_purchase_v2")
PROPERTY_EVENTS_RANGE = ("paid_ad_impression", "in_app_purchase", "app_remove")
PROPERTY_EVENTS_ALL = PROPERTY_EVENTS_RANGE + ("in_app_purchase_v2",)
DEFAULT_EXPERIMENT_KEY = "firebase_exp_abt_22"
# --------------------------------------------------------------------------------------------


#: Largest cutoff table to broadcast: measured text and row overhead, about a third of what it takes
#: as a hash table in the driver and in every executor.
BROADCAST_BYTES = 32 << 20
#: Rows of the filter of users with a cutoff: 64 bits each, some 50 bytes each where it is broadcast.
FILTER_SLOTS = 1 << 21
#: Users that a row of the filter is meant for.
USERS_A_SLOT = 4
#: Share of the rows from which a user counts as busy.
BUSY_SHARE = 1 / 2000


def to_date(value: str | date) -> date:
    if isinstance(value, datetime):
        return value.date()
    return value if isinstance(value, date) else date.fromisoformat(value)


def _need(ok: bool, message: str) -> None:
    if not ok:
        raise ValueError(message)


@dataclass(frozen=True)
class CorrectionConfig:
    """Stage 1: which history to read and what counts as passing the milestone."""

    app_id: str
    history_start: datetime | str
    history_end: datetime | str  # exclusive
    experiment_key: str = DEFAULT_EXPERIMENT_KEY
    milestone_level: float = 650
    milestone_event: str = "level_end"
    mode: str = "classic"
    mode_after: str = "sl"
    utc_offset_hours: int = 7
    broadcast_bytes: int = BROADCAST_BYTES
    busy_share: float = BUSY_SHARE

    def __post_init__(self) -> None:
        _need(0 < self.busy_share <= 1, "busy_share must be above 0, and 1 at most")
        start, stop = self.utc_bounds()
        _need(start < stop, "history_start must be before history_end")

    def utc_bounds(self) -> tuple[datetime, datetime]:
        """Half-open UTC interval of the requested local history."""

        def utc(value: datetime | str) -> datetime:
            local = value if isinstance(value, datetime) else datetime.fromisoformat(value)
            return local - timedelta(hours=self.utc_offset_hours)

        return utc(self.history_start), utc(self.history_end)


@dataclass(frozen=True)
class ReportConfig:
    """Stage 2: cohort, maturity and the options in which the two report definitions differ.

    Use :meth:`attempt_range` for the level-range definition with a fixed version list, and
    :meth:`all_levels` for the definition without a level range.
    """

    app_id: str
    report_start: date | str
    report_end: date | str
    as_of_date: date | str
    observation_end: date | str
    versions: tuple[str, ...] = ()  # empty = every version
    variants: tuple[str, ...] = ("0", "1", "2")
    balance_resources: tuple[str, ...] = ("coin",)
    day_horizons: tuple[int, ...] = (3, 7)
    report_horizons: tuple[int, ...] | None = None  # shown in the level report; None: all
    experiment_key: str = DEFAULT_EXPERIMENT_KEY
    mode: str = "classic"
    mode_after: str = "sl"
    utc_offset_hours: int = 7
    milestone_level: float = 650

    # None = no level range
    level_min: float | None = None
    level_max: float | None = None
    # events whose level and mode come from user_properties
    property_events: tuple[str, ...] = PROPERTY_EVENTS_ALL
    ads_denominator: str = "property"  # or "event": the gameplay starters
    ads_phase_filter: bool = True
    null_missing_ads: bool = True  # False: a level without such ads shows 0
    interstitial_column: bool = True
    loss_keep_phase: bool = True  # False: losses only from metric events (phase <= 1)
    loss_churn: str = "every_day"  # or "last_start"
    null_missing_loss_churn: bool = True
    round_whole: bool = True  # fractions in whole-number fields: rounded, or cut off
    strict_dates: bool = True  # False: observation may end inside the report or on as_of_date

    # system filters
    excluded_country: str = "China"
    excluded_platform: str = "android"
    balance_limit: float = 1_000_000
    purchase_limit: float = 300_000_000
    purchase_rates: tuple[tuple[str, float], ...] = (("USD", 1.0), ("ILS", 0.33))

    def __post_init__(self) -> None:
        for name in ("report_start", "report_end", "as_of_date", "observation_end"):
            object.__setattr__(self, name, to_date(getattr(self, name)))
        for name in ("versions", "variants", "balance_resources"):
            values = getattr(self, name)
            _need(
                not isinstance(values, str) and all(isinstance(v, str) for v in values),
                f"{name} must be a list of strings",
            )
            object.__setattr__(self, name, tuple(values))
        if self.report_horizons is None:
            object.__setattr__(self, "report_horizons", tuple(self.day_horizons))
        _need(
            set(self.report_horizons) <= set(self.day_horizons),
            "report_horizons must be among day_horizons",
        )
        _need(self.report_start <= self.report_end, "report_start must not be after report_end")
        if self.strict_dates:
            _need(
                self.report_end <= self.observation_end,
                "observation_end must not be before report_end",
            )
            _need(
                self.observation_end < self.as_of_date,
                "observation_end must be a complete day before as_of_date",
            )
        _need(len(self.variants) > 0, "variants must not be empty")
        _need(self.ads_denominator in ("property", "event"), "ads_denominator: property or event")
        _need(self.loss_churn in ("last_start", "every_day"), "loss_churn: last_start or every_day")
        _need(
            (self.level_min is None) == (self.level_max is None),
            "level_min and level_max go together",
        )

    @classmethod
    def attempt_range(cls, **settings) -> "ReportConfig":
        """Level range and version list required; incomplete churn from each user's last start."""
        _need(len(settings.get("versions", ())) > 0, "this preset needs a version list")
        _need(
            settings.get("level_min") is not None and settings.get("level_max") is not None,
            "this preset needs level_min and level_max",
        )
        preset = dict(
            round_whole=False,
            property_events=PROPERTY_EVENTS_RANGE,
            ads_phase_filter=False,
            null_missing_ads=False,
            interstitial_column=False,
            loss_keep_phase=False,
            loss_churn="last_start",
            null_missing_loss_churn=False,
            strict_dates=False,
        )
        return cls(**{**preset, **settings})

    @classmethod
    def all_levels(cls, **settings) -> "ReportConfig":
        """Every level; incomplete churn from every mature play day."""
        return cls(**settings)

    def with_(self, **changes) -> "ReportConfig":
        return replace(self, **changes)

    def eligible_end(self, horizon: int) -> date:
        """Last play date that has been observed for ``horizon`` further days."""
        return min(
            self.report_end,
            self.as_of_date - timedelta(days=horizon + 1),
            self.observation_end - timedelta(days=horizon),
        )

    def window_utc(self) -> tuple[datetime, datetime]:
        """Half-open UTC interval covering the report and the observation days after it."""

        def midnight(day: date) -> datetime:
            return datetime(day.year, day.month, day.day) - timedelta(hours=self.utc_offset_hours)

        return midnight(self.report_start), midnight(
            max(self.report_end, self.observation_end) + timedelta(days=1)
        )
