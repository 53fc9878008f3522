"""A hand-made period of five days with a few players, small enough to work reports out on paper.

Report days are 9 to 13 March, sessions are observed to 15 March, so the last day with three further
days is 12 March and no day has seven. Local time is UTC + 7; events happen at local noon unless a
time is given. Two arms: in arm 1 four players start level 12, in arm 2 one starts level 40 and one
is past the milestone.
"""

from __future__ import annotations

import json
from datetime import date, datetime, time, timedelta
from itertools import product

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levelscope.config import REPORT_EVENTS, ReportConfig

APP = "harbour"
EXPERIMENT = "arm"
SCHEMA = """app_id string, user_pseudo_id string, event_ts timestamp, event_name string,
  event_params string, user_properties string, mode_fixed string, first_clear_650_ts timestamp,
  app_version string, country string, platform string"""
PERIOD = dict(
    app_id=APP,
    report_start="2026-03-09",
    report_end="2026-03-13",
    as_of_date="2026-03-16",
    observation_end="2026-03-15",
    experiment_key=EXPERIMENT,
)
ALL = ReportConfig.all_levels(**PERIOD)
RANGE = ReportConfig.attempt_range(**PERIOD, versions=("2.4",), level_min=10, level_max=15)

EVENT_STRUCT = """struct<level:bigint,mode:string,phase:int,success:boolean,start_count:int,
  completion:double,continue_times:int,coin:double,ticket:double,booster_bomb:double,
  use_booster_count:int,virtual_currency_name:string,virtual_currency_type:string,
  value:double,value_game_currency:bigint,ad_format:string,currency:string>"""
USER_STRUCT = "struct<level:bigint,mode:string,phase:int,arm:string>"


class Player:
    """Makes events of one player; each takes a day of March 2026 or a time in UTC."""

    def __init__(self, name: str, arm: str = "1", mode: str | None = "classic", cutoff: str | None = None):
        self.name, self.arm, self.mode = name, arm, mode
        self.cutoff = datetime.fromisoformat(cutoff) if cutoff else None

    def __call__(self, event: str, when: int | datetime, level: int = 12, state: int | None = None, **fields):
        moment = datetime(2026, 3, when, 5) if isinstance(when, int) else when
        payload = {"level": level, "mode": "classic", "phase": 1} | fields
        user = {"level": state or level, "mode": "classic", "phase": 1, EXPERIMENT: self.arm}
        return (
            APP, self.name, moment, event, json.dumps(payload),
            json.dumps(user), self.mode, self.cutoff, "2.4", "Norway", "ios",
        )


CRAB, EEL, GULL, SEAL = (Player(name) for name in ("crab", "eel", "gull", "seal"))
OTTER = Player("otter", "2")


def attempts():
    """Starts, lost and won turns."""
    lost = dict(success=False)
    return [
        CRAB("level_start", 9),
        CRAB("level_end", 9, success=True, start_count=3, completion=90, continue_times=0),
        CRAB("level_start", 10, level=13),
        EEL("level_start", 9, state=11),
        EEL("level_end_turn", 9, **lost, start_count=1, completion=34, use_booster_count=2),
        EEL("level_end_turn", 9, **lost, start_count=1, completion=37),
        EEL("level_end_turn", 9, **lost, start_count=2, completion=88),
        GULL("level_start", 11),
        GULL("level_end_turn", 11, **lost, start_count=1, completion=5),
        GULL("level_end", 11, success=True, start_count=1, completion=80, continue_times=0),
        GULL("level_end", 11, success=True, start_count=1, completion=70),
        GULL("level_end", 11, success=True, start_count=5, completion=10, continue_times=2),
        GULL("level_start", 11, level=13),
        SEAL("level_start", 13),
        SEAL("level_end_turn", 13, level=20, phase=3, **lost, start_count=1, completion=55),
        OTTER("level_start", 12, level=40),
    ]


def economy():
    """Balances, spending, a purchase and ads, all at level 12."""

    def spent(player, day, name, amount, **more):
        return player(
            "spend_virtual_currency", day, virtual_currency_name=name, value_game_currency=amount, **more
        )

    return [
        GULL("level_start_turn", 11, start_count=1, coin=90, ticket=11),
        SEAL("level_start_turn", 13, start_count=1, coin=60, booster_bomb=4, use_booster_count=3),
        SEAL("level_start_turn", 13, start_count=1, coin=30),
        EEL("level_start_turn", 9, start_count=3, coin=70, ticket=5),
        spent(EEL, 9, "Coin", 30),
        spent(CRAB, 9, "coin", 10),
        spent(GULL, 11, "gem", 25),
        spent(SEAL, 13, "booster_bomb", 15, virtual_currency_type="booster", value=6),
        GULL("in_app_purchase", 11, value=5, currency="USD"),
        CRAB("paid_ad_impression", 9, ad_format="interstitial"),
        CRAB("paid_ad_impression", 10, ad_format="Interstitial_video"),
        EEL("paid_ad_impression", 9, ad_format="rewarded"),
        GULL("paid_ad_impression", 11, ad_format="banner"),
    ]


def sessions():
    """The crab comes back next day and on the 14th, the gull next day, eel and seal never."""
    return [
        CRAB("session_start", 10),
        CRAB("screen_view", 14),
        GULL("session_start", 12),
        OTTER("session_start", 15),
    ]


def past_milestone(mode: str | None = "sl"):
    """One event of every kind that reports read, by a player who passed the milestone the day before
    the report; ``mode`` is what stage 1 made of these events, which were all classic."""
    cutoff = datetime.combine(ALL.report_start, time()) - timedelta(days=1)
    tern = Player("tern", "2", mode, cutoff.isoformat(" "))
    return [tern(kind, 11, level=30, state=31, success=True, start_count=1) for kind in REPORT_EVENTS]


def base_rows(mode_past: str | None = "sl"):
    return attempts() + economy() + sessions() + past_milestone(mode_past)


#: What a payload column may hold besides an object with the fields.
UNREADABLE = (None, "", " ", "{", "null", "[]", "7", '"level"', "{}", '{"level":', '{"arm":{}}')


def unreadable_rows():
    """An event of every kind for each pair of unreadable payloads, each by a player of its own."""
    kinds = (*REPORT_EVENTS, "app_loading", "earn_virtual_currency")
    out = []
    for i, (kind, event, user) in enumerate(product(kinds, UNREADABLE, UNREADABLE)):
        row = Player(f"unread{i}")(kind, 11)
        out.append((*row[:4], event, user, *row[6:]))
    return out


def around(moments: list[datetime]) -> list[datetime]:
    """The moments, and one microsecond before each."""
    return [m - timedelta(microseconds=k) for m in moments for k in (0, 1)]


def local_midnights(cfg: ReportConfig) -> list[datetime]:
    """In UTC, the beginnings and ends of the days that bound a report."""
    days = (cfg.report_start, cfg.report_end, cfg.observation_end)
    ends = {day + timedelta(days=k) for day in days for k in (0, 1)}
    return sorted(datetime.combine(d, time()) - timedelta(hours=cfg.utc_offset_hours) for d in ends)


def local_day(moment: datetime, cfg: ReportConfig) -> date:
    return (moment + timedelta(hours=cfg.utc_offset_hours)).date()


def frame(spark: SparkSession, rows) -> DataFrame:
    return spark.createDataFrame(rows, SCHEMA)


def as_struct(df: DataFrame) -> DataFrame:
    return df.withColumn("event_params", F.from_json("event_params", EVENT_STRUCT)).withColumn(
        "user_properties", F.from_json("user_properties", USER_STRUCT)
    )


def as_map(df: DataFrame) -> DataFrame:
    text_map = "map<string,string>"
    return df.withColumn("event_params", F.from_json("event_params", text_map)).withColumn(
        "user_properties", F.from_json("user_properties", text_map)
    )


def collected(df: DataFrame, keys=("ab_group", "level")):
    return [r.asDict() for r in df.orderBy(*[k for k in keys if k in df.columns]).collect()]
