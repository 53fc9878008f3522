"""Game telemetry derived from the ``events`` test table, as a row-by-row projection.

``events(event_id, ts, user_id, event_type, value, props)`` carries no game fields, so each event is
given some from its id, user, day and ``props.k``. ``oracle.py`` states the same projection in SQL.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession

from levelscope.config import CorrectionConfig, ReportConfig
from levelscope.plans.correct import correct_history
from levelscope.session import shared_folder, use_utc
from levelscope.sources.readers import read_corrected, read_raw
from levelscope.sources.records import Record, table_record
from levelscope.sources.sinks import write_corrected

EXPERIMENT = "exp_group"
MILESTONE = 4

CORRECTION = CorrectionConfig(
    app_id="app_main",
    history_start="2024-01-01",
    history_end="2024-02-15",
    experiment_key=EXPERIMENT,
    milestone_level=MILESTONE,
)
PERIOD = dict(
    app_id="app_main",
    report_start="2024-01-10",
    report_end="2024-01-20",
    as_of_date="2024-01-22",
    observation_end="2024-01-21",
    versions=("1.0", "1.1"),
    day_horizons=(3, 7, 14),
    report_horizons=(3, 7),
    experiment_key=EXPERIMENT,
    milestone_level=MILESTONE,
)
RANGE = ReportConfig.attempt_range(**PERIOD, level_min=1, level_max=4)
ALL_LEVELS = ReportConfig.all_levels(**{**PERIOD, "versions": ()})
OTHER_HORIZONS = ALL_LEVELS.with_(day_horizons=(1, 5), report_horizons=(5, 1))
# reports whose days are not those that stage 1 made its folders by
UTC_REPORT = ALL_LEVELS.with_(utc_offset_hours=0)
FAR_EAST = replace(CORRECTION, utc_offset_hours=14)
FAR_WEST_REPORT = ALL_LEVELS.with_(utc_offset_hours=-12)
# fourteen days are observed after its first days
EARLY = RANGE.with_(report_start="2024-01-02")

IDS = (
    "event_id",
    "ts AS event_ts",
    "user_id AS u",
    "CAST(get_json_object(props, '$.k') AS INT) AS k",
    "event_id DIV 20 AS q",
    "event_id % 20 AS r",
    "datediff(to_date(ts + INTERVAL 7 HOURS), DATE'2024-01-01') AS d",
)

FIELDS = (
    "*",
    """CASE WHEN r < 5 THEN 'level_start' WHEN r < 7 THEN 'level_start_turn'
            WHEN r < 9 THEN 'level_end' WHEN r < 12 THEN 'level_end_turn'
            WHEN r < 14 THEN 'spend_virtual_currency' WHEN r < 16 THEN 'paid_ad_impression'
            WHEN r = 16 THEN 'in_app_purchase' WHEN r = 17 THEN 'session_start'
            WHEN r = 18 THEN 'screen_view' WHEN q % 3 = 0 THEN 'app_remove'
            WHEN q % 3 = 1 THEN 'earn_virtual_currency' ELSE 'app_loading' END AS event_name""",
    "1 + (d + u % 5) DIV 5 AS whole_level",
    """CASE WHEN k % 10 = 9 THEN '"sl"' WHEN k % 17 = 16 THEN 'null'
            WHEN k % 13 = 12 THEN '"bonus"' ELSE '"classic"' END AS mode_json""",
)

EVENT_JSON = """concat(
    '{"level":', whole_level,
        CASE WHEN event_id % 29 = 0 THEN '.1' WHEN event_id % 31 = 0 THEN '.2' ELSE '' END,
    ',"mode":', mode_json,
    ',"phase":', CASE WHEN event_id % 7 = 0 THEN 'null' WHEN event_id % 13 = 0 THEN '2'
                      WHEN event_id % 59 = 0 THEN '1.6' ELSE '1' END,
    ',"success":', CASE WHEN q % 2 = 0 THEN 'true' ELSE 'false' END,
    ',"start_count":', CASE WHEN event_id % 19 = 0 THEN 'null' WHEN event_id % 61 = 0 THEN '1.5'
                            ELSE concat('', 1 + k % 4) END,
    ',"continue_times":', CASE WHEN event_id % 5 = 0 THEN 'null' ELSE concat('', k % 3) END,
    ',"completion":', CASE WHEN event_id % 23 = 0 THEN 'null' WHEN event_id % 37 = 0 THEN '110'
                           ELSE concat('', k) END,
    ',"coin":', CASE WHEN event_id % 101 = 0 THEN '2000000' WHEN event_id % 41 = 0 THEN '-5'
                     ELSE concat('', 10 * k) END,
    ',"ticket":', k % 5, ',"booster_x":', k % 3, ',"use_booster_count":', k % 4,
    ',"value":', CASE WHEN event_id % 53 = 0 THEN '400000000' ELSE concat('', k) END,
    ',"currency":"', CASE k % 3 WHEN 0 THEN 'USD' WHEN 1 THEN 'ILS' ELSE 'EUR' END,
    '","value_game_currency":', CASE WHEN event_id % 43 = 0 THEN '-1' ELSE concat('', 5 * k) END,
    ',"virtual_currency_name":"', CASE k % 4 WHEN 0 THEN 'Coin' WHEN 1 THEN 'ticket'
                                             WHEN 2 THEN 'booster_x' ELSE '' END,
    '","virtual_currency_type":"', CASE WHEN k % 4 >= 2 THEN 'booster' ELSE 'currency' END,
    '","ad_format":"', CASE q % 5 WHEN 0 THEN 'interstitial' WHEN 1 THEN 'Rewarded'
                                  WHEN 2 THEN 'banner' WHEN 3 THEN 'native_advanced'
                                  ELSE 'rewarded_interstitial' END, '"}')"""

USER_JSON = """concat(
    '{"level":', whole_level + CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END,
    ',"mode":', mode_json,
    ',"phase":', CASE WHEN event_id % 17 = 0 THEN '2' ELSE '1' END,
    ',"exp_group":"', u % 4, '"}')"""


def derive(events: DataFrame) -> DataFrame:
    """Raw telemetry, one row per source event."""
    return events.selectExpr(*IDS).selectExpr(*FIELDS).selectExpr(
        "event_id",
        "CASE WHEN event_id % 50 = 49 THEN 'app_other' ELSE 'app_main' END AS app_id",
        "CASE WHEN event_id % 97 != 0 THEN concat('u', u) END AS user_pseudo_id",
        "event_ts",
        "event_name",
        f"CASE WHEN event_id % 103 = 0 THEN NULL WHEN event_id % 107 = 0 THEN '{{bad'"
        f" ELSE {EVENT_JSON} END AS event_params",
        f"CASE WHEN event_id % 109 != 0 THEN {USER_JSON} END AS user_properties",
        "concat('1.', u % 3) AS app_version",
        "CASE u % 10 WHEN 0 THEN 'China' WHEN 1 THEN NULL ELSE 'VN' END AS country",
        "CASE WHEN u % 20 = 10 THEN NULL WHEN u % 2 = 0 THEN 'android' ELSE 'ios' END AS platform",
    )


#: Rows of events that a task derives telemetry from, about.
ROWS_A_TASK = 100_000
#: HotSpot compiles methods of up to so many bytes and interprets longer ones, several times slower. The projection
#: above would be one such method; beyond the limit Spark splits it.
METHOD_LIMIT, COMPILED_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"


def spread(events: DataFrame) -> DataFrame:
    """All rows, dealt out evenly: a single row group may hold them, and what is derived of it is many times as long."""
    tasks = -(-events.count() // ROWS_A_TASK)
    return events.repartition(max(tasks, events.sparkSession.sparkContext.defaultParallelism))


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    before = spark.conf.get(METHOD_LIMIT)
    spark.conf.set(METHOD_LIMIT, COMPILED_BYTES)
    try:
        yield
    finally:
        spark.conf.set(METHOD_LIMIT, before)


_written: dict[tuple[str, str, str], str] = {}


def _path(spark: SparkSession, sf_dir: str, table: str, write: Callable[[str], None]) -> str:
    """Where a derived input table lies, after writing it on first use in a session."""
    use_utc(spark)
    key = (spark.sparkContext.applicationId, sf_dir, table)
    if key not in _written:
        path = f"{shared_folder(spark)}/levelscope/{key[0]}/{table}-{uuid.uuid4().hex}"
        write(path)
        _written[key] = path
    return _written[key]


def written(
    spark: SparkSession, sf_dir: str, label: str, write: Callable[[str], None]
) -> str:
    """The path of a table in another form, written once per session."""
    return _path(spark, sf_dir, label, write)


def raw_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw event table: what stage 1 reads."""

    def write(path: str) -> None:
        events = spark.read.parquet(f"{sf_dir}/events.parquet")
        with compiled(spark):
            derive(spread(events)).write.parquet(path)

    return read_raw(spark, _path(spark, sf_dir, "raw", write))


def corrected_path(spark: SparkSession, sf_dir: str, cfg: CorrectionConfig = CORRECTION) -> str:
    def write(path: str) -> None:
        write_corrected(correct_history(raw_table(spark, sf_dir), cfg), path)

    return _path(spark, sf_dir, f"raw_fixed-{cfg.utc_offset_hours}", write)


def corrected_table(spark: SparkSession, sf_dir: str, cfg: CorrectionConfig = CORRECTION) -> DataFrame:
    """The output of stage 1: what stage 2 reads."""
    return read_corrected(spark, corrected_path(spark, sf_dir, cfg))


def corrected_record(spark: SparkSession, sf_dir: str) -> Record | None:
    """What stage 1 has recorded of its output."""
    return table_record(spark, corrected_path(spark, sf_dir))
