"""The registered queries: one per operator, over the derived telemetry."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.telemetry import (
    ALL_LEVELS, CORRECTION, EARLY, FAR_EAST, FAR_WEST_REPORT, OTHER_HORIZONS, RANGE, UTC_REPORT,
    corrected_record, corrected_table, raw_table, written,
)
from levelscope.config import USER, CorrectionConfig, ReportConfig
from levelscope.functions.game import is_interstitial, is_rewarded
from levelscope.functions.payload import parsed_payloads, payload_text
from levelscope.operators import economy, funnel, loss, quality, retention
from levelscope.operators.correction import history_window, milestone_cutoffs
from levelscope.operators.filters import system_clean
from levelscope.operators.normalize import normalize, parse_fields
from levelscope.plans import facts
from levelscope.plans.correct import correct_history
from levelscope.plans.increment import increment
from levelscope.plans.reports import (
    ReportInput,
    clean_events,
    levelplay_report,
    loss_report,
    prepare,
)
from levelscope.sources.gates import raw_gate
from levelscope.sources.readers import read_corrected, read_raw
from levelscope.sources.records import table_record
from levelscope.sources.sinks import NOT_AVAILABLE, write_corrected, write_cutoffs, write_report_csv
from levelscope.sources.staging import app_events, report_window

Query = Callable[[SparkSession, str], DataFrame]

TYPED_COLUMNS = (
    "event_name", USER, "variant", "raw_level", "property_level", "event_phase", "property_phase",
    "property_mode", "success", "attempt", "continues", "completion", "used_boosters",
    "currency_value", "game_currency_value", "currency_name", "currency_type", "ad_format",
    "start_coin", "purchase_currency",
)


def events_and_users(df: DataFrame, *keys: str) -> DataFrame:
    """Events and distinct users per group, by way of one row per group and user."""
    return (
        df.groupBy(*keys, USER)
        .agg(F.count("*").alias("n"))
        .groupBy(*keys)
        .agg(F.sum("n").alias("events"), F.count(USER).alias("users"))
    )


def _correction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return correct_history(raw_table(spark, sf_dir), CORRECTION)


def _window(spark: SparkSession, sf_dir: str, cfg: ReportConfig) -> DataFrame:
    return report_window(corrected_table(spark, sf_dir), cfg)


def in_two_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage 1 on some of the events, and then on the rest: later ones, and late ones of earlier days."""
    raw = raw_table(spark, sf_dir)
    late = (F.col("event_ts") >= "2024-01-12") | (F.col("event_id") % 7 == 3)

    def write_first(path: str) -> None:
        events = raw.where(~late)
        cutoffs = milestone_cutoffs(history_window(events, CORRECTION), CORRECTION)
        write_cutoffs(cutoffs, f"{path}/cutoffs")
        known = spark.read.parquet(f"{path}/cutoffs")
        write_corrected(correct_history(events, CORRECTION, known), f"{path}/fixed")

    first = written(spark, sf_dir, "first-increment", write_first)
    fixed, cutoffs = read_corrected(spark, f"{first}/fixed"), spark.read.parquet(f"{first}/cutoffs")
    change = increment(fixed, cutoffs, raw.where(late), CORRECTION)
    untouched = fixed.where(~F.col("analysis_date_utc7").isin(*change.touched))
    return untouched.unionByName(change.days).select(
        "event_id", USER, "event_name", "event_ts", "mode_original", "mode_fixed", "is_mode_fixed",
        "first_clear_650_ts", "fix_reason", "analysis_date_utc7", "ab_group",
    )


RAW_COLUMNS = ("event_id", USER, "event_name", "event_params", "user_properties", "country")
CSV_WRITE = {"header": "true", "quote": '"', "escape": '"'}


def raw_from(fmt: str) -> Query:
    """The raw events, read back from another file format."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        def write(path: str) -> None:
            options = CSV_WRITE if fmt == "csv" else {}
            raw_table(spark, sf_dir).write.format(fmt).options(**options).save(path)

        path = written(spark, sf_dir, f"raw-{fmt}", write)
        events = raw_gate(read_raw(spark, path, fmt))
        return events.select(F.col("event_id").cast("long"), *RAW_COLUMNS[1:])

    return query


def cutoffs_of(change: Callable[[DataFrame], DataFrame]) -> Query:
    """Stage 1 over raw events in another form."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = raw_gate(change(raw_table(spark, sf_dir)))
        return milestone_cutoffs(history_window(events, CORRECTION), CORRECTION)

    return query


def text_time(raw: DataFrame) -> DataFrame:
    return raw.withColumn("event_ts", F.col("event_ts").cast("string"))


def payload_as(event: str, user: str) -> Callable[[DataFrame], DataFrame]:
    return lambda raw: raw.withColumns(
        {"event_params": F.from_json("event_params", event), "user_properties": F.from_json("user_properties", user)}
    )


AS_MAPS = payload_as("map<string,string>", "map<string,string>")
AS_STRUCTS = payload_as(
    "level double, mode string, phase double, success string", "level double, mode string, exp_group string"
)


def as_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage 1 over payloads that were parsed before."""
    return cutoffs_of(parsed_payloads)(spark, sf_dir)


def over_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stage 2 over a table with parsed payloads, clustered by kind of event and user."""

    def write(path: str) -> None:
        corrected = correct_history(raw_table(spark, sf_dir), CORRECTION)
        write_corrected(parsed_payloads(corrected), path, cluster=True)

    path = written(spark, sf_dir, "variants", write)
    data = prepare(read_corrected(spark, path), ALL_LEVELS, record=table_record(spark, path))
    return levelplay_report(data)


def text_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map payloads, unified to JSON text, and read again."""
    return cutoffs_of(lambda raw: payload_text(AS_MAPS(raw)))(spark, sf_dir)


def union_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of which every other one lacks a column."""

    def write(path: str) -> None:
        events = corrected_table(spark, sf_dir)
        even = F.col("event_id") % 2 == 0
        events.where(even).drop("country").write.parquet(f"{path}/half=0")
        events.where(~even).write.parquet(f"{path}/half=1")

    events = read_corrected(spark, written(spark, sf_dir, "halves", write))
    return events.select("event_id", "event_name", "country")


def cutoff_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cutoff output of stage 1, read back."""

    def write(path: str) -> None:
        write_cutoffs(cutoffs_of(lambda raw: raw)(spark, sf_dir), path)

    return spark.read.parquet(written(spark, sf_dir, "cutoff-table", write))


def report_csv(cfg: ReportConfig) -> Query:
    """The level report as the exported CSV file has it."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        def write(path: str) -> None:
            write_report_csv(levelplay_report(_staged(spark, sf_dir, cfg)), path, null_value=NOT_AVAILABLE)

        path = written(spark, sf_dir, "report-csv", write)
        table = spark.read.csv(path, header=True, nullValue=NOT_AVAILABLE)
        numbers = [F.col(c).cast("double") for c in table.columns if c not in ("ab_group", "user_start_count")]
        return table.select("ab_group", F.col("user_start_count").cast("long"), *numbers)

    return query


def both_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End to end: one staging of the window, the level report, both loss reports, in one long table."""
    data = _staged(spark, sf_dir, ALL_LEVELS)
    level = levelplay_report(data).select(
        F.lit("level").alias("report"), "ab_group", "level", F.col("user_start_count").alias("users"),
        F.col("churn_rate_d3_pct").alias("rate"),
    )
    loss = loss_report(data).select(
        F.col("loss_kind").alias("report"), "ab_group", "level", F.col("user_count").alias("users"),
        F.col("churn_rate_d3_pct").alias("rate"),
    )
    return level.unionByName(loss)


def _events_of_window(
    spark: SparkSession, sf_dir: str, cfg: ReportConfig, made_by: CorrectionConfig = CORRECTION
) -> DataFrame:
    """Rows of the window, found again in the corrected events by all that identifies them."""
    events = corrected_table(spark, sf_dir, made_by)
    keys = ["app_id", USER, "event_ts", "event_name", "event_params", "user_properties"]
    found = report_window(events, cfg).select(*keys).distinct()
    same = [events[k].eqNullSafe(found[k]) for k in keys]
    return events.join(found, reduce(and_, same), "left_semi").select("event_id", "event_ts")


def _damaged(raw: DataFrame) -> DataFrame:
    """Text timestamps, some of them unreadable."""
    text = F.when(F.col("event_id") % 71 == 0, "soon").otherwise(F.col("event_ts").cast("string"))
    return raw.withColumn("event_ts", text)


def _not_relabelled(events: DataFrame) -> DataFrame:
    """Corrected events as a stage 1 would leave them that misses the second half of each hour: the mode
    is the original one, here and there written twice in the payload."""
    missed = F.minute("event_ts") >= 30
    first_mode = F.expr("""concat('{"mode":"bonus",', substring(event_params, 2))""")
    return events.withColumns(
        {
            "mode_fixed": F.when(
                missed & (F.col("mode_fixed") == CORRECTION.mode_after), F.get_json_object("event_params", "$.mode")
            ).otherwise(F.col("mode_fixed")),
            "event_params": F.when(F.minute("event_ts") % 2 == 0, first_mode).otherwise(F.col("event_params")),
        }
    )


def _parsed(spark: SparkSession, sf_dir: str, cfg: ReportConfig) -> DataFrame:
    return parse_fields(_window(spark, sf_dir, cfg), cfg)


def _app(spark: SparkSession, sf_dir: str) -> DataFrame:
    return app_events(corrected_table(spark, sf_dir), ALL_LEVELS)


def _input(spark: SparkSession, sf_dir: str, cfg: ReportConfig) -> ReportInput:
    return ReportInput(clean_events(_window(spark, sf_dir, cfg), cfg), cfg)


def _staged(spark: SparkSession, sf_dir: str, cfg: ReportConfig, every_event: bool = False):
    record = corrected_record(spark, sf_dir)
    return prepare(corrected_table(spark, sf_dir), cfg, every_event, record)


def over(
    cfg: ReportConfig, operator: Callable[[ReportInput], DataFrame], every_event: bool = False
) -> Query:
    """A single operator over the window, which is decoded and staged once."""
    return lambda spark, sf_dir: operator(_staged(spark, sf_dir, cfg, every_event))


def over_scan(cfg: ReportConfig, operator: Callable[[ReportInput], DataFrame]) -> Query:
    """An operator that needs whole payloads, over one scan of the window."""
    return lambda spark, sf_dir: operator(_input(spark, sf_dir, cfg))


def stored_facts(spark: SparkSession, sf_dir: str, cfg: ReportConfig) -> facts.Facts:
    """Day by day facts of the whole history, written in two turns, the second one with a day of the first again."""

    def write(path: str) -> None:
        for first, last in ((date(2023, 12, 31), date(2024, 1, 14)), (date(2024, 1, 14), date(2024, 2, 20))):
            days = cfg.with_(report_start=first, report_end=last, observation_end=last, strict_dates=False)
            data = prepare(corrected_table(spark, sf_dir), days, record=corrected_record(spark, sf_dir))
            facts.write_facts(facts.daily_facts(data.clean, cfg, first, last), path, cfg)

    path = written(spark, sf_dir, f"facts-{facts.facts_key(cfg)}", write)
    return facts.read_facts(spark, path, cfg)


def from_facts(cfg: ReportConfig, build: Callable[[facts.Facts], DataFrame]) -> Query:
    """A report over the stored facts, kept together by user."""
    return lambda spark, sf_dir: build(facts.by_user(stored_facts(spark, sf_dir, cfg)))


def report(cfg: ReportConfig, build: Callable[[ReportInput], DataFrame]) -> Query:
    """A report over the staged window."""
    return lambda spark, sf_dir: build(_staged(spark, sf_dir, cfg))


def starters(data: ReportInput) -> DataFrame:
    return funnel.level_starters(data.cohort, data.cfg)


def removers(data: ReportInput) -> DataFrame:
    return funnel.app_removers(data.clean, data.cfg)


def ad_formats(data: ReportInput) -> DataFrame:
    ads = data.metric.where(F.col("event_name") == "paid_ad_impression")
    counted = events_and_users(ads, "ad_format").withColumnRenamed("events", "impressions")
    return counted.select(
        "ad_format",
        is_interstitial(F.col("ad_format")).alias("interstitial"),
        is_rewarded(F.col("ad_format")).alias("rewarded"),
        "impressions",
        "users",
    )


def non_return(n: int) -> Callable[[ReportInput], DataFrame]:
    return lambda d: (
        retention.non_return(d.metric, d.days, d.cfg).where(F.col("n") == n).drop("n")
    )


def loss_counts(data: ReportInput) -> DataFrame:
    return events_and_users(
        loss.lost_turns(data.cohort, data.metric, data.cfg).where(F.col("attempt") == 1),
        "variant", "level", "bucket",
    )


def loss_kind_counts(data: ReportInput) -> DataFrame:
    kinds = loss.loss_kinds(loss.lost_turns(data.cohort, data.metric, data.cfg))
    return events_and_users(kinds, "loss_kind", "variant", "level", "bucket")


def queries() -> dict[str, Query]:
    a, c = RANGE, ALL_LEVELS
    return {
        # stage 1
        "mode_cutoffs": lambda s, d: milestone_cutoffs(
            history_window(raw_table(s, d), CORRECTION), CORRECTION
        ),
        "mode_correction": lambda s, d: _correction(s, d).select(
            "event_id", USER, "event_name", "event_ts", "mode_original", "mode_fixed",
            "is_mode_fixed", "first_clear_650_ts", "fix_reason", "analysis_date_utc7", "ab_group",
        ),
        "mode_correction_shuffled": lambda s, d: correct_history(
            raw_table(s, d), replace(CORRECTION, broadcast_bytes=-1, busy_share=0.02)
        ).select(
            "event_id", USER, "event_name", "event_ts", "mode_fixed", "first_clear_650_ts"
        ),
        "window_other_offset": lambda s, d: _events_of_window(s, d, UTC_REPORT),
        "window_far_offset": lambda s, d: _events_of_window(s, d, FAR_WEST_REPORT, FAR_EAST),
        "mode_correction_increments": in_two_increments,
        "fix_reason_counts": lambda s, d: events_and_users(
            _correction(s, d), "fix_reason", "analysis_date_utc7"
        ),
        # sources, payload forms and sinks
        "raw_from_csv": raw_from("csv"),
        "raw_from_json": raw_from("json"),
        "raw_from_orc": raw_from("orc"),
        "cutoffs_of_text_time": cutoffs_of(text_time),
        "cutoffs_of_maps": cutoffs_of(AS_MAPS),
        "cutoffs_of_structs": cutoffs_of(AS_STRUCTS),
        "cutoffs_of_unified_text": text_again,
        "cutoffs_of_variants": as_variants,
        "levelplay_report_of_variants": over_variants,
        "corrected_union_by_name": union_by_name,
        "cutoff_table": cutoff_table,
        "levelplay_report_csv": report_csv(c),
        # normalisation and filters
        "parse_fields_cut": lambda s, d: _parsed(s, d, a).select(*TYPED_COLUMNS),
        "parse_fields": lambda s, d: _parsed(s, d, c).select(*TYPED_COLUMNS),
        "level_normalize": lambda s, d: normalize(_parsed(s, d, c), c)
        .groupBy(
            "event_name", "raw_level", "event_phase", "property_level", "property_phase",
            "property_bi_level", "level",
        )
        .agg(F.count("*").alias("events")),
        "source_level_mode": lambda s, d: normalize(_parsed(s, d, a), a)
        .groupBy("event_name", "local_date", "level", "property_mode_fixed", "metric_mode")
        .agg(F.count("*").alias("events")),
        "system_filters": lambda s, d: events_and_users(
            system_clean(normalize(_parsed(s, d, c), c), c), "event_name", "local_date"
        ),
        "cohort_filter": over(
            a, lambda d: events_and_users(d.cohort, "variant", "event_name", "local_date"), True
        ),
        "metric_filter": over_scan(
            a, lambda d: events_and_users(d.metric, "variant", "level", "event_name")
        ),
        # funnel
        "level_starters": over(a, starters),
        "start_counts": over(a, lambda d: funnel.start_counts(starters(d), d.cfg)),
        "next_level_drop": over(a, lambda d: funnel.next_level_drop(starters(d), d.cfg)),
        "remove_counts": over(
            a, lambda d: funnel.remove_counts(starters(d), removers(d), d.cfg)
        ),
        "churn_components": over(
            a, lambda d: funnel.churn_components(starters(d), removers(d), d.cfg)
        ),
        "ads_denominator_property": over(a, lambda d: funnel.ads_denominator(d.clean, d.cfg)),
        "ads_denominator_phase": over(c, lambda d: funnel.ads_denominator(d.clean, d.cfg)),
        # economy
        "level_stats": over(a, lambda d: economy.level_stats(d.metric, d.cfg)),
        "ad_formats": over(c, ad_formats),
        "payers": over(a, lambda d: economy.payers(d.metric)),
        "attempts_per_success": over(a, lambda d: economy.attempts_per_success(d.metric)),
        "balance_starters": over(a, lambda d: economy.balance_starters(d.metric)),
        "resource_unpivot": over_scan(a, lambda d: economy.resource_rows(d.metric)),
        "balance_sums": over(a, lambda d: economy.balance_sums(d.metric)),
        # retention
        "maturity_windows": lambda s, d: retention.maturity_windows(
            quality.coverage(_app(s, d), a), a
        ),
        "mature_cohort": over(a, lambda d: retention.mature_cohort(d.metric, d.cfg)),
        "daily_sessions": over(a, lambda d: retention.daily_sessions(d.clean, d.cfg)),
        "last_level_per_day": over(a, lambda d: retention.last_level_per_day(d.metric)),
        "non_return_d3": over(a, non_return(3)),
        "non_return_d7": over(a, non_return(7)),
        "non_return_censored": over(a, non_return(14)),
        "non_return_d14": over(EARLY, non_return(14)),
        "play_days": over(a, lambda d: d.days),
        "latest_start": over(a, lambda d: retention.latest_start(d.days).drop("next_session")),
        "incomplete_churn_last_start": over(
            a, lambda d: retention.incomplete_churn(d.clean, d.metric, d.days, d.cfg)
        ),
        "incomplete_churn_every_day": over(
            c, lambda d: retention.incomplete_churn(d.clean, d.metric, d.days, d.cfg)
        ),
        # losses
        "loss_first": over(a, loss_counts),
        "loss_all": over(c, loss_kind_counts),
        "loss_distribution": over(
            c, lambda d: loss.loss_distribution(loss.lost_turns(d.cohort, d.metric, d.cfg))
        ),
        # reports
        "loss_report_first": report(a, lambda d: loss_report(d, "first")),
        "loss_report_all": report(a, lambda d: loss_report(d, "all")),
        "loss_report_all_levels": report(c, loss_report),
        "levelplay_report_range": report(a, levelplay_report),
        "levelplay_report_all_levels": report(c, levelplay_report),
        "levelplay_report_other_horizons": report(OTHER_HORIZONS, levelplay_report),
        "levelplay_report_event_base": report(
            c.with_(ads_denominator="event"), levelplay_report
        ),
        "both_reports": both_reports,
        "levelplay_report_from_facts": from_facts(c, facts.levelplay_from),
        "levelplay_range_from_facts": from_facts(a, facts.levelplay_from),
        "loss_report_from_facts": from_facts(c, facts.loss_from),
        "loss_report_first_from_facts": from_facts(a, lambda f: facts.loss_from(f, "first")),
        # audits
        "qa_timestamps": lambda s, d: quality.timestamp_audit(
            raw_table(s, d), CORRECTION.app_id
        ),
        "qa_text_timestamps": lambda s, d: quality.timestamp_audit(
            _damaged(raw_table(s, d)), CORRECTION.app_id
        ),
        "qa_coverage": lambda s, d: quality.coverage(_app(s, d), c),
        "qa_mode_consistency": lambda s, d: quality.mode_consistency(_app(s, d), c),
        "qa_kept_modes": lambda s, d: quality.mode_consistency(_not_relabelled(_app(s, d)), c),
        "qa_missing_cutoff": over(a, lambda d: quality.missing_cutoffs(d.cohort, d.cfg), True),
        "input_profile": lambda s, d: quality.input_profile(_window(s, d, c), c),
    }
