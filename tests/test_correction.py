"""Stage 1: cutoffs, re-labelling, joins and gates."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from levelscope.config import ADDED_COLUMNS, CorrectionConfig
from levelscope.operators.correction import (
    SLOT, attach_cutoffs, busy_users, corrected_events, history_window, may_be_member, member_filter,
    milestone_cutoffs,
)
from levelscope.operators.quality import refuse_null_timestamps, timestamp_audit
from levelscope.plans.correct import correct_history
from levelscope.sources.gates import raw_gate

CFG = CorrectionConfig("app", "2026-04-01 00:00:00", "2026-10-07 00:00:00", experiment_key="exp")
SCHEMA = """app_id string, user_pseudo_id string, event_ts timestamp, event_name string,
  event_params string, user_properties string, extra int"""


def event(user, when, mode="classic", name="level_start", level=5, user_level=None, success=None,
          app="app"):
    mode_text = "null" if mode is None else f'"{mode}"'
    won = "" if success is None else f',"success":{success}'
    params = f'{{"level":{level},"mode":{mode_text}{won}}}'
    state = f'{{"level":{user_level or level},"exp":"1"}}'
    return (app, user, datetime.fromisoformat(when), name, params, state, 7)


def clear(user, when, **changes):
    return event(user, when, **{**dict(name="level_end", level=650, success='"True"'), **changes})


ROWS = [
    clear("u", "2026-05-01 10:00:00"),
    clear("u", "2026-06-01 10:00:00"),
    event("u", "2026-05-01 10:00:00"),  # at the cutoff: unchanged
    event("u", "2026-05-01 10:00:01"),  # after it: fixed
    event("u", "2026-05-02 10:00:00", mode="sl"),
    event("u", "2026-05-02 10:00:00", mode="bonus"),
    event("u", "2026-05-02 10:00:00", mode=None),
    event("v", "2026-05-02 10:00:00"),
    event(None, "2026-05-02 10:00:00"),
    clear(None, "2026-05-01 10:00:00"),  # nobody's clear
    clear("w", "2026-05-01 10:00:00", user_level=649),
    clear("x", "2026-05-01 10:00:00", success="false"),
    clear("y", "2026-05-01 10:00:00", mode="bonus"),
    clear("z", "2026-03-31 16:59:59"),  # before the local start of the history
    event("z", "2026-03-31 17:00:00"),
    event("z", "2026-10-06 16:59:59"),
    event("z", "2026-10-06 17:00:00"),  # after its end
    event("q", "2026-05-02 10:00:00", app="other"),
]


@pytest.fixture(scope="module")
def raw(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def key(row):
    return tuple(str(v) for v in row)


def test_cutoffs(raw):
    got = milestone_cutoffs(history_window(raw, CFG), CFG).collect()
    assert [tuple(r) for r in got] == [("u", datetime(2026, 5, 1, 10))]


def test_correction(raw):
    out = correct_history(raw, CFG)
    assert out.columns == raw.columns + list(ADDED_COLUMNS)
    rows = out.collect()
    assert len(rows) == len(ROWS) - 3
    by_reason = {}
    for r in rows:
        by_reason.setdefault(r["fix_reason"], []).append(r)
    fixed = by_reason["classic_after_clear650"]
    assert sorted(str(r["event_ts"]) for r in fixed) == ["2026-05-01 10:00:01", "2026-06-01 10:00:00"]
    assert all(r["mode_fixed"] == "sl" and r["mode_original"] == "classic" for r in fixed)
    assert len(by_reason["existing_sl"]) == 1
    assert len(by_reason["unchanged"]) == 4  # the clear itself, same instant, bonus, no mode
    assert all(r["is_mode_fixed"] is False for r in rows if r not in fixed)
    assert all(r["extra"] == 7 and r["ab_group"] == "1" for r in rows)
    days = {str(r["event_ts"]): str(r["analysis_date_utc7"]) for r in rows}
    assert days["2026-03-31 17:00:00"] == "2026-04-01"
    assert days["2026-10-06 16:59:59"] == "2026-10-06"


def many_events(spark, users, hot_share=0.0, rows=60_000):
    """Events of ``users`` users and, as a share of the rows, of one more; every 20th row has none."""
    place = F.col("id") % 100
    user = F.when(F.col("id") % 20 == 19, F.lit(None)).when(
        F.pmod(F.xxhash64("id"), F.lit(100)) < 100 * hot_share, F.lit("hot")
    ).otherwise(F.concat(F.lit("u"), F.pmod(F.xxhash64(F.lit(7), "id"), F.lit(users))))
    return spark.range(rows).select(
        F.lit("app").alias("app_id"),
        user.alias("user_pseudo_id"),
        (F.lit("2026-05-01 09:00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("id"))).alias("event_ts"),
        F.lit("level_start").alias("event_name"),
        F.lit('{"mode":"classic"}').alias("event_params"),
        F.lit('{"exp":"1"}').alias("user_properties"),
        place.cast("int").alias("extra"),
    )


def cutoffs_of(spark, users, more=()):
    some = spark.range(users).select(
        F.concat(F.lit("u"), "id").alias("user_pseudo_id"),
        F.lit("2026-05-01 12:00:00").cast("timestamp").alias("first_clear_650_ts"),
    )
    return some.union(spark.createDataFrame([(u, datetime(2026, 5, 1, 10)) for u in more], some.schema))


@pytest.mark.parametrize("slots", [1 << 12, 1 << 5])  # the second is too full to be used
def test_shuffled_join_equals_broadcast(spark, slots):
    """A user with a third of the rows, members, others and rows without a user, through both joins."""
    events = many_events(spark, 3000, 1 / 3)
    cutoffs = cutoffs_of(spark, 600, ["hot"])
    near = attach_cutoffs(events, cutoffs)
    far = attach_cutoffs(events, cutoffs, broadcast_bytes=-1, busy_share=0.01, filter_slots=slots)
    left = corrected_events(events, near, CFG).collect()
    right = corrected_events(events, far, CFG).collect()
    assert sorted(left, key=key) == sorted(right, key=key)
    assert len(left) == events.count()


def shuffled(df):
    """Rows that each reducing task of the join on users reads, as the finished plan counts them."""
    plan = df._jdf.queryExecution().executedPlan()
    counts, todo = [], [plan]
    while todo:
        node = todo.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStage"):
            todo.append(node.plan())
            continue
        if name == "Exchange" and "user_pseudo_id" in node.outputPartitioning().toString():
            counts.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return counts


def test_only_members_are_shuffled(spark):
    """Of 60,000 events those of the members move, and few others; none of a busy user."""
    events = many_events(spark, 3000, 1 / 3)
    cutoffs = cutoffs_of(spark, 60, ["hot"])
    members = cutoffs.where("user_pseudo_id != 'hot'")
    moving = events.join(members, "user_pseudo_id", "left_semi").count()
    far = attach_cutoffs(events, cutoffs, broadcast_bytes=-1, busy_share=0.01)
    asked = far.select("event_ts", "first_clear_650_ts", "extra")
    assert len(asked.collect()) == 60_000
    counts = shuffled(asked)
    assert moving <= max(counts) <= 1.1 * moving + 100


def test_a_busy_user_makes_no_long_task(spark):
    """A third of the rows are one member's: the join's tasks stay even, without skew handling."""
    events = many_events(spark, 3000, 1 / 3)
    cutoffs = cutoffs_of(spark, 3000, ["hot"])
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        far = attach_cutoffs(events, cutoffs, broadcast_bytes=-1, busy_share=0.01)
        sizes = [r["count"] for r in far.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
    assert sum(sizes) == events.count()
    assert max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2]


def test_busy_users_are_found(spark):
    events = many_events(spark, 3000, 0.2).union(many_events(spark, 10, rows=2000))
    known = events.where("user_pseudo_id is not null")
    total = known.count()
    exact = {r[0] for r in known.groupBy("user_pseudo_id").count().where(f"count >= {0.002 * total}").collect()}
    found = {r.user for r in busy_users(events, 0.002).collect()}
    assert {"hot", "u1"} <= exact <= found and len(found) <= 500
    assert busy_users(events.limit(0), 0.002).collect() == []


def test_the_filter_knows_every_member(spark):
    cutoffs = cutoffs_of(spark, 4000, ["", "ü"])
    bloom = member_filter(cutoffs, 1024)
    assert bloom.count() <= 1024
    asked = cutoffs.select("user_pseudo_id", F.lit(True).alias("member")).union(
        spark.range(20_000).select(F.concat(F.lit("other"), "id"), F.lit(False))
    )
    slot = F.pmod(F.xxhash64("user_pseudo_id"), F.lit(1024))
    said = asked.withColumn(SLOT, slot).join(bloom, SLOT, "left").withColumn("may", may_be_member())
    rate = {r.member: r.rate for r in said.groupBy("member").agg(F.avg(F.col("may").cast("int")).alias("rate")).collect()}
    assert rate[True] == 1.0 and rate[False] < 0.06


def test_text_timestamps_and_payload_forms(spark, raw):
    want = sorted((key(r) for r in correct_history(raw, CFG).drop(
        "event_ts", "event_params", "user_properties").collect()))
    text_map = "map<string,string>"
    maps = raw.withColumn("event_params", F.from_json("event_params", text_map)).withColumn(
        "user_properties", F.from_json("user_properties", text_map))
    structs = raw.withColumn(
        "event_params", F.from_json("event_params", "level bigint, mode string, success string")
    ).withColumn("user_properties", F.from_json("user_properties", "level bigint, exp string"))
    text = raw.withColumn("event_ts", F.col("event_ts").cast("string"))
    for form in (maps, structs, text):
        out = correct_history(form, CFG).drop("event_ts", "event_params", "user_properties")
        assert sorted(key(r) for r in out.collect()) == want


def test_gates(spark, raw):
    with pytest.raises(ValueError, match="missing columns: event_name"):
        raw_gate(raw.drop("event_name"))
    with pytest.raises(ValueError, match="already corrected"):
        raw_gate(raw.withColumn("mode_fixed", F.lit("x")))
    with pytest.raises(ValueError, match="timestamp"):
        raw_gate(raw.withColumn("event_ts", F.unix_timestamp("event_ts")))
    pairs = F.array(F.struct(F.lit("level").alias("key"), F.lit("1").alias("value")))
    with pytest.raises(ValueError, match="key/value"):
        raw_gate(raw.withColumn("event_params", pairs))
    with pytest.raises(ValueError, match="history_start"):
        CorrectionConfig("app", "2026-04-02", "2026-04-01")


def test_null_timestamps_stop_the_run(spark, raw):
    bad = raw.union(spark.createDataFrame([("app", "u", None, "x", "{}", "{}", 1)], SCHEMA))
    with pytest.raises(ValueError, match="event_ts"):
        refuse_null_timestamps(bad, CFG)
    assert refuse_null_timestamps(raw, CFG) is raw
    text = raw.withColumn("event_ts", F.lit("soon"))
    with pytest.raises(ValueError, match="event_ts"):
        refuse_null_timestamps(text, CFG)
    audit = timestamp_audit(bad, "app").first()
    assert (audit["rows"], audit["invalid_timestamps"]) == (len(ROWS), 1)


def test_both_stages_read_json_alike(spark, raw):
    """Keys are literal, and of a repeated key the last counts."""
    twice = '{"mode":"bonus","mode":"classic","level":5}'
    rows = raw.withColumn("event_params", F.lit(twice))
    got = correct_history(rows, CFG).select("mode_original").distinct().collect()
    assert [r[0] for r in got] == ["classic"]


def test_bad_timestamps_stop_the_plan_as_well(spark, raw):
    bad = raw.union(spark.createDataFrame([("app", "u", None, "x", "{}", "{}", 1)], SCHEMA))
    with pytest.raises(ValueError, match="event_ts"):
        correct_history(bad, CFG)
