"""Clustered day files and parsed payloads."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from levelscope.config import REPORT_EVENTS, USER
from levelscope.functions.payload import parsed_payloads, payload_field, payload_map
from levelscope.jobs import correct, report
from levelscope.plans.reports import levelplay_report, loss_report, prepare
from levelscope.sources.readers import read_corrected
from levelscope.sources.sinks import write_corrected
from levelscope.sources.staging import only_report_events
from tests.golden import ALL, PERIOD, RANGE, base_rows, collected, frame, unreadable_rows

DAY = "analysis_date_utc7"
KINDS = (*REPORT_EVENTS, *[f"{word}_other" for word in ("app", "banner", "level", "paid", "quest", "screen", "zoom")])


@pytest.fixture(scope="module")
def clustered(spark, tmp_path_factory):
    """Three days of events of many kinds, in no order; a third of a day's are of one kind."""
    kind = F.when(F.col("id") % 3 == 0, "zoom_other").otherwise(
        F.element_at(F.array(*map(F.lit, KINDS)), (F.pmod(F.xxhash64("id"), F.lit(len(KINDS))) + 1).cast("int"))
    )
    rows = spark.range(120_000).select(
        F.lit("app").alias("app_id"),
        F.concat(F.lit("user"), F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(40_000)) * 2).alias(USER),
        (F.lit("2026-03-09 00:00:00").cast("timestamp") + F.make_dt_interval(secs=F.col("id") * 2)).alias("event_ts"),
        kind.alias("event_name"),
        F.sha2(F.col("id").cast("string"), 512).alias("event_params"),
    )
    rows = rows.withColumn(DAY, F.to_date("event_ts"))
    top = tmp_path_factory.mktemp("layout")
    write_corrected(rows.repartition(8), f"{top}/plain")
    write_corrected(rows.repartition(8), f"{top}/clustered", cluster=True, row_group_bytes=1 << 20)
    return top


def scanned(df):
    """Rows that the scans of a finished query gave out, row groups and pages being all they can leave out."""
    df.collect()
    total, todo = 0, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        if node.nodeName() == "AdaptiveSparkPlan":
            todo.append(node.executedPlan())
        elif node.nodeName().endswith("QueryStage"):
            todo.append(node.plan())
        elif node.nodeName().startswith("Scan parquet"):
            total += node.metrics().apply("numOutputRows").value()
        else:
            children = node.children()
            todo += [children.apply(i) for i in range(children.size())]
    return total


def test_other_kinds_are_not_scanned(spark, clustered):
    plain = only_report_events(read_corrected(spark, f"{clustered}/plain")).select("event_params")
    grouped = only_report_events(read_corrected(spark, f"{clustered}/clustered")).select("event_params")
    wanted = grouped.count()
    assert scanned(plain) == 120_000
    # whole row groups and pages of other kinds; those at the seams of two kinds are read
    assert wanted <= scanned(grouped) <= 80_000


def test_one_user_is_found_without_scanning_the_rest(spark, clustered):
    events = read_corrected(spark, f"{clustered}/clustered")
    found = events.where(F.col(USER) == "user400").select("event_params")
    assert 0 < found.count() < 12 and scanned(found) < 60_000  # a few row groups
    # such a user is within the bounds of every file: only the filter tells that there is none
    assert scanned(events.where(F.col(USER) == "user401").select("event_params")) < 20_000


def test_files_are_sorted_and_hold_one_day(spark, clustered):
    files = sorted(Path(clustered, "clustered").glob(f"{DAY}=*/*.parquet"))
    assert len({f.parent for f in files}) == 3
    for file in files:
        rows = pq.read_table(file, columns=["event_name", USER], partitioning=None).to_pylist()
        keys = [(r["event_name"], r[USER]) for r in rows]
        assert keys == sorted(keys)
    assert read_corrected(spark, f"{clustered}/clustered").count() == 120_000


def reports(events, cfg):
    data = prepare(events, cfg)
    return collected(levelplay_report(data)), collected(loss_report(data), ("loss_kind", "ab_group", "level"))


@pytest.mark.parametrize("cfg", [ALL, RANGE])
def test_parsed_payloads_give_the_same_reports(spark, tmp_path, cfg):
    text = frame(spark, base_rows() + unreadable_rows()[::5])
    write_corrected(parsed_payloads(text).withColumn(DAY, F.to_date("event_ts")), str(tmp_path / "fixed"), cluster=True)
    parsed = read_corrected(spark, str(tmp_path / "fixed"))
    assert dict(parsed.dtypes)["event_params"] == "variant"
    assert reports(parsed, cfg) == reports(text, cfg)


def test_fields_of_variants(spark):
    """What they have in common with JSON text, and where they differ."""
    texts = ['{"a.b":1,"a":{"b":2}}', '{"x":4.10}', '{"x":true}', '{"x":null}', "{", "[1]", '{"x":[1,{"y":2}]}', None, '{"x\\"":3}']
    df = spark.createDataFrame([(i, t, t) for i, t in enumerate(texts)], "i int, event_params string, user_properties string")
    var = parsed_payloads(df)
    for key in ("a.b", "a", "x", "b", 'x"'):
        old, new = (
            {r.i: r.v for r in d.select("i", payload_field(d, "event_params", key).alias("v")).collect()} for d in (df, var)
        )
        assert old == new, key
    maps = [{r.i: r.m for r in d.select("i", payload_map(d, "event_params").alias("m")).collect()} for d in (df, var)]
    assert maps[1][2] == maps[0][2] == {"x": "true"} and maps[1][7] is None
    twice = spark.createDataFrame([('{"x":1,"x":2}', "{}")], "event_params string, user_properties string")
    assert payload_value(twice) == "2" and payload_value(parsed_payloads(twice)) is None


def payload_value(df):
    return df.select(payload_field(df, "event_params", "x")).first()[0]


def test_the_jobs_with_parsed_payloads(spark, tmp_path):
    raw = frame(spark, base_rows()).drop("mode_fixed", "first_clear_650_ts")
    raw.write.parquet(str(tmp_path / "raw"))
    settings = {
        "source": {"path": str(tmp_path / "raw")}, "output_path": str(tmp_path / "out"),
        "payloads": "variant", "cluster": True,
        "correction": dict(app_id="harbour", history_start="2026-01-01", history_end="2026-04-01", experiment_key="arm"),
    }
    fixed = correct.run(spark, settings)
    assert dict(read_corrected(spark, fixed).dtypes)["user_properties"] == "variant"
    paths = report.run(spark, fixed, str(tmp_path / "reports"), {"preset": "all_levels", **PERIOD})
    assert spark.read.csv(paths["levelplay_report"], header=True).count() > 0
    with pytest.raises(ValueError, match="payloads must be"):
        correct.run(spark, settings | {"payloads": "xml", "output_path": str(tmp_path / "other")})
