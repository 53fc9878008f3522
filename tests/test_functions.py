"""Scalar expressions on hand-picked values."""

import pytest
from pyspark.sql import functions as F

from levelscope.functions.game import (
    completion_bucket, first_phase, game_level, is_interstitial, is_rewarded, is_shown_ad,
    local_date, mode_after_cutoff, per,
)
from levelscope.functions.payload import payload_map, payload_text, whole, with_payload_fields
from tests.golden import as_struct, base_rows, frame


def one(spark, values, schema, *columns):
    return [tuple(r) for r in spark.createDataFrame(values, schema).select(*columns).collect()]


def test_game_level(spark):
    cases = [
        ("5", 1, 5.0), ("5", None, 5.0), ("4", 2, 4.2), ("4.1", 1, 4.0), ("4.2", 1, 4.2),
        ("4.2", 3, 4.2), ("3.10", 1, 30.0), ("4.12", 1, 42.0), (".5", 1, 0.5), ("x", 1, None),
        ("x", 2, None), (None, 1, None), (None, 2, None), ("3.0", 2, 3.0),
    ]
    got = one(
        spark, [c[:2] for c in cases], "t string, p int", game_level(F.col("t"), F.col("p"))
    )
    assert [g[0] for g in got] == [c[2] for c in cases]


def test_whole_numbers(spark):
    cases = [("3", 3), ("3.7", 3), ("-3.7", -3), ("", None), ("x", None), (None, None),
             ("3000000000", None), ("12", 12)]
    got = one(spark, [(c[0],) for c in cases], "t string", F.expr(whole("t")))
    assert [g[0] for g in got] == [c[1] for c in cases]
    got = one(spark, [(c[0],) for c in cases], "t string", F.expr(whole("t", rounded=True)))
    assert [g[0] for g in got] == [3, 4, -4, None, None, None, None, 12]
    got = one(spark, [("1.5",), ("1.6",), (" 7 ",), ("1e2",)], "t string", F.expr(whole("t", rounded=True)))
    assert [g[0] for g in got] == [2, 2, 7, 100]
    big = one(spark, [("9007199254740993",)], "t string", F.expr(whole("t", "bigint")))
    assert big == [(9007199254740993,)]


def test_completion_bucket(spark):
    cases = [(-1.0, 0), (0.0, 0), (9.99, 0), (10.0, 1), (50.0, 5), (89.9, 8), (90.0, 9),
             (100.0, 9), (110.0, 9), (float("nan"), 9), (None, None)]
    got = one(spark, [(c[0],) for c in cases], "c double", completion_bucket(F.col("c")))
    assert [g[0] for g in got] == [c[1] for c in cases]


def test_ad_kinds(spark):
    cases = [("interstitial", 1, 0, 1), ("rewarded", 0, 1, 1), ("video", 0, 1, 1),
             ("rewarded_interstitial", 1, 0, 1), ("banner", 0, 0, 0), ("", 0, 0, 0)]
    ad = F.col("a")
    got = one(spark, [(c[0],) for c in cases], "a string", is_interstitial(ad), is_rewarded(ad),
              is_shown_ad(ad))
    assert got == [tuple(bool(x) for x in c[1:]) for c in cases]


def test_phase_cutoff_and_ratio(spark):
    assert one(spark, [(None,), (0,), (1,), (2,)], "p int", first_phase(F.col("p"))) == [
        (True,), (True,), (True,), (False,)
    ]
    mode = mode_after_cutoff(F.col("m"), F.col("t"), F.col("c"), "classic", "sl")
    rows = [("classic", 5, 5), ("classic", 6, 5), ("classic", 6, None), ("bonus", 6, 5), (None, 6, 5)]
    assert one(spark, rows, "m string, t int, c int", mode) == [
        ("classic",), ("sl",), ("classic",), ("bonus",), (None,)
    ]
    assert one(spark, [(1, 4), (1, 0), (None, 4)], "a int, b int", per(F.col("a"), F.col("b"))) == [
        (0.25,), (None,), (None,)
    ]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_local_date(spark, kind):
    rows = [("2026-10-01 16:59:59",), ("2026-10-01 17:00:00",)]
    got = one(spark, rows, "t string", local_date(F.col("t").cast(kind), 7).cast("string"))
    assert got == [("2026-10-01",), ("2026-10-02",)]


def test_payload_forms(spark):
    """Broken, empty and missing JSON give NULL fields and keep the row."""
    rows = [('{"a":"x","n":1.50,"b":true,"z":null}',), ("{bad",), ("",), (None,), ("[1]",)]
    df = spark.createDataFrame(rows, "event_params string")
    got = with_payload_fields(df, "event_params", {"a": "a", "n": "n", "b": "b", "z": "z"})
    assert [tuple(r)[1:] for r in got.collect()] == [("x", "1.5", "true", None)] + [(None,) * 4] * 4
    assert df.select(payload_map(df, "event_params").alias("m")).first()["m"]["n"] == "1.5"


def test_payload_text_turns_structs_into_json(spark):
    structs = as_struct(frame(spark, base_rows()))
    text = payload_text(structs)
    assert dict(text.dtypes)["event_params"] == "string"
    fields = {"level": "level", "success": "success", "completion": "completion"}
    left = with_payload_fields(text, "event_params", fields).select(*fields)
    right = with_payload_fields(structs, "event_params", fields).select(*fields)
    assert left.collect() == right.collect()
