"""The raw input of stage 1 at size: derived by all cores, whatever the layout of the source."""

from pyspark.sql import functions as F

from checks.telemetry import METHOD_LIMIT, derive, raw_table


def test_one_row_group_is_derived_by_several_tasks(spark, tmp_path):
    rows = spark.range(4000).select(
        F.col("id").alias("event_id"),
        F.expr("timestamp'2024-01-05' + make_interval(0, 0, 0, 0, 0, id % 500)").alias("ts"),
        F.when(F.col("id") % 9 != 0, F.col("id") % 40).alias("user_id"),
        F.format_string('{"k": %d}', F.col("id") % 100).alias("props"),
    )
    rows = rows.union(rows.where("event_id < 50"))  # repeated rows stay repeated
    rows.coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    before = spark.conf.get(METHOD_LIMIT)
    raw = raw_table(spark, str(tmp_path))
    assert spark.conf.get(METHOD_LIMIT) == before
    files = [r["count"] for r in raw.groupBy(F.input_file_name()).count().collect()]
    assert len(files) >= spark.sparkContext.defaultParallelism
    assert max(files) <= 2 * 4050 / len(files)
    plain = derive(spark.read.parquet(f"{tmp_path}/events.parquet"))
    assert raw.count() == 4050
    assert raw.exceptAll(plain).isEmpty() and plain.exceptAll(raw).isEmpty()
