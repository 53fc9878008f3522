"""Contiguous shards of near equal bytes by global prefix sums.

Rows are put in the order of (id, text checksum, size) by a range partitioning and written once; the
totals of the partitions, one row each, give every partition the bytes and rows before it, and a
running sum within the partition gives every row its global place. The line of all bytes is cut at
equal targets: a row belongs to the shard that its middle byte falls into, so a shard's bytes differ
from the target by no more than the size of one document. Only ids, checksums and sizes are moved,
never texts, and no step sees all rows in one task.

Null texts have size ``ROW_BYTES`` and the checksum of the empty string; null ids come first. Rows
that are equal in id and text are interchangeable and follow each other. An empty table has no
shards; more shards than documents leave some shards empty. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from levelscope.session import stage

ROW_BYTES = 16
SHARDS = 40


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, size and checksum of each document."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + F.lit(ROW_BYTES)).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )


def shards(rows: DataFrame, count: int = SHARDS) -> DataFrame:
    """Shard and slot of each of the ``measured`` rows."""
    if count < 1:
        raise ValueError("there must be at least one shard")
    order = ["doc_id", "text_crc32", "size"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = stage(
        rows.repartitionByRange(parts, *order).withColumn("part", F.spark_partition_id()),
        "shards",
    )
    # one row per partition: a bounded table, whatever the number of documents
    totals = placed.groupBy("part").agg(F.sum("size").alias("size"), F.count("*").alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("part").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    bases = totals.select(
        "part",
        F.coalesce(F.sum("size").over(before), F.lit(0)).alias("bytes_before"),
        F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("rows_before"),
        F.sum("size").over(everything).alias("total"),
    )
    within = Window.partitionBy("part").orderBy(*order)
    running = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    counted = (
        placed.withColumn("bytes_to", F.sum("size").over(running))
        .withColumn("row", F.row_number().over(within))
        .join(F.broadcast(bases), "part")
        .withColumn("double_middle", 2 * (F.col("bytes_before") + F.col("bytes_to")) - F.col("size"))
        .withColumn(
            "shard", F.expr(f"least({count - 1}, double_middle * {count} div (2 * total))").cast("int")
        )
        .withColumn("place", F.col("rows_before") + F.col("row") - 1)
    )
    # the first place of each shard, from the places at which it begins in each partition
    firsts = counted.groupBy("shard").agg(F.min("place").alias("first"))
    return counted.join(F.broadcast(firsts), "shard").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("place") - F.col("first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
