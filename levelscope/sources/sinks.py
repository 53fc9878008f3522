"""Writers. Nothing is overwritten unless asked for, see ``session.published``."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation

from levelscope.config import USER
from levelscope.sources.gates import refuse_identity, refuse_over_cap
from levelscope.sources.records import facts, write_record

ROW_CAP = 20_000  # fixed value: default bound of a report
NOT_AVAILABLE = "N/A"


#: Distinct users that the Bloom filter of a row group is made for, at most; it takes some 10 bits for each.
FILTER_USERS = 200_000
CLUSTER_KEYS = ("event_name", USER)


def write_corrected(
    df: DataFrame,
    path: str,
    rebalance: bool = True,
    mode: str = "errorifexists",
    cluster: bool = False,
    row_group_bytes: int | None = None,
) -> None:
    """One folder per local day, and a record of what was written (``sources.records``).

    ``rebalance`` adds a shuffle that gathers each day into well-sized files, splitting days that
    are too big. Without it every task writes a file per day it meets; leave it out only if the
    input is already stored by time.

    ``cluster`` gathers the events of a day by their name as well and sorts each file by name and user, with a
    Bloom filter of the users. Readers that ask for some kinds of events or some users then pass over whole
    files, row groups and pages. It takes the same one shuffle; kinds and days that are too big for a
    file are split as before.
    """
    day = "analysis_date_utc7"
    observed, asked = Observation("written"), facts(df)
    out = df.observe(observed, *asked) if asked else df
    if cluster:
        out = out.hint("rebalance", day, "event_name").sortWithinPartitions(day, *CLUSTER_KEYS)
    elif rebalance:
        out = out.hint("rebalance", day)
    writer = out.write.mode(mode).partitionBy(day)
    if cluster:
        writer = (
            writer.option(f"parquet.bloom.filter.enabled#{USER}", "true")
            .option(f"parquet.bloom.filter.expected.ndv#{USER}", str(FILTER_USERS))
            .option("parquet.bloom.filter.adaptive.enabled", "true")
        )
    if row_group_bytes:
        writer = writer.option("parquet.block.size", str(row_group_bytes))
    writer.parquet(path)
    write_record(df.sparkSession, path, df.schema, observed.get if asked else {})


def write_days(df: DataFrame, path: str) -> None:
    """Replaces the days that ``df``, a table as :func:`write_corrected` writes it, has; other days stay. The
    record of the table is out of date afterwards."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("analysis_date_utc7")
        .parquet(path)
    )


def write_cutoffs(cutoffs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    cutoffs.write.mode(mode).parquet(path)


def write_report_csv(
    report: DataFrame,
    path: str,
    keys: tuple[str, ...] = ("ab_group", "level"),
    null_value: str = "",
    row_cap: int = ROW_CAP,
    mode: str = "errorifexists",
) -> None:
    """One ordered CSV file with a header. The row cap is what makes one file safe."""
    refuse_over_cap(refuse_identity(report), row_cap)
    (
        report.orderBy(*keys)
        .coalesce(1)
        .write.mode(mode)
        .option("header", "true")
        .option("nullValue", null_value)
        .csv(path)
    )
