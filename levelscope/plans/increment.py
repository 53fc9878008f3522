"""Stage 1 on further events: new cutoffs, and only the days that they or the new events touch."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from levelscope.config import ADDED_COLUMNS, USER, CorrectionConfig
from levelscope.operators.correction import (
    attach_cutoffs,
    corrected_events,
    history_window,
    milestone_cutoffs,
    relabelled,
)
from levelscope.operators.quality import refuse_null_timestamps
from levelscope.session import stage
from levelscope.sources.gates import raw_gate

DAY = "analysis_date_utc7"
CUTOFF = "first_clear_650_ts"


def merged_cutoffs(*tables: DataFrame) -> DataFrame:
    """Each user's earliest cutoff of several cutoff tables, which may be of any slices of the history."""
    both = tables[0]
    for table in tables[1:]:
        both = both.unionByName(table)
    return both.groupBy(USER).agg(F.min(CUTOFF).alias(CUTOFF))


def changed_cutoffs(old: DataFrame, new: DataFrame) -> DataFrame:
    """The users of ``new`` whose cutoff is not in ``old``, or later there."""
    before = old.withColumnRenamed(CUTOFF, "_before")
    joined = new.join(before, USER, "left")
    return joined.where(F.col("_before").isNull() | (F.col(CUTOFF) < F.col("_before"))).select(USER, CUTOFF)


@dataclass(frozen=True)
class Increment:
    """``cutoffs``: the whole new table. ``days``: all rows of the ``touched`` days, old and new."""

    cutoffs: DataFrame
    days: DataFrame
    touched: tuple[date, ...]


def increment(
    fixed: DataFrame, cutoffs: DataFrame, raw: DataFrame, cfg: CorrectionConfig
) -> Increment:
    """What raw events that stage 1 has not seen yet change in its output.

    The new events may be of any days. A user whose first clear is among them, or is earlier than the one
    known, is relabelled on all days on which the user has events; all other rows of these days are
    copied as they are, and other days are not read beyond two columns. The days are
    collected, nothing else. Events that were in the output before must not come again: they would count twice.
    """
    events = history_window(refuse_null_timestamps(raw_gate(raw), cfg), cfg)
    found = stage(milestone_cutoffs(events, cfg), "new-cutoffs")
    merged = stage(merged_cutoffs(cutoffs, found), "merged-cutoffs")
    changed = stage(changed_cutoffs(cutoffs, merged), "changed-cutoffs")
    fresh = corrected_events(events, attach_cutoffs(events, merged, cfg.broadcast_bytes, cfg.busy_share), cfg)
    moved = attach_cutoffs(fixed.select(USER, DAY), changed, cfg.broadcast_bytes, cfg.busy_share)
    days = moved.where(F.col(CUTOFF).isNotNull()).select(DAY).union(fresh.select(DAY)).distinct()
    touched = tuple(sorted(r[0] for r in days.collect()))

    old = fixed.where(F.col(DAY).isin(*touched)) if touched else fixed.limit(0)
    rest = [c for c in old.columns if c != CUTOFF]
    known = old.withColumnRenamed(CUTOFF, "_known")
    later = attach_cutoffs(known, changed, cfg.broadcast_bytes, cfg.busy_share)
    later = later.withColumn(CUTOFF, F.coalesce(CUTOFF, "_known")).select(*rest, CUTOFF)
    columns = [c for c in old.columns if c not in ADDED_COLUMNS]
    everything = relabelled(later, columns, cfg).unionByName(fresh, allowMissingColumns=True)
    return Increment(merged, everything, touched)
