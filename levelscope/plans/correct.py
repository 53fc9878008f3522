"""Stage 1: corrected events and the cutoff table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from levelscope.config import CorrectionConfig
from levelscope.operators.correction import (
    attach_cutoffs,
    corrected_events,
    history_window,
    milestone_cutoffs,
)
from levelscope.operators.quality import refuse_null_timestamps
from levelscope.session import stage
from levelscope.sources.gates import raw_gate


def correct_history(
    raw: DataFrame, cfg: CorrectionConfig, cutoffs: DataFrame | None = None
) -> DataFrame:
    """All app events of the history with the seven analysis columns.

    ``cutoffs`` is a written cutoff table of the same, probed input, if there is one already; else the
    input is probed for unreadable timestamps, which stop the run (no row is dropped for one), and the table
    computed and staged. Scans of the input: the probe, which row groups without nulls skip, a
    narrow one over milestone events, and that of what is written out.
    """
    if cutoffs is None:
        refuse_null_timestamps(raw_gate(raw), cfg)
    events = history_window(raw, cfg)
    if cutoffs is None:
        cutoffs = stage(milestone_cutoffs(events, cfg), "cutoffs")
    joined = attach_cutoffs(events, cutoffs, cfg.broadcast_bytes, cfg.busy_share)
    return corrected_events(events, joined, cfg)
