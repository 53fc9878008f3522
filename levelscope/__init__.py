"""Mobile-game telemetry analytics on Spark: mode correction and per-level A/B reports."""

from levelscope.config import CorrectionConfig, ReportConfig
from levelscope.plans.correct import correct_history
from levelscope.plans.reports import levelplay_report, loss_report

__all__ = [
    "CorrectionConfig",
    "ReportConfig",
    "correct_history",
    "levelplay_report",
    "loss_report",
]
