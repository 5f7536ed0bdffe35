"""Composite jobs."""

from tidegauge.plans.report import current_report, report_frames, run_report

__all__ = ["current_report", "report_frames", "run_report"]
