from cartwright.quality.engine import Checks, CheckResults
from cartwright.quality.report import append_report, latest_failures, summary

__all__ = ["CheckResults", "Checks", "append_report", "latest_failures", "summary"]
