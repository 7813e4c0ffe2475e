"""monthclose: monthly compliance and servicing reports for a card programme, on PySpark."""

from monthclose.params import Program, ReportParams, SkewPolicy
from monthclose.sources.registry import Sources

__all__ = ["Program", "ReportParams", "SkewPolicy", "Sources"]
