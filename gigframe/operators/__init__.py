"""Reusable relational building blocks."""

from .dedup import asc_first, keep_first
from .joins import fixed_broadcast
from .quality import quality_report
from .shares import parent_total, pct, ratio, with_grand_total
from .stats import box_stats_by, describe_by

__all__ = [
    "asc_first", "box_stats_by", "describe_by", "fixed_broadcast",
    "keep_first", "parent_total", "pct",
    "quality_report", "ratio", "with_grand_total",
]
