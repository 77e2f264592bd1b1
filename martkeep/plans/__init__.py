"""Whole queries: mart rows for touched keys, full rebuilds and reconciliation."""

from martkeep.plans.earlier import earlier_progress_rows, last_learnings, tombstones
from martkeep.plans.enroll import enroll_rows, merged_enroll
from martkeep.plans.progress import merged_progress, progress_rows
from martkeep.plans.sql import query_views
from martkeep.plans.upkeep import reconcile, rebuild_enroll, rebuild_progress

__all__ = [
    "earlier_progress_rows",
    "enroll_rows",
    "last_learnings",
    "merged_enroll",
    "merged_progress",
    "progress_rows",
    "query_views",
    "rebuild_enroll",
    "rebuild_progress",
    "reconcile",
    "tombstones",
]
