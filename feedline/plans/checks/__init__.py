"""Checks registered for the driver: each builds feed-shaped input from the
driver's tables with Spark, runs library operators on it, and has an
independent DuckDB statement computing the expected answer from the same tables.

Every check reads whole tables; nothing is sampled or capped. Importing the
package registers every check (``QUERIES``, ``ORACLES``).
"""

from feedline.plans.checks import feed, names, dates, records, state, validation, dedup, paging, drugs, matching, metrics, roundtrips, runs  # noqa: F401 - registers the checks
from feedline.plans.checks.base import ORACLES, QUERIES, RUN_TS, check, documents_feed, events_feed, run_ts, table
from feedline.plans.checks.feed import feed_marks
from feedline.plans.checks.matching import documents_as_trials

__all__ = ["ORACLES", "QUERIES", "RUN_TS", "check", "documents_as_trials", "documents_feed", "events_feed",
           "feed_marks", "run_ts", "table"]
