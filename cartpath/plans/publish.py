"""Publishing the silver tables from bronze, and the reports as gold tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartpath.operators.carts import session_carts
from cartpath.operators.events import flatten, flatten_items
from cartpath.operators.funnel import funnel_by_category, funnel_daily, funnel_metrics, funnel_step_times
from cartpath.operators.journeys import (
    CUSTOMER_KEYS,
    customer_journey_sessions,
    customer_journeys,
    ranked_sessions,
)
from cartpath.operators.sessions import SESSION_KEYS, TRAIL_KEYS, session_events, session_products, sessions
from cartpath.operators.skew import HOT_GROUP_ROWS, HotKeys, hot_keys, within_limit
from cartpath.plans import reports
from cartpath.sources.tables import ensure_schema, scan, write_table


@dataclass(frozen=True)
class Publisher:
    """Writes each layer from the tables of the one before; the steps hand over by tables."""

    spark: SparkSession
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    hot_rows: int = HOT_GROUP_ROWS

    def _bronze(self, name: str) -> DataFrame:
        return scan(self.spark, f"{self.bronze}.{name}")

    def _silver(self, name: str) -> DataFrame:
        return scan(self.spark, f"{self.silver}.{name}")

    def _hot(self, rows: DataFrame, keys: tuple[str, ...], size: Column | None = None) -> HotKeys | None:
        if within_limit(self._bronze("events"), self.hot_rows):
            return None
        return hot_keys(rows, keys, self.hot_rows, size)

    def sessions(self) -> dict[str, int]:
        """``sessions``, ``session_products``, ``session_events`` and ``session_carts``. Each scans only the event fields it needs, which at
        scale is cheaper than keeping the flattened events for all."""
        ensure_schema(self.spark, self.silver)
        flat = flatten(self._bronze("events"))
        summarised = write_table(sessions(flat), f"{self.silver}.sessions")
        # The session table knows the size of every trail, so the events need no count.
        by_session = self._hot(self._silver("sessions"), SESSION_KEYS, F.sum("total_events"))
        by_trail = self._hot(self._silver("sessions"), TRAIL_KEYS, F.sum("total_events"))
        return {
            "sessions": summarised,
            "session_products": write_table(session_products(flat, by_session), f"{self.silver}.session_products"),
            "session_events": write_table(session_events(flat, by_trail), f"{self.silver}.session_events"),
            "session_carts": write_table(
                session_carts(self._bronze("events"), by_trail), f"{self.silver}.session_carts"
            ),
        }

    def funnel(self) -> dict[str, int]:
        """``funnel_metrics``, ``funnel_step_times`` and ``funnel_daily``."""
        all_sessions, trail = self._silver("sessions"), self._silver("session_events")
        return {
            "funnel_metrics": write_table(funnel_metrics(all_sessions), f"{self.silver}.funnel_metrics"),
            "funnel_step_times": write_table(funnel_step_times(trail), f"{self.silver}.funnel_step_times"),
            "funnel_daily": write_table(funnel_daily(all_sessions), f"{self.silver}.funnel_daily"),
        }

    def journeys(self) -> dict[str, int]:
        """``customer_journeys`` and ``customer_journey_sessions``."""
        all_sessions = self._silver("sessions")
        ranked = ranked_sessions(all_sessions, self._hot(all_sessions, CUSTOMER_KEYS))
        journeys = customer_journeys(ranked, self._bronze("customers"), self._bronze("orders"))
        return {
            "customer_journeys": write_table(journeys, f"{self.silver}.customer_journeys"),
            "customer_journey_sessions": write_table(
                customer_journey_sessions(ranked), f"{self.silver}.customer_journey_sessions"
            ),
        }

    def reports(self) -> dict[str, DataFrame]:
        """The twelve reports on the published tables, and the funnel per category."""
        all_sessions, journeys = self._silver("sessions"), self._silver("customer_journeys")
        step_times = self._silver("funnel_step_times")
        return {
            "events_by_type": reports.events_by_type(self._bronze("events")),
            "session_summary": reports.session_summary(all_sessions),
            "sessions_by_stage": reports.sessions_by_stage(all_sessions),
            "event_transitions": reports.event_transitions(self._silver("session_events")),
            "funnel_report": reports.funnel_report(self._silver("funnel_metrics")),
            "step_time_averages": reports.step_time_averages(step_times),
            "step_time_summary": reports.step_time_summary(step_times),
            "daily_trend": reports.daily_trend(self._silver("funnel_daily")),
            "engagement_summary": reports.engagement_summary(journeys),
            "conversion_sessions": reports.conversion_sessions(journeys),
            "first_touch_distribution": reports.first_touch_distribution(journeys),
            "engagement_segments": reports.engagement_segments(journeys),
        }

    def publish_gold(self) -> dict[str, int]:
        """Every report as a table."""
        ensure_schema(self.spark, self.gold)
        written = {name: write_table(rows, f"{self.gold}.{name}") for name, rows in self.reports().items()}
        by_category = funnel_by_category(flatten_items(self._bronze("events")), self._bronze("products"))
        written["funnel_by_category"] = write_table(by_category, f"{self.gold}.funnel_by_category")
        return written

    def publish_silver(self) -> dict[str, int]:
        return {**self.sessions(), **self.funnel(), **self.journeys()}
