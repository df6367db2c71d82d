"""Commerce journey analytics on Spark: sessions, funnels and customer journeys from event streams."""

from cartpath.session import build_session, configure

__all__ = ["build_session", "configure"]
