"""Game-event analytics on Spark: canonical events, shaping, identity and delivery accounting."""

from tidewatch.session import configure

__all__ = ["configure"]
