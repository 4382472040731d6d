"""martlet — commerce and chart-data analytics as plain Spark DataFrame jobs."""

from .session import get_session

__all__ = ["get_session"]
