"""Spark-native medallion analytics for hourly time series."""

from wattlake.session import build_session, configure

__all__ = ["build_session", "configure"]
