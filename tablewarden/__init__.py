"""Spark-native auditing of research data collections."""

from tablewarden.session import build_session, settle, tune

__all__ = ["build_session", "settle", "tune"]
