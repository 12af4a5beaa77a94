"""Retail lakehouse and anomaly analytics as PySpark DataFrame plans."""

from tallyhouse.session import build_session

__all__ = ["build_session"]
