"""Imbalanced-classification analytics on Spark DataFrames and Spark ML."""

from lopside.session import build_session, durable

__all__ = ["build_session", "durable"]
