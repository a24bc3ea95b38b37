"""Lakehouse ingestion, star-schema analytics and entity history on Spark DataFrames."""

from siltline.session import build_session

__all__ = ["build_session"]
