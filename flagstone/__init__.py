"""Engagement analytics and content moderation on Spark DataFrames."""

from flagstone.config import Settings

__all__ = ["Settings"]
