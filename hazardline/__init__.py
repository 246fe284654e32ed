"""Longitudinal registry cleaning and survival statistics as Spark jobs."""

__version__ = "0.1.0"
