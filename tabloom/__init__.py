"""Tabular analytics and model selection written as Spark DataFrame jobs."""

__version__ = "0.1.0"
