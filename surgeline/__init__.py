"""Demand analytics over panels of daily usage, written as Spark DataFrame jobs."""
