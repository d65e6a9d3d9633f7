"""Tradewind: a decision-support analytics engine written as PySpark jobs."""
