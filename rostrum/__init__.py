"""Rostrum: legislative-record analytics expressed as Spark DataFrame jobs."""
