"""Ranked text retrieval and retrieval evaluation as Spark DataFrame jobs."""
