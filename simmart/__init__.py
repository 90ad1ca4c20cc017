"""Molecular-similarity mart expressed as Spark DataFrame jobs."""
