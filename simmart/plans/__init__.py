"""Whole jobs: ingest, monthly scoring, mart load, reporting views."""
