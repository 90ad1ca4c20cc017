"""Readers and writers: paged records, target files, tables."""
