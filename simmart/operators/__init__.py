"""DataFrame -> DataFrame building blocks."""
