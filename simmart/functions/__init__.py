"""Column expressions: fingerprints, text rules, coercion. No UDFs."""
