"""Readers and writers (text / csv / parquet) and graphs derived from the order tables."""
