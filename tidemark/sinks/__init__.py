"""Parquet, CSV and report writers."""
