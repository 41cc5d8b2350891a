"""Scans: delimited accident files, raw text lines, coordinate files, the
in-memory weekday table and fixture views over the driver's parquet tables."""
