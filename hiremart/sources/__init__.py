"""Readers and writers: JSON lines, TSV, ragged TSV, per-key folders, CSV/Parquet export."""
