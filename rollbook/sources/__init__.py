"""Readers and writers at the edges; Parquet inside, JSON and CSV only here."""
