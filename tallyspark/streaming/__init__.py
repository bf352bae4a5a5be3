"""Triggered, incremental file copy (the scheduled copy activity, as a stream)."""
