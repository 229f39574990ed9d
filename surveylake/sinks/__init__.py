"""Sinks: RAW / PROCESSED / history tables, exports, archives, load log."""
