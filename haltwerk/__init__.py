"""Timetable event data on Spark: nested snapshots in, history tables and delay measures out."""
