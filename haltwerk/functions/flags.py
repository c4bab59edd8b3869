"""Scalar rules on stop records."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
ADDED = "a"
CANCELLED = "c"
ARRIVAL, DEPARTURE, STOP = "Arrival", "Departure", "Stop"


def _differs(booked: Column, line: Column) -> Column:
    return line.isNotNull() & (booked != line)


def replaced_flag(booked: Column, line: Column) -> Column:
    """YES if a line name exists and differs from the booked name; unknown counts as NO."""
    return F.when(_differs(booked, line), "YES").otherwise("NO")


def replacement_word(booked: Column, line: Column, position: int) -> Column:
    """Word of the booked name, only where the train is replaced."""
    return F.when(_differs(booked, line), F.get(F.split(booked, " "), F.lit(position)))


def unplanned_flag(status: Column) -> Column:
    return F.coalesce(status == ADDED, F.lit(False))


def cancelled_flag(status: Column) -> Column:
    return F.coalesce(status == CANCELLED, F.lit(False))
