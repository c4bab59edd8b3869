"""Planned stop records to one wide row per stop."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import ARRIVAL, DEPARTURE, replaced_flag, replacement_word


def replacement_cols(side: str, label: str) -> list[Column]:
    """The five columns of one side (``ar`` or ``dp``)."""
    booked, line = F.col(f"{side}._fb"), F.col(f"{side}._l")
    return [
        replaced_flag(booked, line).alias(f"{label}_IsReplaced"),
        replacement_word(booked, line, 0).alias(f"{label}_ReplacementType"),
        replacement_word(booked, line, 1).alias(f"{label}_ReplacementName"),
        F.col(f"{side}._pp").alias(f"{label}_PlannedPlatform"),
        F.col(f"{side}._pt").try_cast("long").alias(f"{label}_PlannedTime"),
    ]


def flatten_planned(stops: DataFrame, name_from_departure: bool = False) -> DataFrame:
    """Arrival and departure side by side.

    The train name comes from the arrival; ``name_from_departure`` also names stops that
    only depart.
    """
    name = F.coalesce("ar._fb", "dp._fb") if name_from_departure else F.col("ar._fb")
    return stops.select(
        F.col("_eva").alias("EVA_Number"),
        F.col("_id").alias("EventId"),
        F.col("tl._c").alias("TrainType"),
        name.alias("TrainName"),
        *replacement_cols("ar", ARRIVAL),
        *replacement_cols("dp", DEPARTURE),
    )
