"""Trip expressions: time of day, duration, status."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapmart import presets
from tapmart.functions.rules import intervals


def travel_date(tap_in: Column) -> Column:
    """D6."""
    return F.to_date(tap_in)


def tap_in_hour(tap_in: Column) -> Column:
    """D3."""
    return F.hour(tap_in)


def day_part(hour: Column) -> Column:
    """A missing hour falls in the default part."""
    return intervals(hour, presets.DAY_PARTS, presets.DAY_PART_DEFAULT)


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Exact seconds from start to end, to the microsecond, for either timestamp type.

    Subtracting the timestamps keeps this independent of the session time zone.
    """
    return (end - start).cast("interval second").cast("decimal(18,6)")


def _second_fraction(moment: Column) -> Column:
    seconds = F.extract(F.lit("SECOND"), moment)
    return seconds - F.floor(seconds)


def duration_truncated(tap_in: Column, tap_out: Column) -> Column:
    """Whole minutes, cut toward zero, between the two moments cut to whole seconds."""
    whole = elapsed_seconds(tap_in, tap_out) - _second_fraction(tap_out) + _second_fraction(tap_in)
    return (whole / 60).try_cast("smallint")


def duration_half_even(tap_in: Column, tap_out: Column) -> Column:
    """D5': minutes from the exact seconds, halves rounded to the even minute."""
    return F.bround(elapsed_seconds(tap_in, tap_out) / 60, 0).try_cast("smallint")


def status(tap_out: Column, paid: Column) -> Column:
    """A missing tap-out outranks a zero payment."""
    return (
        F.when(tap_out.isNull(), F.lit(presets.STATUS_INCOMPLETE))
        .when(paid == 0, F.lit(presets.STATUS_FREE))
        .otherwise(F.lit(presets.STATUS_SUCCESS))
    )


def normal_status(source_status: Column) -> Column:
    """D7': the status as stored, with both spellings of the incomplete one made equal."""
    is_incomplete = source_status.isin(list(presets.INCOMPLETE_SPELLINGS))
    return F.when(is_incomplete, F.lit(presets.STATUS_INCOMPLETE)).otherwise(source_status)


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0, also where it is null."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))
