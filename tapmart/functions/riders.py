"""Rider expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapmart import presets
from tapmart.functions.rules import bands, member_label


def age(birth_year: Column, reference_year: int = presets.REFERENCE_YEAR) -> Column:
    """The year is given by the caller, so the result does not depend on the run date."""
    return (F.lit(reference_year) - birth_year).cast("int")


def age_band(age_years: Column, table: presets.Bands = presets.AGE_BANDS_NULL_AWARE) -> Column:
    """D10."""
    return bands(age_years, table)


def segment(age_years: Column, table: presets.Bands = presets.SEGMENTS_NULL_AWARE) -> Column:
    """D11."""
    return bands(age_years, table)


def region(home_city: Column | None) -> Column:
    """Without a city column nothing is known about the region."""
    if home_city is None:
        return F.lit(presets.NOT_KNOWN)
    return member_label(
        home_city, presets.METRO_CITIES, presets.METRO_REGION, presets.OTHER_REGION
    )
