"""Route and vehicle expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapmart import presets
from tapmart.functions.rules import regex_rules


def corridor_type(route_id: Column) -> Column:
    """D1."""
    return regex_rules(route_id, presets.CORRIDOR_TYPES, presets.CORRIDOR_TYPE_DEFAULT)


def corridor_type_or_other(route_id: Column) -> Column:
    """D1': routes without an id are of the other type."""
    blank = (presets.UNKNOWN_ID, "")
    label = regex_rules(F.trim(route_id), presets.CORRIDOR_TYPES, presets.CORRIDOR_TYPE_DEFAULT)
    is_blank = route_id.isNull() | route_id.isin(list(blank))
    return F.when(is_blank, F.lit(presets.CORRIDOR_TYPE_OTHER)).otherwise(label)


def origin(route_name: Column) -> Column:
    """Text before the first separator."""
    return F.trim(F.get(F.split(route_name, presets.ROUTE_NAME_SEPARATOR), F.lit(0)))


def destination(route_name: Column) -> Column:
    """Text between the first separator and the next one; null without a separator."""
    return F.trim(F.get(F.split(route_name, presets.ROUTE_NAME_SEPARATOR), F.lit(1)))


def origin_first_split(route_name: Column) -> Column:
    """D2': text before the first separator; the untouched name without one; never null."""
    parts = F.split(route_name, presets.ROUTE_NAME_SEPARATOR, 2)
    cut = F.when(F.size(parts) > 1, F.trim(F.get(parts, F.lit(0)))).otherwise(route_name)
    return F.coalesce(cut, F.lit(""))


def destination_first_split(route_name: Column) -> Column:
    """D2': everything after the first separator; empty without one; never null."""
    parts = F.split(route_name, presets.ROUTE_NAME_SEPARATOR, 2)
    return F.coalesce(F.trim(F.get(parts, F.lit(1))), F.lit(""))


def fleet_id(route_id: Column, direction: Column, travel_date: Column) -> Column:
    """One synthetic vehicle per route, direction and day."""
    return F.concat_ws(
        "-",
        F.lit(presets.FLEET_PREFIX),
        F.coalesce(F.trim(route_id), F.lit(presets.FLEET_NO_ROUTE)),
        F.coalesce(direction.cast("int").cast("string"), F.lit(presets.FLEET_NO_DIRECTION)),
        F.coalesce(F.date_format(travel_date, "yyyyMMdd"), F.lit(presets.FLEET_NO_DATE)),
    )
