"""Rule tables turned into one CASE expression each."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapmart.presets import Bands


def regex_rules(text: Column, rules: Iterable[tuple[str, str]], default: str) -> Column:
    """D1, D1': label of the first matching pattern, else ``default``."""
    result = F.lit(default)
    for pattern, label in reversed(list(rules)):
        result = F.when(text.rlike(pattern), F.lit(label)).otherwise(result)
    return result


def bands(number: Column, table: Bands) -> Column:
    """Label of the first band whose bound the number does not pass."""
    result = F.lit(table.last)
    for bound, label in reversed(table.bounds):
        inside = number <= bound if table.inclusive else number < bound
        result = F.when(inside, F.lit(label)).otherwise(result)
    if table.null_label is not None:
        result = F.when(number.isNull(), F.lit(table.null_label)).otherwise(result)
    return result


def intervals(number: Column, table: Iterable[tuple[int, int, str]], default: str) -> Column:
    """Label of the closed interval that holds the number, else ``default``."""
    result = F.lit(default)
    for low, high, label in reversed(list(table)):
        result = F.when(number.between(low, high), F.lit(label)).otherwise(result)
    return result


def listed_or(text: Column, allowed: Iterable[str], other: str) -> Column:
    """The text if it is in the list, else ``other``; null is not in the list."""
    return F.when(text.isin(list(allowed)), text).otherwise(F.lit(other))


def whitelist(text: Column, allowed: Iterable[str], other: str, case: str = "lower") -> Column:
    """The trimmed, case-folded text if it is in the list, else ``other``."""
    return listed_or(F.trim(F.lower(text) if case == "lower" else F.upper(text)), allowed, other)


def member_label(text: Column, members: Iterable[str], inside: str, outside: str) -> Column:
    """One label for members of a list and another for the rest."""
    return F.when(text.isin(list(members)), F.lit(inside)).otherwise(F.lit(outside))
