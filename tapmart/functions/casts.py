"""Conversions that give null on bad input instead of failing the job."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tapmart.presets import ALL_BLANKS, ASCII_BLANKS


def trim_blanks(text: Column) -> Column:
    """Trim all kinds of blanks.

    Trimming by a set of characters gets slow with a long set, so texts of plain ASCII, which
    have as many bytes as characters, are trimmed by the ASCII blanks.
    """
    is_ascii = F.length(text) == F.octet_length(text)
    return F.btrim(text, F.when(is_ascii, F.lit(ASCII_BLANKS)).otherwise(F.lit(ALL_BLANKS)))


def without_tokens(text: Column, tokens: Iterable[str]) -> Column:
    """Null for texts that stand for "no value"."""
    return F.when(~text.isin(list(tokens)), text)


def try_number(text: Column, data_type: str = "double") -> Column:
    """P10: number or null; infinities and NaN count as no number in exact types.

    Whole-number types also take texts such as ``1990.0``; a fraction is cut off. The way over
    an exact decimal keeps 19-digit card numbers right, which a double cannot.
    """
    if data_type == "double":
        return F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))
    if data_type in ("tinyint", "smallint", "int", "bigint"):
        return text.try_cast("decimal(38,6)").try_cast(data_type)
    return text.try_cast(data_type)


def in_range(number: Column, low: int, high: int) -> Column:
    """Null outside the closed range."""
    return F.when(number.between(low, high), number)


def try_timestamp(text: Column, formats: Sequence[str] = ()) -> Column:
    """Wall-clock timestamp without time zone, or null.

    ISO texts are read as they are, others by the first of ``formats`` that fits.
    """
    tried = [F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(text.try_cast("timestamp_ntz"), *tried)
