"""Schema checks and row cleaning."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapmart.functions.casts import trim_blanks, without_tokens


def string_columns(df: DataFrame) -> list[str]:
    return [name for name, data_type in df.dtypes if data_type == "string"]


def trim_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Trim the listed string columns; names the frame lacks are skipped."""
    present = [name for name in columns if name in df.columns]
    return df.withColumns({name: F.trim(F.col(name)) for name in present})


def trim_all(
    df: DataFrame, tokens: tuple[str, ...] = ("nan",), columns: Iterable[str] | None = None
) -> DataFrame:
    """Trim every string column and turn "no value" texts into null.

    With ``columns``, only those of them that are strings. Two steps, so that each cell is
    trimmed once.
    """
    texts = [c for c in string_columns(df) if columns is None or c in columns]
    trimmed = df.withColumns({c: trim_blanks(F.col(c)) for c in texts})
    return trimmed.withColumns({c: without_tokens(F.col(c), tokens) for c in texts})


def missing_columns(df: DataFrame, required: Iterable[str]) -> list[str]:
    return [name for name in required if name not in df.columns]


def require_columns(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Fail before any job runs when required columns are absent."""
    absent = missing_columns(df, required)
    if absent:
        raise ValueError(f"required columns are missing: {', '.join(absent)}")
    return df


def drop_nulls(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """P4."""
    return df.dropna(subset=list(columns))


def fill_nulls(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """P5."""
    return df.fillna(dict(values))


def ensure_columns(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add the columns the frame lacks; present ones stay as they are."""
    return df.withColumns({c: value for c, value in defaults.items() if c not in df.columns})


def default_columns(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add absent columns and fill nulls of present ones with the same default."""
    return df.withColumns(
        {
            name: F.coalesce(F.col(name), value) if name in df.columns else value
            for name, value in defaults.items()
        }
    )


def strip_headers(df: DataFrame) -> DataFrame:
    """Column names without outer blanks and inner spaces."""
    return df.toDF(*[name.strip().replace(" ", "") for name in df.columns])


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """The same frame under prefixed names, for joining it in more than one role."""
    return df.toDF(*[prefix + name for name in df.columns])


def with_lineage(
    df: DataFrame, source: str | Column, batch_id: str, loaded_at: Column | None = None
) -> DataFrame:
    """Where a row came from and with which batch; the load time only when one is given."""
    columns = {"source": F.lit(source), "batch_id": F.lit(batch_id)}
    if loaded_at is not None:
        columns["loaded_at"] = loaded_at
    return df.withColumns(columns)


def with_validity(df: DataFrame, load_date: Column) -> DataFrame:
    """An open version starting on the load date."""
    return df.withColumns(
        {
            "valid_from": load_date,
            "valid_to": F.lit(None).cast("date"),
            "is_current": F.lit(1),
        }
    )
