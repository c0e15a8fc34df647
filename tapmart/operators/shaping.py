"""Report results laid out for charts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapmart import presets

# The labels that cleaning and the unknown members give, and the column for any other.
BANK_COLUMNS = (*sorted((*presets.CARD_BANKS, presets.OTHER_BANK)), presets.UNKNOWN_ROWS["rider"]["card_bank"])
GENDER_COLUMNS = (*presets.GENDERS, presets.GENDER_NOT_GIVEN, presets.UNKNOWN_ROWS["rider"]["gender"])
ANY_OTHER = "other_labels"
HOURS = 24


def pivot_counts(report: DataFrame, rows: str, columns: str, values: Sequence[str]) -> DataFrame:
    """Trips per row label, one column per listed value, 0 where there are none.

    Labels outside the list, and null, add up in the column ``other_labels``, so the sum over a row
    is the report's.
    """
    label = F.col(columns)
    listed = F.when(label.isin(list(values)), label).otherwise(F.lit(ANY_OTHER))
    names = [*values, ANY_OTHER]
    pivoted = report.withColumn(columns, listed).groupBy(rows).pivot(columns, names)
    return pivoted.agg(F.sum("trips")).fillna(0, subset=names)


def pivot_corridor_bank(report: DataFrame) -> DataFrame:
    """Largest first by the first bank in alphabetical order."""
    pivoted = pivot_counts(report, "corridor_type", "card_bank", BANK_COLUMNS)
    return pivoted.orderBy(F.desc(BANK_COLUMNS[0]), "corridor_type")


def pivot_age_gender(report: DataFrame) -> DataFrame:
    """R2."""
    return pivot_counts(report, "age_band", "gender", GENDER_COLUMNS).orderBy("age_band")


def share_by_bank(report: DataFrame) -> DataFrame:
    """Trips per bank and their percentage of all.

    The total is taken over the few bank rows.
    """
    per_bank = report.groupBy("card_bank").agg(F.sum("trips").alias("trips"))
    total = F.sum("trips").over(Window.partitionBy())
    share = F.try_divide(F.col("trips").cast("double") * 100, total)
    return per_bank.withColumn("pct", F.round(share, 1)).orderBy("card_bank")


def hourly_grid(report: DataFrame, directions: Sequence[int] = (0, 1)) -> DataFrame:
    """One row per direction and hour of the day, 0 trips where the report has none."""
    spark = report.sparkSession
    grid = spark.range(1).select(F.explode(F.array(*map(F.lit, directions))).alias("direction"))
    hours = F.sequence(F.lit(0), F.lit(HOURS - 1))
    grid = grid.select("direction", F.explode(hours).alias("tap_in_hour"))
    per_hour = report.groupBy("direction", "tap_in_hour").agg(F.sum("trips").alias("trips"))
    return (
        grid.join(per_hour, ["direction", "tap_in_hour"], "left")
        .fillna(0, subset=["trips"])
        .orderBy("direction", "tap_in_hour")
    )


def daily_series(report: DataFrame) -> DataFrame:
    """Revenue in millions, and a weekend flag that is never null."""
    return report.select(
        "date",
        F.coalesce("is_weekend", F.lit(0)).alias("is_weekend"),
        "trips",
        (F.col("revenue").cast("double") / 1e6).alias("revenue_millions"),
    ).orderBy("date")
