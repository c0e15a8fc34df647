"""Mixing sources to target weights by Pareto order sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapmart.llm.common import uniform
from tapmart.session import freeze

MAX_REPEATS = 3
WEIGHTS = (1, 2, 3)
BUCKETS = 1 << 16
SEED = 20240607


def source_targets(sized: DataFrame, weights=WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: ``_source, source_size, target``.

    Sources in code point order, null last, take the weights in turn and share the size of the
    whole corpus. A target stops at ``max_repeats`` times the size of its source; what is over is
    shared again by weight. With sources in the order of cap to weight the capped ones come
    first, so the common level of the others follows from running sums. The windows run over one
    row per source.
    """
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    rank = F.row_number().over(by_name) - 1
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = (
        sized.groupBy("_source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("_weight", F.get(cycle, rank % len(weights)))
        .withColumn("_cap", F.col("source_size") * float(max_repeats))
    )
    order = Window.orderBy((F.col("_cap") / F.col("_weight")).asc(), F.col("_source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    left = total - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    level = F.try_divide(left, F.sum("_weight").over(after))
    ranked = sources.withColumn("_level", level)
    reached = F.when(F.col("_level") * F.col("_weight") <= F.col("_cap"), F.col("_level"))
    # Counting an uncapped source as capped can only lower the level, so the largest is right.
    common = F.max(reached).over(everything)
    target = F.least(F.col("_cap"), common * F.col("_weight"))
    return ranked.select(
        "_source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target")
    )


def mix_sources(
    docs: DataFrame,
    size: Column,
    id_column: str = "doc_id",
    source: str = "source",
    weights=WEIGHTS,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per row of ``docs``: id, source, ``size``, ``source_size``, ``target``, ``copies``.

    Columns named in ``keep`` come along with their row, so no join by id is needed to get them.

    A document is expected target / source size times. The whole part is certain; for the rest
    Pareto order sampling ranks the documents of a source by the odds of a uniform number over
    the odds of inclusion, and takes them in that order until the words that the source still
    lacks are reached (the last document is taken if that comes nearer to them). The uniform
    number depends on id and seed only, so reruns agree, and rows repeated under one id stand side
    by side in the order.

    A null source is a source of its own, after all others. A size of null or 0 takes no words.
    An empty table gives an empty table.

    One source may hold most rows, so no window runs over a source: sizes are added up by ranges
    of the order first (at most ``BUCKETS`` per source), and only the range in which the target
    is reached is put in order row by row.
    """
    kept = [name for name in keep if name not in (id_column, source)]
    wide = docs.select(
        F.col(id_column).alias(id_column),
        F.col(source).alias("_source"),
        F.coalesce(size.cast("bigint"), F.lit(0)).alias("size"),
        uniform(F.col(id_column), F.lit(seed)).alias("_u"),
        *[F.col(f"`{name}`").alias(f"_kept_{name}") for name in kept],
    )
    rows = freeze(wide.drop(*[f"_kept_{name}" for name in kept]), "mixing-sizes")
    targets = freeze(source_targets(rows, weights, max_repeats), "mixing-targets")
    expected = F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))
    targets = targets.select(
        F.col("_source").alias("_name"),
        "source_size",
        "target",
        F.floor(expected).alias("_certain"),
        (expected - F.floor(expected)).alias("_inclusion"),
    )
    u, p = F.col("_u"), F.col("_inclusion")
    odds = (u / (1 - u)) / (p / (1 - p))

    def ranked(sized: DataFrame) -> DataFrame:
        return (
            sized.join(targets, F.col("_source").eqNullSafe(F.col("_name")))
            .drop("_name")
            .withColumn("_rank", F.when(p > 0, odds))
            .withColumn(
                "_bucket", F.floor(F.col("_rank") / (1 + F.col("_rank")) * BUCKETS).cast("int")
            )
        )

    sums = (
        ranked(rows)
        .where("_bucket IS NOT NULL")
        .groupBy("_source", "_bucket")
        .agg(
            F.sum("size").alias("_words"),
            F.first("source_size").alias("source_size"),
            F.first("_inclusion").alias("_inclusion"),
        )
    )
    running = Window.partitionBy("_source").orderBy("_bucket")
    reached = F.sum("_words").over(running)
    wanted = F.col("source_size") * F.col("_inclusion")
    edges = (
        sums.withColumn("_before", reached - F.col("_words"))
        .withColumn("_open", wanted - F.col("_before"))
        .where(F.col("_open") > 0)
        .groupBy("_source")
        .agg(F.max_by(F.struct("_bucket", "_open"), F.col("_bucket")).alias("_edge"))
        .select(F.col("_source").alias("_at"), "_edge.*")
        .withColumnRenamed("_bucket", "_edge_bucket")
    )
    placed = ranked(wide if kept else rows).join(edges, F.col("_source").eqNullSafe(F.col("_at")), "left")
    on_edge = F.col("_bucket") == F.col("_edge_bucket")
    below = F.coalesce(F.col("_bucket") < F.col("_edge_bucket"), F.lit(False))
    is_edge = F.coalesce(on_edge, F.lit(False))
    whole_ranges = placed.where(~is_edge).withColumn("_extra", below.cast("bigint"))
    in_order = Window.partitionBy("_source").orderBy("_rank", F.col(id_column).asc_nulls_last())
    taken = F.sum("size").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    edge_range = placed.where(is_edge).withColumn(
        "_extra", (taken - F.col("size") / 2 <= F.col("_open")).cast("bigint")
    )
    return whole_ranges.unionByName(edge_range).select(
        id_column,
        F.col("_source").alias(source),
        "size",
        "source_size",
        "target",
        (F.col("_certain") + F.col("_extra")).alias("copies"),
        *[F.col(f"_kept_{name}").alias(name) for name in kept],
    )
