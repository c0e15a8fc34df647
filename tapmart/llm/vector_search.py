"""Exact top-k search by inner product with a pivot-distance index."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapmart.session import freeze

# Small tables get as many pivots and rings as give cells of CELL_ROWS vectors, up to PIVOTS; from
# some four million vectors on the pivots grow with the square root of their number.
PIVOTS = 64
ROOT_PER_PIVOT = 32
MOST_PIVOTS = 1_000
RINGS = 16
CELL_ROWS = 1_024
CHUNK_ROWS = 4_096
QUERY_BLOCK = 2_048
ROUTED_TOGETHER = 256


def integer_vectors(vectors: DataFrame, id_column: str, vector: str, scale: int) -> DataFrame:
    """``id, v``: every component as floor(scale * x); vectors with holes take no part."""
    x = F.col(vector)
    finite = F.forall(
        x,
        lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e.cast("double")) < F.lit(float("inf"))),
    )
    whole = x.isNotNull() & (F.size(x) > 0) & finite & F.col(id_column).isNotNull()
    return vectors.where(whole).select(
        F.col(id_column).cast("bigint").alias("id"),
        F.transform(x, lambda e: F.floor(e.cast("double") * scale).cast("bigint")).alias("v"),
    )


def _lifted(v: np.ndarray, top: float) -> np.ndarray:
    """One more component brings all vectors to one length, so that the largest inner product
    with a query is the smallest distance to it."""
    v = v.astype(np.float64)
    rest = np.sqrt(np.maximum(top - (v * v).sum(axis=1), 0.0))
    return np.column_stack([v, rest])


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    square = (a * a).sum(axis=1)[:, None] + (b * b).sum(axis=1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(square, 0.0))


def _by_length(pdf: pd.DataFrame) -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    lengths = pdf["v"].map(len)
    for length, part in pdf.groupby(lengths):
        yield int(length), part, np.stack(part["v"].to_numpy()).astype(np.int64)


def _some(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[int, pd.DataFrame, np.ndarray]]:
    """A few queries of one length at a time: each meets all cells, whose number grows."""
    for pdf in batches:
        for start in range(0, len(pdf), ROUTED_TOGETHER):
            yield from _by_length(pdf.iloc[start : start + ROUTED_TOGETHER])


class PivotIndex:
    """Vectors keyed by nearest pivot and by distance to it.

    A cell is a ring of vectors around a pivot; rings have about equal numbers of vectors. The
    summary of a cell is its smallest and largest distance and its count, so it is at most
    ``pivots * rings`` rows per vector length. A cell is stored in chunks of about ``CHUNK_ROWS``
    vectors each, by a hash of id and vector, so that crowded vectors, or those of one id, do not
    pile up in a task. Rows equal in id and vector are one row of the index with its ``copies``.
    """

    def __init__(self, vectors: DataFrame, pivots: int = PIVOTS, rings: int = RINGS):
        number = vectors.count()
        wanted = -(-number // CELL_ROWS)
        pivots = max(pivots, min(math.isqrt(number) // ROOT_PER_PIVOT, MOST_PIVOTS))
        pivots = max(1, min(pivots, -(-wanted // 4)))
        rings = max(2, min(rings, -(-wanted // pivots)))
        squares = F.aggregate("v", F.lit(0.0), lambda s, e: s + e.cast("double") * e)
        tops = vectors.groupBy(F.size("v").alias("n")).agg(F.max(squares).alias("top")).collect()
        self.top = {row["n"]: float(row["top"]) for row in tops}
        sample = (
            vectors.select("v", F.row_number().over(
                Window.partitionBy(F.size("v")).orderBy(F.xxhash64("id", "v"), "id", "v")
            ).alias("at"))
            .where(F.col("at") <= pivots)
            .collect()
        )
        self.pivots = {
            n: _lifted(np.array([r["v"] for r in sample if len(r["v"]) == n]), top)
            for n, top in self.top.items()
        }
        at_pivot = freeze(vectors.mapInPandas(
            self._nearest(),
            "id bigint, v array<bigint>, copies bigint, n int, pivot int, distance double",
        ), "vector-pivots")
        cuts = [i / rings for i in range(1, rings)]
        bounds = at_pivot.groupBy("n", "pivot").agg(
            F.percentile_approx("distance", cuts, 1000).alias("cuts")
        )
        ring = F.size(F.filter("cuts", lambda cut: cut < F.col("distance")))
        placed = (
            at_pivot.join(bounds, ["n", "pivot"])
            .withColumn("cell", F.col("pivot") * rings + ring)
            .drop("cuts", "pivot")
        )
        placed = freeze(placed, "vector-cells")
        self.cells = placed.groupBy("n", "cell").agg(
            F.count(F.lit(1)).alias("rows"),
            F.min("distance").alias("low"),
            F.max("distance").alias("high"),
        ).orderBy("n", "cell").toPandas()
        self.rings = rings
        self.cells["chunks"] = (-(-self.cells["rows"] // CHUNK_ROWS)).astype("int64")
        summary = vectors.sparkSession.createDataFrame(
            self.cells[["n", "cell", "chunks"]], "n int, cell int, chunks bigint"
        )
        self.rows = placed.join(summary, ["n", "cell"]).select(
            "n", "cell", F.pmod(F.xxhash64("id", "v"), F.col("chunks")).alias("chunk"),
            "id", "v", "copies",
        )

    def _nearest(self):
        pivots, top = self.pivots, self.top

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for n, part, v in _by_length(pdf):
                    far = _distances(_lifted(v, top[n]), pivots[n])
                    nearest = far.argmin(axis=1)
                    part = part[["id", "v", "copies"]]
                    yield part.assign(
                        n=n, pivot=nearest, distance=far[np.arange(len(v)), nearest]
                    )

        return run

    def _routes(self, k: int, bounded: bool):
        """Queries to the chunks they must look at.

        First, without a bound: cells by growing lower bound of the distance until they hold more
        than k vectors. Then, with the k-th score so far: all cells whose lower bound, by the
        triangle inequality, is not beyond the distance that belongs to that score.
        """
        pivots, top, rings = self.pivots, self.top, self.rings
        cells = {int(n): part for n, part in self.cells.groupby("n")}

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for n, part, v in _some(batches):
                own = cells[n]
                q = np.column_stack([v.astype(np.float64), np.zeros(len(v))])
                to_pivot = _distances(q, pivots[n])[:, own["cell"].to_numpy() // rings]
                low, high = own["low"].to_numpy(), own["high"].to_numpy()
                least = np.maximum(np.maximum(low - to_pivot, to_pivot - high), 0.0)
                if bounded:
                    length = (q * q).sum(axis=1) + top[n]
                    limit = np.sqrt(np.maximum(length - 2.0 * part["kth"].to_numpy(), 0.0))
                    limit = np.where(part["kth"].isna(), np.inf, limit)
                    # Distances carry rounding errors; the margin is far above them.
                    wanted = least <= (limit * (1 + 1e-6) + 1e-3)[:, None]
                else:
                    order = np.argsort(least, axis=1, kind="stable")
                    held = np.cumsum(own["rows"].to_numpy()[order], axis=1)
                    needed = held - own["rows"].to_numpy()[order] <= k
                    wanted = np.zeros(least.shape, dtype=bool)
                    np.put_along_axis(wanted, order, needed, axis=1)
                query, cell = np.nonzero(wanted)
                chunks = own["chunks"].to_numpy()[cell]
                query, cell = np.repeat(query, chunks), np.repeat(cell, chunks)
                starts = np.repeat(np.cumsum(chunks) - chunks, chunks)
                yield pd.DataFrame(
                    {
                        "n": n,
                        "cell": own["cell"].to_numpy()[cell],
                        "chunk": np.arange(len(cell)) - starts,
                        "block": part["block"].to_numpy()[query],
                        "id": part["id"].to_numpy()[query],
                        "mark": part["mark"].to_numpy()[query],
                        "v": part["v"].to_numpy()[query],
                    }
                )

        return run

    def _look(self, queries: DataFrame, k: int, bounded: bool) -> DataFrame:
        key = ["n", "cell", "chunk", "block"]
        routed = queries.mapInPandas(
            self._routes(k, bounded),
            "n int, cell int, chunk bigint, block bigint, id bigint, mark string, v array<bigint>",
        )
        # A chunk goes to every block of queries that has to see it, and is compared as a matrix.
        wanted = routed.select(*[F.col(name).alias(name) for name in key]).distinct()
        rows = self.rows.join(wanted, ["n", "cell", "chunk"])

        def best(asked: pd.DataFrame, stored: pd.DataFrame) -> pd.DataFrame:
            found = []
            if len(asked) and len(stored):
                stored = stored.sort_values("id")
                ids, copies = stored["id"].to_numpy(), stored["copies"].to_numpy()
                matrix = np.stack(stored["v"].to_numpy()).astype(np.int64)
                exact_in_float = np.abs(matrix).max() < 2**20
                for start in range(0, len(asked), 256):
                    part = asked.iloc[start : start + 256]
                    v = np.stack(part["v"].to_numpy()).astype(np.int64)
                    if exact_in_float and np.abs(v).max() < 2**20 and v.shape[1] < 4096:
                        # All sums stay below 2^53, so the product in doubles is exact.
                        scores = (v.astype(float) @ matrix.T.astype(float)).astype(np.int64)
                    else:
                        scores = v @ matrix.T
                    for asked_id, mark, own, row in zip(part["id"], part["mark"], v, scores):
                        times = np.minimum(copies, k + 1)
                        same_id = np.flatnonzero(ids == asked_id)
                        times[same_id[(matrix[same_id] == own).all(axis=1)]] -= 1
                        others = np.flatnonzero(times)
                        order = others[np.argsort(-row[others], kind="stable")[:k]]
                        order = np.repeat(order, times[order])[:k]
                        found.append(
                            pd.DataFrame(
                                {
                                    "query_id": asked_id,
                                    "mark": mark,
                                    "id": ids[order],
                                    "score": row[order],
                                }
                            )
                        )
            if not found:
                return pd.DataFrame({"query_id": [], "mark": [], "id": [], "score": []})
            return pd.concat(found)

        scored = (
            routed.groupBy(*key)
            .cogroup(rows.groupBy(*key))
            .applyInPandas(best, "query_id bigint, mark string, id bigint, score bigint")
        )
        order = Window.partitionBy("query_id", "mark").orderBy(F.col("score").desc(), F.col("id"))
        return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def search(self, queries: DataFrame, k: int, blocks: int = 1) -> DataFrame:
        """``query_id, rank, id, score``: the k largest inner products per query, ties to smaller
        ids, never the query's own row. Queries are rows ``id, v, copies``; a row of several copies
        is as many queries."""
        block = F.pmod(F.xxhash64("id", "v"), F.lit(blocks)).alias("block")
        mark = F.md5(F.concat_ws(",", F.col("v").cast("array<string>")).cast("binary"))
        asked = queries.select("id", "v", "copies", block, mark.alias("mark"))
        first = self._look(asked, k, bounded=False)
        kth = first.groupBy(F.col("query_id").alias("id"), "mark").agg(
            F.when(F.count(F.lit(1)) == k, F.min("score")).alias("kth")
        )
        kth = freeze(kth, "vector-kth")
        found = self._look(asked.join(kth, ["id", "mark"], "left"), k, bounded=True)
        several = asked.where("copies > 1").select(F.col("id").alias("query_id"), "mark", "copies")
        times = F.coalesce("copies", F.lit(1)).cast("int")
        return (
            found.join(several, ["query_id", "mark"], "left")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), times)))
            .select("query_id", "rank", "id", "score")
        )


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    id_column: str = "vec_id",
    vector: str = "embedding",
    scale: int = 1024,
    pivots: int = PIVOTS,
    rings: int = RINGS,
) -> DataFrame:
    """``query_id, rank, id, score`` for the rows that ``is_query`` selects, against all rows.

    Null vectors, vectors with null or non-finite components, empty vectors and rows without an
    id take no part. Vectors are compared with those of their own length only. Every row is a
    candidate, and a query where selected, whether its id is repeated or not: a query leaves out
    its own row alone, and rows repeated with their vector come as often as they are there. Fewer
    than k other rows give fewer ranks; an empty table gives an empty table. The pivots are a
    sample of rows: ``pivots``, or more for large tables; every row is in the index, and the result
    is exact.
    """
    whole = integer_vectors(vectors, id_column, vector, scale)
    whole = whole.groupBy("id", "v").agg(F.count(F.lit(1)).alias("copies"))
    whole = freeze(whole, "vectors")
    index = PivotIndex(whole, pivots, rings)
    asked = whole.where(is_query)
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    return index.search(asked, k, blocks)
