"""Line deduplication: lines that many documents share lose all their copies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapmart.llm.common import SPACES, lower_ascii, whole
from tapmart.session import freeze

MIN_DOCUMENTS = 10
MIN_CHARACTERS = 1


def line_key(line: Column) -> Column:
    return lower_ascii(F.btrim(line, F.lit(SPACES)))


def drop_common_lines(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    min_documents: int = MIN_DOCUMENTS,
    min_characters: int = MIN_CHARACTERS,
) -> DataFrame:
    r"""Every row of ``docs`` with ``line_kept_text``, ``line_count`` and ``line_dropped`` added.

    A text is split at ``\n``; a null or empty text is one empty line. Lines are compared by their
    key (white space off both ends, A-Z lower-cased). A key of at least ``min_characters`` code
    points that occurs in at least ``min_documents`` documents loses all its lines, everywhere. All
    rows under one id are one document in that count, whether their texts are equal or not; rows
    without an id are one document per text. Nulls in other columns, and further columns, are
    passed through; an empty table gives an empty table. Columns of the three names are replaced.

    The keys' digests are written once, as one array per row. Counting takes a digest once per row
    and adds up before the shuffle, so a line that every document has costs one row per task; only
    rows under repeated ids are told apart by id first. The common digests are written as well, so
    that their size is known: they are broadcast to the positions if small, else joined with hot
    ones split at run time. Only rows that lose lines are put together anew. Texts are shuffled
    once.
    """
    ours = ["line_kept_text", "line_count", "line_dropped", "_lines", "_row", "_dropped"]
    docs = docs.drop(*ours)
    content = whole(F.col(text))
    row = F.md5(F.concat_ws("\x00", F.col(id_column).cast("string"), content).cast("binary"))
    split = docs.withColumn("_row", row).withColumn("_lines", F.split(content, "\n", -1))

    def digest(line: Column) -> Column:
        key = line_key(line)
        return F.when(F.char_length(key) >= min_characters, F.md5(key.cast("binary")))

    one = F.coalesce(F.concat(F.lit("i"), F.col(id_column).cast("string")), row)
    digests = split.select("_row", one.alias("_doc"), F.transform("_lines", digest).alias("digests"))
    digests = freeze(digests, "line-digests")
    repeated = digests.groupBy("_doc").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    repeated = freeze(repeated.select("_doc"), "line-repeated-ids")
    each = F.explode(F.array_distinct("digests")).alias("digest")
    alone = digests.join(repeated, "_doc", "left_anti").select(each)
    together = digests.join(repeated, "_doc", "left_semi").select("_doc", each).distinct()
    common = (
        alone.union(together.select("digest"))
        .where("digest IS NOT NULL")
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("documents"))
        .where(F.col("documents") >= min_documents)
        .select("digest")
    )
    common = freeze(common, "line-common")
    dropped = (
        digests.select("_row", F.posexplode("digests").alias("position", "digest"))
        .where("digest IS NOT NULL")
        .join(common, "digest", "left_semi")
        .groupBy("_row")
        .agg(F.sort_array(F.collect_set("position")).alias("_dropped"))
    )
    cut = F.size("_dropped")
    count = F.size("_lines")

    def run_between(i: Column) -> Column:
        """The lines after the dropped line i - 1 and before the dropped line i."""
        start = F.coalesce(F.get("_dropped", i - 1) + 1, F.lit(0))
        end = F.coalesce(F.get("_dropped", i), count)
        return F.slice("_lines", start + 1, end - start)

    kept = F.flatten(F.transform(F.sequence(F.lit(0), cut), run_between))
    return (
        split.join(dropped, "_row", "left")
        .withColumn(
            "line_kept_text",
            F.array_join(F.when(F.col("_dropped").isNull(), F.col("_lines")).otherwise(kept), "\n"),
        )
        .withColumn("line_count", count.cast("bigint"))
        .withColumn("line_dropped", F.coalesce(cut, F.lit(0)).cast("bigint"))
        .drop("_lines", "_row", "_dropped")
    )
