"""Phrase collocations from word suffix trees, partitioned by word prefixes.

A suffix is what follows a word up to the end of its piece of text, cut to the longest phrase
asked for. Suffixes are added up as leaves of a tree; the number of times a phrase occurs is the
sum of the leaves below it. Trees are built per group of prefixes: a prefix of more leaves than
fit the memory budget is extended by its next word, and prefixes share a group up to the budget.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapmart.llm.common import whole
from tapmart.llm.tokens import Words, mix, pieces
from tapmart.session import freeze

UNDETERMINED = "und"
MIN_WORDS, MAX_WORDS = 2, 3
MIN_COUNT = 10
ABSORBED_PERCENT = 50
LIMIT = 2000
# Leaves of a tree that is built in one go, and of a prefix that shares its group with others.
GROUP_LEAVES = 1 << 20
PREFIX_LEAVES = GROUP_LEAVES // 8

# Words are numbered per run of at most this many, so that a number fits in _CODE_BITS bits.
_RUN_WORDS = 1 << 20
_CODE_BITS = 21
_TEXT_BYTES = 4 << 20
_COUNTED_BYTES = 1 << 20
# Pairs of words are counted in cells first. A part has 2 ** _PART_BITS cells and is for this many
# bytes of text, so cells are many times more than pairs, whatever the size of the corpus.
_PART_BITS = 26
_PART_BYTES = 16 << 20
# The cells that reach the count, as a map of bits with this bound (64 MB); false positives cost
# leaves, not correctness.
_MAP_BITS = 29
_PART_MAP_BITS = 21
# Cells a task holds before it sends them: two tasks of an executor sort as many at once.
_HELD_CELLS = 1 << 20

_BREAKS = b".,;:!?\n\x0b\x0c\r"
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[[0x20, 0x09]] = 1
_KIND[list(_BREAKS)] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_FIRST, _SECOND = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class Pieces:
    """The lower-cased words of some texts, in runs; null counts as empty.

    ``follows[i]`` tells whether word ``i + 1`` stands in the same piece of text as word ``i``.
    """

    def __init__(self, texts: pa.Array):
        texts = pa.concat_arrays([texts.fill_null("").cast(pa.large_string())])
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)
        offsets = offsets[texts.offset : texts.offset + len(texts) + 1]
        buffer = texts.buffers()[2]
        raw = np.frombuffer(buffer, np.uint8) if buffer else np.zeros(0, np.uint8)
        data = raw[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        kind = _KIND[data]
        full = kind == 0
        first, last = full.copy(), full.copy()
        first[1:] &= ~full[:-1]
        last[:-1] &= ~full[1:]
        opens = offsets[:-1][offsets[:-1] < len(full)]
        closes = offsets[1:][offsets[1:] > 0] - 1
        first[opens] = full[opens]
        last[closes] = full[closes]
        start = np.flatnonzero(first)
        self.ends = np.concatenate([[0], np.cumsum(np.flatnonzero(last) + 1 - start)])
        self.bytes = _LOWER[data[full]]
        text = np.searchsorted(offsets[1:], start, "right")
        breaks = np.searchsorted(np.flatnonzero(kind == 2), start)
        self.follows = np.zeros(len(start), dtype=bool)
        self.follows[:-1] = (text[1:] == text[:-1]) & (breaks[1:] == breaks[:-1])

    def runs(self, ahead: int) -> Iterator[tuple[int, np.ndarray, pa.Array, np.ndarray]]:
        """``count, codes, words, follows``: the suffixes that start at the first ``count`` words
        of the run, which has ``ahead`` words more if there are any."""
        total = len(self.follows)
        for low in range(0, total, _RUN_WORDS):
            high = min(low + _RUN_WORDS, total)
            stop = min(high + ahead, total)
            ends = self.ends[low : stop + 1]
            offsets, data = pa.py_buffer(ends - ends[0]), self.bytes[ends[0] : ends[-1]]
            words = pa.LargeStringArray.from_buffers(stop - low, offsets, pa.py_buffer(data))
            coded = words.dictionary_encode()
            codes = np.asarray(coded.indices, dtype=np.int64)
            yield high - low, codes, coded.dictionary, self.follows[low:stop]


def _by_language(
    batches: Iterator[pa.RecordBatch], most: int
) -> Iterator[tuple[str, Pieces]]:
    for batch in batches:
        for _, part in _parts(batch, most):
            langs = part.column("lang").dictionary_encode()
            codes = np.asarray(langs.indices)
            for code in np.unique(codes):
                yield langs.dictionary[code].as_py(), Pieces(
                    part.column("text").filter(pa.array(codes == code))
                )


def _parts(batch: pa.RecordBatch, most: int) -> Iterator[tuple[int, pa.RecordBatch]]:
    for start, texts in pieces(batch.column("text"), most):
        yield start, batch.slice(start, len(texts))


def _pair_cells(lang: str, words: pa.Array, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A 64-bit number per pair of words of the dictionary ``words``."""
    h = Words(words).hashes()
    own = np.uint64(np.frombuffer(lang.encode()[:8].ljust(8), np.uint64)[0])
    return mix(h[first] * _FIRST + h[second] * _SECOND + own)


# ----------------------------------------------------------------------- pairs that occur enough
def _cell_counts(parts: int, enough: int):
    """Per part of the cells, the cells this task has seen and how often, up to ``enough``.

    Cells are sorted and sent as differences, byte by byte, which the shuffle packs well.
    """
    shift = np.uint64(64 - _PART_BITS - int(math.log2(parts)))

    def packed(held: list[np.ndarray], counts: list[np.ndarray]) -> pa.RecordBatch:
        cells, inverse = np.unique(np.concatenate(held), return_inverse=True)
        total = np.bincount(inverse, np.concatenate(counts), len(cells))
        total = np.minimum(total, enough).astype(np.uint8)
        part = (cells >> np.uint64(_PART_BITS)).astype(np.int64)
        place = (cells & np.uint64((1 << _PART_BITS) - 1)).astype(np.uint32)
        numbers, starts = np.unique(part, return_index=True)
        stops = np.append(starts[1:], len(part))
        places = [
            np.diff(place[a:b], prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T.tobytes()
            for a, b in zip(starts, stops)
        ]
        return pa.RecordBatch.from_arrays(
            [
                pa.array(numbers, pa.int64()),
                pa.array(places, pa.binary()),
                pa.array([total[a:b].tobytes() for a, b in zip(starts, stops)], pa.binary()),
            ],
            ["part", "places", "counts"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts, size = [], [], 0
        for lang, texts in _by_language(batches, _COUNTED_BYTES):
            for count, codes, words, follows in texts.runs(1):
                at = np.flatnonzero(follows[:count])
                pair, times = np.unique(
                    codes[at] << _CODE_BITS | codes[at + 1], return_counts=True
                )
                first, second = pair >> _CODE_BITS, pair & ((1 << _CODE_BITS) - 1)
                held.append(_pair_cells(lang, words, first, second) >> shift)
                counts.append(np.minimum(times, enough).astype(np.uint8))
                size += len(pair)
                del codes, words, follows, at, pair, times, first, second
                if size > _HELD_CELLS:
                    yield packed(held, counts)
                    held, counts, size = [], [], 0
                    pa.default_memory_pool().release_unused()
        if size:
            yield packed(held, counts)

    return run


def _frequent_cells(enough: int, map_bits: int):
    """One part's cells that occur often enough, as a map of ``2 ** map_bits`` bits."""

    def run(table: pa.Table) -> pa.Table:
        places = [
            np.frombuffer(b, np.uint8).reshape(4, -1).T.copy().view(np.uint32).ravel()
            for b in table.column("places").to_pylist()
        ]
        places = np.concatenate([np.cumsum(p, dtype=np.int64) for p in places])
        counts = np.concatenate(
            [np.frombuffer(b, np.uint8) for b in table.column("counts").to_pylist()]
        )
        cells, inverse = np.unique(places, return_inverse=True)
        total = np.bincount(inverse, counts, len(cells))
        bits = np.zeros(1 << map_bits, dtype=bool)
        bits[cells[total >= enough] >> (_PART_BITS - map_bits)] = True
        return pa.table(
            {"part": table.column("part")[:1], "bits": pa.array([np.packbits(bits).tobytes()])}
        )

    return run


def _frequent_pairs(texts: DataFrame, size: int, enough: int) -> tuple[np.ndarray, int]:
    """A bit map over the cells of pairs of words, and by how much a pair's number is shifted.

    The number of cells grows with the text. The map has at most ``2 ** _MAP_BITS`` bits, several
    cells to a bit if need be: a pair that occurs ``enough`` times always has its bit set.
    """
    parts = 1 << max(0, math.ceil(math.log2(max(1, size) / _PART_BYTES)))
    map_bits = max(3, min(_PART_MAP_BITS, _MAP_BITS - int(math.log2(parts))))
    cells = texts.mapInArrow(
        _cell_counts(parts, enough), "part bigint, places binary, counts binary"
    )
    frequent = cells.groupBy("part").applyInArrow(
        _frequent_cells(enough, map_bits), "part bigint, bits binary"
    )
    found = np.zeros(parts << (map_bits - 3), dtype=np.uint8)
    width = 1 << (map_bits - 3)
    for row in frequent.toLocalIterator():
        found[row["part"] * width : (row["part"] + 1) * width] = np.frombuffer(row["bits"], np.uint8)
    return found, 64 - map_bits - int(math.log2(parts))


# ------------------------------------------------------------------------------------- the leaves
def _leaves(shared, shift: int, depth: int):
    """The suffixes of this task's texts as leaves: ``lang, phrase, total``.

    A suffix goes on to its next word only where the pair of words is in the map: a phrase cannot
    occur more often than its pairs. The words of a leaf are joined by blanks.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        for lang, texts in _by_language(batches, _TEXT_BYTES):
            for count, codes, words, follows in texts.runs(depth - 1):
                at = np.flatnonzero(follows)
                at = at[at + 1 < len(codes)]
                pair, where = np.unique(
                    codes[at] << _CODE_BITS | codes[at + 1], return_inverse=True
                )
                first, second = pair >> _CODE_BITS, pair & ((1 << _CODE_BITS) - 1)
                cell = _pair_cells(lang, words, first, second) >> np.uint64(shift)
                known = (bits[cell >> np.uint64(3)] >> (7 - (cell & np.uint64(7)))) & 1
                goes_on = np.zeros(len(codes), dtype=bool)
                goes_on[at] = known[where] == 1
                node, place = codes[:count], np.arange(count)
                phrases: pa.Array = words
                for step in range(1, depth + 1):
                    deeper = goes_on[place + step - 1] if step < depth else np.zeros(len(place), bool)
                    ends = np.bincount(node[~deeper], minlength=len(phrases))
                    leaf = np.flatnonzero(ends)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([lang], pa.string()).take(pa.array(np.zeros(len(leaf), int))),
                            phrases.take(pa.array(leaf)).cast(pa.string()),
                            pa.array(ends[leaf], pa.int64()),
                        ],
                        ["lang", "phrase", "total"],
                    )
                    place, parent = place[deeper], node[deeper]
                    if not len(place):
                        break
                    longer = parent << _CODE_BITS | codes[place + step]
                    key, node = np.unique(longer, return_inverse=True)
                    phrases = pc.binary_join_element_wise(
                        phrases.take(pa.array(key >> _CODE_BITS)),
                        words.take(pa.array(key & ((1 << _CODE_BITS) - 1))),
                        pa.scalar(" ", pa.large_string()),
                    )

    return run


# -------------------------------------------------------------------------------------- the trees
def _prefix(phrase: Column, words: int) -> Column:
    return F.substring_index(phrase, " ", words)


def _grouped(leaves: DataFrame, depth: int, group_leaves: int, prefix_leaves: int) -> DataFrame:
    """``leaves`` with the ``prefix_words`` of the prefix they are grouped by, and its ``group``.

    A prefix over the budget is extended by one word, again and again up to whole leaves. The
    table of such prefixes has at most leaves / budget rows per length. Prefixes are dealt to as
    many groups as give half a budget each on average.
    """
    length = F.lit(1)
    grouped = leaves
    for words in range(1, depth):
        large = (
            grouped.where(length == words)
            .groupBy("lang", _prefix(F.col("phrase"), words).alias("_large"))
            .agg(F.count(F.lit(1)).alias("_leaves"))
            .where(F.col("_leaves") > prefix_leaves)
        )
        large = freeze(large.select("lang", "_large"), "phrase-prefixes")
        if large.isEmpty():
            break
        grouped = grouped.withColumn("_prefix", _prefix(F.col("phrase"), words))
        marked = large.select(F.col("lang").alias("_lang"), "_large")
        same = (F.col("lang") == F.col("_lang")) & (F.col("_prefix") == F.col("_large"))
        grouped = grouped.join(marked, same, "left")
        is_longer = F.coalesce(F.col("_large").isNotNull(), F.lit(False))
        grouped = grouped.withColumn(
            "prefix_words", F.when((length == words) & is_longer, words + 1).otherwise(length)
        ).drop("_lang", "_large", "_prefix")
        length = F.col("prefix_words")
    groups = max(1, -(-2 * leaves.count() // group_leaves))
    prefix = F.call_function("substring_index", F.col("phrase"), F.lit(" "), length)
    return grouped.withColumn("prefix_words", length).withColumn(
        "group", F.pmod(F.xxhash64("lang", prefix), F.lit(groups))
    )


def _subtree(depth: int, enough: int):
    """The nodes of one group's tree with the totals of the leaves below them.

    Sorted leaves with the words they share with the one before are the tree: a node of n words
    begins where fewer than n are shared. Nodes below a prefix are whole and go only on if they
    occur often enough; nodes above it have leaves in other groups too.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        split = pc.split_pattern(table.column("phrase").combine_chunks(), " ")
        lengths = np.asarray(split.value_lengths())
        begins = np.cumsum(lengths) - lengths
        codes = np.asarray(split.flatten().dictionary_encode().indices, dtype=np.int64)
        lang = np.asarray(table.column("lang").combine_chunks().dictionary_encode().indices)
        words = np.full((depth, len(lengths)), -1, dtype=np.int64)
        for n in range(depth):
            has = lengths > n
            words[n, has] = codes[begins[has] + n]
        order = np.lexsort([*words[::-1], lang])
        words, lang, lengths = words[:, order], lang[order], lengths[order]
        total = np.asarray(table.column("total"))[order]
        prefix_words = np.asarray(table.column("prefix_words"))[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = lang[1:] != lang[:-1]
        found: dict[str, list] = {"row": [], "words": [], "total": []}
        for n in range(1, depth + 1):
            new[1:] |= words[n - 1, 1:] != words[n - 1, :-1]
            starts = np.flatnonzero(new)
            if not len(starts):
                break
            sums = np.add.reduceat(total, starts)
            real = lengths[starts] >= n
            kept = real & ((prefix_words[starts] > n) | (sums >= enough))
            found["row"].append(order[starts[kept]])
            found["words"].append(np.full(int(kept.sum()), n))
            found["total"].append(sums[kept])
        rows, count = np.concatenate(found["row"]), np.concatenate(found["words"])
        phrases = table.column("phrase").combine_chunks().take(pa.array(rows))
        parts = pc.split_pattern(phrases, " ")
        ends = np.asarray(parts.value_lengths())
        if len(rows) and (ends > count).any():
            flat, firsts = parts.flatten(), np.cumsum(ends) - ends
            place = np.repeat(firsts, count) + np.arange(count.sum()) - np.repeat(
                np.cumsum(count) - count, count
            )
            offsets = pa.array(np.concatenate([[0], np.cumsum(count)]), pa.int32())
            lists = pa.ListArray.from_arrays(offsets, flat.take(pa.array(place)))
            phrases = pc.binary_join(lists, " ")
        return pa.table(
            {
                "lang": table.column("lang").combine_chunks().take(pa.array(rows)),
                "phrase": phrases.cast(pa.string()),
                "words": pa.array(count, pa.int32()),
                "total": pa.array(np.concatenate(found["total"]), pa.int64()),
            }
        )

    return run


def count_phrases(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    group_leaves: int = GROUP_LEAVES,
    prefix_leaves: int = PREFIX_LEAVES,
) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, total`` of all phrases of up to ``max_words`` words that occur at
    least ``min_count`` times in a language, and ``lang, n``: its number of words."""
    if not 1 <= min_count <= 255:
        raise ValueError("min_count must be from 1 to 255")
    texts = docs.select(
        F.coalesce(F.col(lang).cast("string"), F.lit(UNDETERMINED)).alias("lang"),
        whole(F.col(text)).alias("text"),
    ).where("text <> ''")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits, shift = _frequent_pairs(texts, size, min_count)
    shared = docs.sparkSession.sparkContext.broadcast(bits.tobytes())
    leaves = texts.mapInArrow(
        _leaves(shared, shift, max_words), "lang string, phrase string, total bigint"
    )
    leaves = leaves.groupBy("lang", "phrase").agg(F.sum("total").alias("total"))
    leaves = freeze(leaves, "phrase-leaves")
    n = leaves.groupBy("lang").agg(F.sum("total").alias("n"))
    grouped = _grouped(leaves, max_words, group_leaves, prefix_leaves)
    nodes = grouped.groupBy("group").applyInArrow(
        _subtree(max_words, min_count), "lang string, phrase string, words int, total bigint"
    )
    nodes = nodes.groupBy("lang", "phrase", "words").agg(F.sum("total").alias("total"))
    return freeze(nodes.where(F.col("total") >= min_count), "phrase-nodes"), n


def collocations(
    docs: DataFrame,
    text: str = "text",
    lang: str = "lang",
    min_words: int = MIN_WORDS,
    max_words: int = MAX_WORDS,
    min_count: int = MIN_COUNT,
    absorbed_percent: int = ABSORBED_PERCENT,
    limit: int = LIMIT,
    group_leaves: int = GROUP_LEAVES,
    prefix_leaves: int = PREFIX_LEAVES,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the phrases of each language that hold together.

    Texts are lower-cased (A-Z) and cut at ``.,;:!?`` and line ends into pieces; words are what
    blanks and tabs leave of these. A candidate has ``min_words`` to ``max_words`` words and occurs
    ``a >= min_count`` times. Of its cuts into two parts that occur l and r times, the one of lowest
    score floor(10^6 a a / (l r)) counts, of equal ones the first. A candidate inside a longer one
    that has at least ``absorbed_percent`` of its occurrences is dropped. The first ``limit`` of a
    language are returned, by score, then a, then phrase.

    A null language counts as ``und``; null and empty texts have no words. Repeated rows count as
    often as they occur, and so do copies. Other columns play no part. An empty table, and a
    language without candidates, give no rows. Counts are exact.
    """
    nodes, n = count_phrases(
        docs, text, lang, max_words, min_count, group_leaves, prefix_leaves
    )
    words = F.split("phrase", " ")

    def part(start: Column, length: Column) -> Column:
        return F.array_join(F.slice(words, start, length), " ")

    candidates = nodes.where(F.col("words") >= min_words)
    count = F.col("words")
    inner = F.explode(F.sequence(F.lit(min_words), count - 1)).alias("_length")
    inside = (
        candidates.where(count > min_words)
        .select("lang", "phrase", "words", "total", inner)
        .select("*", F.explode(F.sequence(F.lit(1), count - F.col("_length") + 1)).alias("_start"))
        .groupBy("lang", part(F.col("_start"), F.col("_length")).alias("phrase"))
        .agg(F.max("total").alias("_longer"))
    )
    absorbed = F.lit(100) * F.coalesce("_longer", F.lit(0)) >= F.lit(absorbed_percent) * F.col("total")
    kept = candidates.join(inside, ["lang", "phrase"], "left").where(
        F.col("_longer").isNull() | ~absorbed
    )
    cuts = kept.select(
        "lang", "phrase", "words", "total", F.explode(F.sequence(F.lit(1), count - 1)).alias("k")
    )
    cuts = cuts.select(
        "lang",
        "phrase",
        F.col("total").alias("a"),
        "k",
        part(F.lit(1), F.col("k")).alias("_left"),
        part(F.col("k") + 1, count - F.col("k")).alias("_right"),
    )
    left = nodes.select("lang", F.col("phrase").alias("_left"), F.col("total").alias("l"))
    right = nodes.select("lang", F.col("phrase").alias("_right"), F.col("total").alias("r"))
    cuts = cuts.join(left, ["lang", "_left"]).join(right, ["lang", "_right"])
    exact = {name: F.col(name).cast("decimal(15,0)") for name in "alr"}
    above = exact["a"] * exact["a"] * F.lit(1_000_000).cast("decimal(7,0)")
    below = exact["l"] * exact["r"]
    scored = cuts.withColumns({"_above": above, "_below": below}).withColumn(
        "score", F.expr("_above div _below").cast("bigint")
    )
    lowest = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("_cut")
    judged = scored.groupBy("lang", "phrase", "a").agg(lowest)
    judged = judged.select("lang", "phrase", "a", "_cut.l", "_cut.r", "_cut.score")
    return _ranked(judged, limit).join(n, "lang").select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )


def _ranked(judged: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` per language, first within shares of a language, then among these."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    share = F.pmod(F.xxhash64("phrase"), F.lit(64))
    judged = judged.withColumn("_share", share)
    within = F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*order))
    few = judged.withColumn("rank", within).where(F.col("rank") <= limit)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    return few.withColumn("rank", rank).where(F.col("rank") <= limit).drop("_share")
