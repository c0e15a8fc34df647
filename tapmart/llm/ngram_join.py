"""Set similarity join on word shingles with PartEnum signatures."""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tapmart.llm.common import giving_back
from tapmart.llm.components import components
from tapmart.llm.tokens import Words, mix, pieces
from tapmart.session import SMALL_BATCHES, freeze

# The name it had while it was part of this module.
_giving_back = giving_back
WIDTH = 3
PERCENT = 90
# Fixed sizes of what all tasks get: bits of the map of candidates, cells of the element counts.
MAP_BITS = 27
SKETCH_BITS = 22
SKETCH_PARTS = 64
# Sets of one element that are paired one by one; sets of a block where there are more.
CROWD = 32
BLOCK = 128
# Crowded elements a set carries, so that a pair of sets which share several is found at one.
FIRSTS = 8
_DOC, _PACK, _MEMBER = 0, 1, 2
_ROWS = pa.schema(
    [
        ("kind", pa.int32()),
        ("place", pa.int32()),
        ("id", pa.int64()),
        ("node", pa.int64()),
        ("proof", pa.int64()),
        ("size", pa.int64()),
        ("signature", pa.int64()),
        ("signatures", pa.binary()),
        ("nodes", pa.binary()),
    ]
)
_ROWS_DDL = (
    "kind int, place int, id bigint, node bigint, proof bigint, size bigint, signature bigint, "
    "signatures binary, nodes binary"
)
_SKETCH_COLUMNS = ["s0", "s1", "s2", "s3"]
_SET_COLUMNS = ["node", "component", "size", *_SKETCH_COLUMNS]
_FIRST_COLUMNS = [f"f{i}" for i in range(FIRSTS)]
_NONE = (1 << 63) - 1


class PartEnum:
    """Signatures such that sets with Jaccard similarity of ``percent`` or more share one.

    Sizes are cut into bands so that similar sets lie in one band or in neighbours; a set gives
    signatures for its own band and for the next. In a band whose largest size is r, similar sets
    differ in at most ``k = 2 r (100 - percent) / (100 + percent)`` elements. The domain is cut
    into ``n1`` parts by a hash. Differences are too few to reach ``depth + 1`` in each of them, so
    in some part the sets differ in ``depth`` elements at most; that part is cut into ``n2``, and
    they agree on all of some subset of ``n2 - depth`` of these. Every subset is a signature.

    A part without elements says little, and all sets lack some. Hence there are ``spare`` parts
    more than needed: similar sets then agree in at least ``spare + 1`` parts, and a set that has
    no more than ``spare`` empty signatures of a kind need not give these. Nothing is lost: if two
    sets agree on empty ones only, both have more than ``spare`` and give them.
    """

    def __init__(self, percent: int, depth: int = 0, n2: int = 1):
        self.percent, self.depth, self.n2 = percent, depth, n2
        self.subsets = list(itertools.combinations(range(n2), n2 - depth))

    @lru_cache(maxsize=None)
    def band(self, size: int) -> int:
        number, low = 0, 1
        while (high := 100 * low // self.percent) < size:
            number, low = number + 1, high + 1
        return number

    @lru_cache(maxsize=None)
    def shape(self, band: int) -> tuple[int, int]:
        """Parts of the first level, and how many of them are spare."""
        low = 1
        for _ in range(band):
            low = 100 * low // self.percent + 1
        most = 2 * (100 * low // self.percent) * (100 - self.percent) // (100 + self.percent)
        needed = -(-(most + 1) // (self.depth + 1))
        per_part = max(low * 0.8, 1) / needed
        spare = int(np.ceil(needed * np.exp(-per_part) * 1.5)) if needed > 1 else 0
        return needed + spare, spare

    def signatures(self, elements: np.ndarray) -> np.ndarray:
        own = self.band(len(elements))
        found = [self._of_band(elements, band) for band in (own, own + 1)]
        return np.concatenate(found)

    def _of_band(self, elements: np.ndarray, band: int) -> np.ndarray:
        n1, spare = self.shape(band)
        cells = n1 * self.n2
        spread = mix(elements ^ np.uint64(band * 2 + 1))
        cell = (spread % np.uint64(cells)).astype(np.int64)
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        filled, at = np.unique(cell, return_index=True)
        sums = np.zeros(cells, dtype=np.uint64)
        sums[filled] = np.add.reduceat(mix(spread[order]), at)
        counts = np.bincount(cell, minlength=cells)
        sums, counts = sums.reshape(n1, self.n2), counts.reshape(n1, self.n2)
        part = np.arange(n1, dtype=np.uint64)
        found = []
        for number, subset in enumerate(self.subsets):
            tag = np.uint64((band << 20) + (number << 8) + 7)
            value = np.full(n1, tag, dtype=np.uint64)
            for column in subset:
                value = mix(value + sums[:, column] * np.uint64(2 * column + 3))
            value = mix(value ^ (part * np.uint64(0x9E3779B97F4A7C15)))
            empty = counts[:, list(subset)].sum(axis=1) == 0
            found.append(value if empty.sum() > spare else value[~empty])
        return np.concatenate(found)


def _signed(x) -> np.ndarray:
    return np.asarray(x, dtype=np.uint64).view(np.int64)


def fingerprint(elements: np.ndarray) -> tuple[int, int]:
    """Two independent numbers of a set: its name as a node, and a proof of that name."""
    name = mix(elements ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64)
    proof = np.bitwise_xor.reduce(mix(elements + np.uint64(0x51ED27))) + np.uint64(len(elements))
    return int(_signed(mix(np.array([name])))[0]), int(_signed([proof])[0])


def _rows(kind: int, n: int, **columns) -> pa.RecordBatch:
    arrays = []
    for field in _ROWS:
        if field.name == "kind":
            arrays.append(pa.array(np.full(n, kind, dtype=np.int32)))
        elif field.name in columns:
            arrays.append(pa.array(columns[field.name], type=field.type))
        else:
            arrays.append(pa.nulls(n, field.type))
    return pa.RecordBatch.from_arrays(arrays, schema=_ROWS)


def _signatures_of(width: int, percent: int, depth: int, n2: int, places: int):
    """Texts to rows of three kinds: a document, a pack of signatures for one place, a member.

    Within a batch a set is taken once, and a signature travels once. If several sets of the batch
    have it, they are members of its bucket already; one of them stands for all elsewhere. So
    however common a signature is, a task sends it once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scheme = PartEnum(percent, depth, n2)
        for batch in batches:
            if not batch.num_rows:
                continue
            nodes, proofs, sizes = [], [], []
            known: set[int] = set()
            found, owners = [], []
            for _, part in pieces(batch.column("text")):
                for elements in Words(part).shingles(width):
                    sizes.append(len(elements))
                    if not len(elements):
                        nodes.append(None)
                        proofs.append(None)
                        continue
                    node, proof = fingerprint(elements)
                    nodes.append(node)
                    proofs.append(proof)
                    if node not in known:
                        known.add(node)
                        made = scheme.signatures(elements)
                        found.append(made)
                        owners.append(np.full(len(made), node, dtype=np.int64))
            at = np.full(batch.num_rows, -1, dtype=np.int32)
            at[:] = np.arange(batch.num_rows) % places
            yield _rows(
                _DOC, batch.num_rows, place=at, id=batch.column("id"), node=nodes, proof=proofs,
                size=sizes,
            )
            if not found:
                continue
            signature, owner = np.concatenate(found), np.concatenate(owners)
            signature, owner, shared = _buckets(signature, owner)
            if shared.any():
                yield _rows(
                    _MEMBER, int(shared.sum()), signature=_signed(signature[shared]),
                    node=owner[shared], place=(signature[shared] % np.uint64(places)).astype(np.int32),
                )
            once = np.ones(len(signature), dtype=bool)
            once[1:] = signature[1:] != signature[:-1]
            signature, owner = signature[once], owner[once]
            place = (signature % np.uint64(places)).astype(np.int64)
            order = np.lexsort((owner, place))
            signature, owner, place = signature[order], owner[order], place[order]
            filled, starts = np.unique(place, return_index=True)
            ends = np.append(starts[1:], len(place))
            yield _rows(
                _PACK, len(filled), place=filled.astype(np.int32),
                signatures=[signature[a:b].tobytes() for a, b in zip(starts, ends)],
                nodes=[owner[a:b].tobytes() for a, b in zip(starts, ends)],
            )

    return run


def _buckets(signature: np.ndarray, owner: np.ndarray):
    """Sorted by signature and owner, without repeats, and which signatures have several owners."""
    order = np.lexsort((owner, signature))
    signature, owner = signature[order], owner[order]
    new = np.ones(len(signature), dtype=bool)
    new[1:] = (signature[1:] != signature[:-1]) | (owner[1:] != owner[:-1])
    signature, owner = signature[new], owner[new]
    same = signature[1:] == signature[:-1]
    shared = np.zeros(len(signature), dtype=bool)
    shared[1:] |= same
    shared[:-1] |= same
    return signature, owner, shared


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pass documents and members on; find the signatures that come in several packs."""
    signatures, nodes = [], []
    for batch in batches:
        is_pack = pc.equal(batch.column("kind"), _PACK)
        for a, b in zip(
            batch.filter(is_pack).column("signatures"), batch.filter(is_pack).column("nodes")
        ):
            signatures.append(np.frombuffer(a.as_py(), dtype=np.uint64))
            nodes.append(np.frombuffer(b.as_py(), dtype=np.int64))
        rest = batch.filter(pc.invert(is_pack))
        if rest.num_rows:
            yield rest
    if signatures:
        signature, owner, shared = _buckets(np.concatenate(signatures), np.concatenate(nodes))
        signature, owner = signature[shared], owner[shared]
        for start in range(0, len(signature), 100_000):
            part = slice(start, start + 100_000)
            yield _rows(
                _MEMBER, len(signature[part]), signature=_signed(signature[part]), node=owner[part]
            )


def _named(texts: pa.Array, width: int) -> Iterator[tuple[int, int, np.ndarray]]:
    """``row, node, elements`` of the texts that have words."""
    for start, part in pieces(texts):
        for row, elements in enumerate(Words(part).shingles(width), start):
            if len(elements):
                yield row, fingerprint(elements)[0], elements


def _named_rows(width: int, shared=None, shift: int = 0):
    """Rows with the ``node`` of their text, null without words.

    With ``shared``, a map of bits over the nodes, only rows whose bit is set go on, and of the
    rows of a batch with equal sets only the first.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if shared is None else np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            nodes: list[int | None] = [None] * batch.num_rows
            for row, node, _ in _named(batch.column("text"), width):
                nodes[row] = node
            column = pa.array(nodes, pa.int64())
            made = pa.RecordBatch.from_arrays(
                [*batch.columns, column], [*batch.schema.names, "node"]
            )
            if bits is not None:
                given = np.asarray(column.fill_null(0))
                on = _on_map(given, bits, shift)
                first = np.zeros(len(given), dtype=bool)
                first[np.unique(given, return_index=True)[1]] = True
                made = made.filter(pa.array(on & first & np.asarray(column.is_valid())))
            yield made

    return run


def _node_map(nodes: DataFrame, count: int) -> tuple[bytes, int]:
    """A map of bits that is set for every node, and by how much a node is shifted to its bit.

    At most ``2 ** MAP_BITS`` bits come to the driver, whatever the number of nodes; false
    positives are sorted out by a join.
    """
    width = min(MAP_BITS, max(10, int(np.ceil(np.log2(max(count, 1)))) + 4))
    at = F.shiftrightunsigned("node", 64 - width)
    bit = F.call_function(
        "shiftleft", F.lit(1).cast("bigint"), at.bitwiseAND(F.lit(63)).cast("int")
    )
    words = nodes.select(F.shiftright(at, 6).alias("word"), bit.alias("bits"))
    found = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(1 << (width - 6), dtype=np.int64)
    bits[np.asarray(found.column("word"))] = np.asarray(found.column("bits"))
    return bits.tobytes(), 64 - width


def _on_map(nodes: np.ndarray, bits: np.ndarray, shift: int) -> np.ndarray:
    place = nodes.view(np.uint64) >> np.uint64(shift)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7))) & 1 == 1


def _sets_of(width: int):
    """The set of every text, with its size and parity sketch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, part in pieces(batch.column("text")):
                made = Words(part).shingles(width)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("node").slice(start, len(part)),
                        pa.array([x.tobytes() for x in made], type=pa.binary()),
                        pa.array([len(x) for x in made], type=pa.int64()),
                        *map(pa.array, _sketches(made).T),
                    ],
                    ["node", "elements", "size", *_SKETCH_COLUMNS],
                )

    return run


def _sketches(sets: list[np.ndarray]) -> np.ndarray:
    """Per set whether an even or odd number of its elements falls on each of 256 bits.

    Two sets that differ in d elements differ in at most d of these bits.
    """
    words = np.zeros((len(sets), 4), dtype=np.int64)
    for row, elements in enumerate(sets):
        at = (mix(elements) & np.uint64(255)).astype(np.int64)
        odd = (np.bincount(at, minlength=256) & 1).astype(np.uint8)
        words[row] = np.packbits(odd).view(np.int64)
    return words


def _cells(elements: np.ndarray) -> np.ndarray:
    return (mix(elements ^ np.uint64(0x7A3D)) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _cell_counts(shared, shift: int):
    """How many elements of this task's open sets fall on each cell, by part of the cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.frombuffer(shared.value, np.uint8)
        total = np.zeros(1 << SKETCH_BITS, dtype=np.uint32)
        for batch in batches:
            on = _on_map(batch.column("node").to_numpy(), bits, shift)
            for data in batch.column("elements").filter(pa.array(on)):
                np.add.at(total, _cells(np.frombuffer(data.as_py(), np.uint64)), 1)
        parts = total.reshape(SKETCH_PARTS, -1)
        some = np.flatnonzero(parts.any(axis=1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array([_packed(parts[i]) for i in some], pa.binary())],
            ["part", "counts"],
        )

    return run


def _packed(counts: np.ndarray) -> bytes:
    """Numbers byte by byte: the upper bytes are zero almost everywhere and pack well. Where few
    are not zero, these alone, after their places."""
    some = np.flatnonzero(counts)
    if 16 * len(some) < len(counts):
        return some.astype(np.uint32).tobytes() + counts[some].astype(np.uint32).tobytes()
    return counts.astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()


def _add_packed(total: np.ndarray, data: bytes) -> None:
    if len(data) < 4 * len(total):
        some, counts = np.frombuffer(data, np.uint32).reshape(2, -1)
        total[some] += counts
    else:
        planes = np.frombuffer(data, np.uint8).reshape(4, -1)
        total += planes.T.copy().view(np.uint32).ravel()


def _cell_sums(table: pa.Table) -> pa.Table:
    """The counts of one part over all tasks, as a level: what matters is the order alone."""
    total = np.zeros((1 << SKETCH_BITS) // SKETCH_PARTS, dtype=np.int64)
    for data in table.column("counts"):
        _add_packed(total, data.as_py())
    level = np.minimum(np.where(total < 128, total, 96 + 16 * np.log2(np.maximum(total, 1)) / 3.5), 255)
    return pa.table({"part": table.column("part")[:1], "levels": pa.array([level.astype(np.uint8).tobytes()])})


def _first_elements(levels_of_cells, shared, shift: int, percent: int):
    """Of every open set the first elements, those of rarely used cells first, one row each.

    As many as a similar set may lack, and one: two similar sets share one of these, whatever the
    order, as long as it is the same for all sets.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = np.frombuffer(levels_of_cells.value, np.uint8)
        bits = np.frombuffer(shared.value, np.uint8)
        for batch in batches:
            batch = batch.filter(pa.array(_on_map(batch.column("node").to_numpy(), bits, shift)))
            found, lengths, sizes = [], [], []
            for data in batch.column("elements"):
                elements = np.frombuffer(data.as_py(), np.uint64)
                few = len(elements) - -(-len(elements) * percent // 100) + 1
                order = np.lexsort((elements, levels[_cells(elements)]))[:few]
                found.append(elements[order])
                lengths.append(few)
                sizes.append(len(elements))
            if not found:
                continue
            made = pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(batch.column("node").to_numpy(), lengths)),
                 pa.array(_signed(np.concatenate(found))),
                 pa.array(np.repeat(np.array(sizes, dtype=np.int64), lengths))],
                ["node", "element", "size"],
            )
            for start in range(0, made.num_rows, 100_000):
                yield made.slice(start, 100_000)

    return run


def _rarest_elements(sets: DataFrame, still_open: DataFrame, percent: int) -> DataFrame:
    """The first elements of the open sets, ``node, element, size, component``, rarest first.

    Sets stay where they lie: a map of bits tells which are open, and only their first elements
    meet ``still_open``. The order is by a count of elements in cells, a fixed number of cells for
    all tasks. False positives of the map may count too, as any one order does.
    """
    context = sets.sparkSession.sparkContext
    bits, shift = _node_map(still_open.select("node"), still_open.count())
    shared = context.broadcast(bits)
    sets = sets.select("node", "elements")
    counts = sets.mapInArrow(giving_back(_cell_counts(shared, shift)), "part int, counts binary")
    sums = counts.groupBy("part").applyInArrow(_cell_sums, "part int, levels binary")
    levels = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), dtype=np.uint8)
    for row in freeze(sums, "ngram-levels", settings=SMALL_BATCHES).collect():
        levels[row["part"]] = np.frombuffer(row["levels"], np.uint8)
    first = sets.mapInArrow(
        giving_back(
            _first_elements(context.broadcast(levels.tobytes()), shared, shift, percent)
        ),
        "node bigint, element bigint, size bigint",
    )
    return first.join(still_open, "node")


def _few_differences(percent: int):
    """Whether the sizes and parity sketches of two rows allow so few differences."""
    apart = sum(F.bit_count(F.col(c).bitwiseXOR(F.col(f"other_{c}"))) for c in _SKETCH_COLUMNS)
    small, large = F.least("size", "other_size"), F.greatest("size", "other_size")
    return (100 * small >= percent * large) & (
        (100 + percent) * apart <= (100 - percent) * (small + large)
    )


def _may_be_similar(percent: int):
    """The same of sets of different components."""
    return (F.col("component") != F.col("other_component")) & _few_differences(percent)


def _as_pairs(rows: DataFrame) -> DataFrame:
    low, high = F.least("node", "other_node"), F.greatest("node", "other_node")
    return rows.select(low.alias("a"), high.alias("b")).distinct()


def _others(*columns) -> list:
    return [F.col(c).alias(f"other_{n}") for c, n in zip(columns, _SET_COLUMNS)]


def _centre_rounds(crowded: DataFrame, link, percent: int) -> tuple[DataFrame, list[DataFrame]]:
    """Rows of crowded elements whose sets are still apart, and the links found on the way.

    In a round all sets of an element are compared with one of them, and components that are linked
    become one. An element whose sets are all in one component needs no more comparing. Rounds go
    on as long as they link anything and each leaves at most half of the rows.
    """
    links: list[DataFrame] = []
    left = crowded.count()
    while left:
        order = F.struct(F.xxhash64("node"), "node")
        centres = crowded.groupBy("element").agg(
            F.min_by(F.struct(*_SET_COLUMNS), order).alias("centre")
        )
        centres = centres.select("element", *_others(*[f"centre.{n}" for n in _SET_COLUMNS]))
        met = crowded.join(centres, "element").where(_may_be_similar(percent))
        made = link(_as_pairs(met))
        if made.isEmpty():
            break
        links.append(made)
        moved = _merged(made, crowded.select("node", "component").distinct())
        crowded = crowded.join(moved, "component", "left")
        crowded = crowded.withColumn("component", F.coalesce("to", "component")).drop("to")
        crowded = freeze(_across(crowded), "ngram-crowded")
        before, left = left, crowded.count()
        if 2 * left > before:
            break
    return crowded, links


def _merged(links: DataFrame, own: DataFrame) -> DataFrame:
    """For each ``component`` of ``own`` that links lead out of, the least one ``to`` reach."""
    between = links.join(own.select(F.col("node").alias("a"), F.col("component").alias("of_a")), "a")
    between = between.join(own.select(F.col("node").alias("b"), F.col("component").alias("of_b")), "b")
    between = between.select(F.col("of_a").alias("a"), F.col("of_b").alias("b"))
    return components(between).select(F.col("node").alias("component"), F.col("component").alias("to"))


def _across(rows: DataFrame) -> DataFrame:
    """Rows of elements whose sets lie in several components, with the number of these sets."""
    across = (
        rows.groupBy("element")
        .agg(
            F.min("component").alias("low"),
            F.max("component").alias("high"),
            F.count(F.lit(1)).alias("many"),
        )
        .where("low < high")
        .select("element", "many")
    )
    return rows.drop("many").join(across, "element")


def _block_pairs(crowded: DataFrame, percent: int) -> DataFrame:
    """Pairs of sets of crowded elements that may be similar, block of sets against block.

    The sets of an element lie in blocks of about ``BLOCK`` by a hash. A block goes to every block
    from its own on, so the comparing is spread by element and block; pairs that are told apart by
    size or sketch never are rows. Similar sets share most of their elements. A set carries the
    first few of its crowded ones, and a pair that both sets' few tell to share an earlier element
    is left to that one; it is never lost, as the earliest element of all that two sets share is
    left to none.
    """
    firsts = crowded.groupBy(F.col("node").alias("_node")).agg(
        F.slice(F.sort_array(F.collect_list("element")), 1, FIRSTS).alias("firsts")
    )
    blocks = F.ceil(F.col("many") / BLOCK)
    rows = crowded.join(firsts, F.col("node") == F.col("_node")).withColumn("last", blocks - 1)
    rows = rows.withColumn("block", F.pmod(F.xxhash64("node"), blocks))
    few = [
        F.coalesce(F.get("firsts", F.lit(i)), F.lit(_NONE)).alias(name)
        for i, name in enumerate(_FIRST_COLUMNS)
    ]
    packed = rows.groupBy("element", "last", "block").agg(
        F.collect_list(F.struct(*_SET_COLUMNS, *few)).alias("own")
    )
    sent = packed.select(
        "element", "own", F.col("block").alias("from"),
        F.explode(F.sequence("block", "last")).alias("block"),
    )
    there = packed.select("element", "block", F.col("own").alias("others"))
    met = sent.join(there, ["element", "block"])
    met = met.select("element", (F.col("from") == F.col("block")).alias("same"), "own", "others")
    return met.mapInArrow(giving_back(_blocks_compared(percent)), "a bigint, b bigint")


def _blocks_compared(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, theirs = _block_columns(batch.column("own")), _block_columns(batch.column("others"))
            elements, same = batch.column("element").to_numpy(), batch.column("same").to_pylist()
            for element, own, (a, x), (b, y) in zip(elements, same, mine, theirs):
                sketch = slice(3, len(_SET_COLUMNS))
                differ = (x[:, None, sketch] ^ y[None, :, sketch]).view(np.uint64)
                apart = np.bitwise_count(differ).sum(axis=2, dtype=np.int64)
                small = np.minimum(x[:, None, 2], y[None, :, 2])
                large = np.maximum(x[:, None, 2], y[None, :, 2])
                may = (
                    (x[:, None, 1] != y[None, :, 1])
                    & (100 * small >= percent * large)
                    & ((100 + percent) * apart <= (100 - percent) * (small + large))
                )
                row, column = np.nonzero(may)
                earlier = np.zeros(len(row), dtype=bool)
                ours, its = x[row, len(_SET_COLUMNS) :], y[column, len(_SET_COLUMNS) :]
                for i in range(FIRSTS):
                    met = (its == ours[:, i : i + 1]).any(axis=1)
                    earlier |= met & (ours[:, i] < element)
                twice = (a[row] > b[column]) & own
                row, column = row[~earlier & ~twice], column[~earlier & ~twice]
                if len(row):
                    pair = np.sort(np.stack([a[row], b[column]]), axis=0)
                    yield pa.RecordBatch.from_arrays([pa.array(pair[0]), pa.array(pair[1])], ["a", "b"])

    return run


def _block_columns(column: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per block its nodes, and one row of numbers per set."""
    values, ends = column.flatten(), np.cumsum(column.value_lengths().to_numpy())
    table = np.stack([values.field(i).to_numpy() for i in range(values.type.num_fields)], axis=1)
    for rows in np.split(table, ends[:-1]):
        yield rows[:, 0], rows


def _rare_sharers(first: DataFrame, sketches: DataFrame, link, percent: int) -> DataFrame:
    """Links ``a < b`` that join sets of different components, as many as it takes.

    A set shares at least ``percent`` of its elements with a similar one. So of all elements in
    one order, the first few (as many as may be missing, and one) of both sets meet. Copies that were changed much, apart from one
    another, differ in rare elements, so they do not meet however many they are. Copies that were
    changed little do.

    The sets of an element are paired where they are at most ``CROWD``, so pairs grow with the
    rows. Larger crowds are compared with centres, round by round, and what stays apart is compared
    in blocks. Only pairs come out whose sizes and parity sketches allow so few differences as
    similar sets may have; ``link`` checks these.
    """
    first = _across(freeze(first, "ngram-elements", settings=SMALL_BATCHES))
    first = freeze(first.join(sketches.drop("size"), "node"), "ngram-rarest")
    few = first.where(F.col("many") <= CROWD)
    other = few.select("element", *_others(*_SET_COLUMNS))
    met = few.join(other, "element").where("component < other_component")
    pairs = _as_pairs(met.where(_may_be_similar(percent)))
    crowded, links = _centre_rounds(first.where(F.col("many") > CROWD), link, percent)
    if not crowded.isEmpty():
        pairs = pairs.union(_block_pairs(crowded, percent)).distinct()
    found = link(pairs)
    for made in links:
        found = found.union(made)
    return found


def _checked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for a, b in zip(batch.column("a_elements"), batch.column("b_elements")):
                x = np.frombuffer(a.as_py(), dtype=np.uint64)
                y = np.frombuffer(b.as_py(), dtype=np.uint64)
                both = np.concatenate([x, y])
                both.sort(kind="stable")
                common = int((both[1:] == both[:-1]).sum())
                linked.append(100 * common >= percent * (len(both) - common))
            pairs = batch.select(["a", "b"]).filter(pa.array(linked, type=pa.bool_()))
            del batch
            yield pairs
            pa.default_memory_pool().release_unused()

    return run


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    width: int = WIDTH,
    percent: int = PERCENT,
    depth: int = 0,
    n2: int = 1,
) -> DataFrame:
    """Per row of ``docs``: id, ``n_shingles``, ``component_id``.

    A document's set holds its distinct shingles of ``width`` lower-cased words; a text of fewer
    words counts as one shingle, a text without words (null too) has none and is linked with
    nothing. Two documents are linked when 100 * common >= percent * union; ``component_id`` is the
    smallest id that links lead to, the own one included. Rows repeated under one id, with equal
    texts or different ones, are documents each; links follow texts, never ids. A null id never is
    a component's id unless all ids of it are null. An empty table gives an empty table.

    Equal sets are one node from the start. Candidates share a PartEnum signature, and every link
    is checked on the whole sets. In a bucket of many sets not all pairs are looked at: all are
    compared with one centre. Sets of a bucket that stay in different components after that may
    still be linked; their rarest elements tell which pairs can be, and these are compared, so the
    components are exact. No bucket, partner or candidate is capped.
    """
    given = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    rows, classes = _classes(given, width, percent, depth, n2)
    by_node = classes.select("node", "component_id")
    return rows.join(by_node, "node", "left").select(
        F.col("id").alias(id_column),
        F.col("size").alias("n_shingles"),
        F.coalesce("component_id", "id").alias("component_id"),
    )


def one_of_each(
    docs: DataFrame,
    text: str = "text",
    id_column: str = "doc_id",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """One row of ``docs`` of each component of ``near_duplicates``, with all its columns.

    The row of the smallest id stays (a null id counts as largest); of several under that id the
    one whose set has the smallest number, then whose text does. Every row without words stays.
    """
    names = docs.columns
    given = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"))
    _, classes = _classes(given, width, percent)
    chosen = classes.where("node = representative").select(
        F.col("node").alias("_node"), F.col("own_id").alias("_own_id")
    )
    texts = docs.select(*[F.col(f"`{n}`") for n in names if n != text], F.col(text).alias("text"))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields)
    keyed = texts.mapInArrow(giving_back(_named_rows(width)), f"{kinds}, node bigint")
    kept = keyed.join(chosen, F.col("node") == F.col("_node"), "left")
    own = F.col(id_column).cast("bigint").eqNullSafe(F.col("_own_id"))
    kept = kept.where(F.col("node").isNull() | (F.col("_node").isNotNull() & own))
    with_words = kept.where("node IS NOT NULL")
    first = F.row_number().over(Window.partitionBy("node").orderBy(F.xxhash64("text"), "text"))
    with_words = with_words.withColumn("_at", first).where("_at = 1").drop("_at")
    kept = with_words.unionByName(kept.where("node IS NULL")).withColumnRenamed("text", text)
    return kept.select(*[F.col(f"`{n}`") for n in names])


def _classes(
    given: DataFrame, width: int, percent: int, depth: int = 0, n2: int = 1
) -> tuple[DataFrame, DataFrame]:
    """Rows ``id, node, size`` of the documents, and per node ``component_id``, the smallest id of
    its component, ``own_id``, its own smallest, and the ``representative`` node."""
    spark = given.sparkSession
    places = int(spark.conf.get("spark.sql.shuffle.partitions"))
    made = given.mapInArrow(
        giving_back(_signatures_of(width, percent, depth, n2, places)), _ROWS_DDL
    )
    made = made.repartitionById(places, F.col("place")).mapInArrow(
        giving_back(_unpacked), _ROWS_DDL
    )
    made = freeze(
        made.drop("signatures", "nodes", "place"), "ngram-signatures", settings=SMALL_BATCHES
    )
    rows = made.where(F.col("kind") == _DOC).select("id", "node", "proof", "size")
    members = freeze(
        made.where(F.col("kind") == _MEMBER).select("signature", "node").distinct(),
        "ngram-buckets",
    )
    nodes = (
        members.select("node")
        .distinct()
        .join(
            rows.groupBy("node").agg(
                F.max("size").alias("size"),
                F.assert_true(
                    (F.min("proof") == F.max("proof")) & (F.min("size") == F.max("size"))
                ).alias("_sound"),
            ),
            "node",
        )
    )
    nodes = freeze(nodes.where("_sound IS NULL").drop("_sound"), "ngram-nodes")
    bits, shift = _node_map(nodes, nodes.count())
    shared = spark.sparkContext.broadcast(bits)
    texts = given.select("text").mapInArrow(
        giving_back(_named_rows(width, shared, shift)), "text string, node bigint"
    )
    texts = texts.join(nodes.select("node"), "node", "left_semi").dropDuplicates(["node"])
    numbers = ", ".join(f"{c} bigint" for c in ["size", *_SKETCH_COLUMNS])
    sets = freeze(
        texts.select("node", "text").mapInArrow(
            giving_back(_sets_of(width)), f"node bigint, elements binary, {numbers}"
        ),
        "ngram-sets",
        settings=SMALL_BATCHES,
    )
    sketches = sets.select("node", "size", *_SKETCH_COLUMNS)

    def link(likely: DataFrame) -> DataFrame:
        """The pairs (a < b) that are linked, of those that sizes and sketches allow.

        Only sets of these pairs travel. The pairs are written, so that a few of them are broadcast
        to where the sets lie; and sets are checked in small batches, as two of them make a row.
        """
        likely = freeze(likely.select("a", "b"), "ngram-likely")
        wanted = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
        found = sets.select("node", "elements").join(wanted, "node", "left_semi")
        a_sets = found.select(F.col("node").alias("a"), F.col("elements").alias("a_elements"))
        b_sets = found.select(F.col("node").alias("b"), F.col("elements").alias("b_elements"))
        both = likely.join(a_sets, "a").join(b_sets, "b")
        both = both.mapInArrow(giving_back(_checked(percent)), "a bigint, b bigint")
        return freeze(both, "ngram-links", settings=SMALL_BATCHES)

    least = F.struct(F.xxhash64("node"), "node")
    centres = members.groupBy("signature").agg(F.min_by("node", least).alias("centre"))
    pairs = members.join(centres, "signature").where("node <> centre")
    pairs = pairs.select(F.least("node", "centre").alias("a"), F.greatest("node", "centre").alias("b"))
    of_a = sketches.withColumnRenamed("node", "a")
    of_b = sketches.select(
        F.col("node").alias("b"),
        *[F.col(c).alias(f"other_{c}") for c in ["size", *_SKETCH_COLUMNS]],
    )
    pairs = pairs.distinct().join(of_a, "a").join(of_b, "b").where(_few_differences(percent))
    found = freeze(components(link(pairs), frozen=True), "ngram-components")
    labelled = members.join(found, "node", "left").select(
        "signature", "node", F.coalesce("component", "node").alias("component")
    )
    mixed = (
        labelled.groupBy("signature")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .where("low <> high")
        .select("signature")
    )
    still_open = labelled.join(mixed, "signature", "left_semi").select("node", "component").distinct()
    still_open = freeze(still_open, "ngram-open")
    more = _rare_sharers(_rarest_elements(sets, still_open, percent), sketches, link, percent)
    if not more.isEmpty():
        moved = _merged(more, still_open)
        found = found.join(moved, "component", "left")
        found = found.select("node", F.coalesce("to", "component").alias("component"))
        alone = moved.select(F.col("component").alias("node"), F.col("to").alias("component"))
        found = freeze(found.union(alone).distinct(), "ngram-components")
    by_node = rows.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("own_id"))
    by_node = by_node.join(found, "node", "left").select(
        "node", "own_id", F.coalesce("component", "node").alias("class")
    )
    order = F.struct(F.col("own_id").isNull(), F.col("own_id"), F.col("node"))
    least = by_node.groupBy("class").agg(
        F.min("own_id").alias("component_id"), F.min_by("node", order).alias("representative")
    )
    return rows, by_node.join(least, "class").drop("class")
