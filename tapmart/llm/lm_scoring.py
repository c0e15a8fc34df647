"""Scoring documents with a language model that is counted on the corpus itself."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapmart.llm.context_mixing import (
    CLASSES, EXACT_FROM, GATES, INPUTS, ORDERS, SLOTS, Mixer, Past, Vocabulary, fit_classes,
    gathered, hashed_counts, head_counts, lexicographic, nearest, opening_logits, past_costs,
    past_mixer, profile, token_logits, train_mixer, train_past,
)
from tapmart.llm.common import giving_back, uniform
from tapmart.llm.tokens import PIECE_BYTES, Words, mix, pieces
from tapmart.session import SMALL_BATCHES, freeze

# Texts whose tokens are listed together, in bytes; and bytes of a token that choose its shard.
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 4
# The centres of the kinds of text start from about so many training documents; then all training
# documents move them so many times.
SAMPLE_DOCUMENTS = 3_000
CLASS_ROUNDS = 5
# A shard takes about so many tokens at most, so that a task's memory does not grow with the corpus.
SHARD_TOKENS = 1 << 20
# Tokens are counted in at most about so many classes of beginnings before shards are dealt.
LEAD_BUCKETS = 1 << 14
END = np.frombuffer(b"\n", dtype=np.uint8)
LOG10_2 = float(np.log10(2.0))

_KINDS = pa.schema(
    [
        ("kind", pa.int32()), ("place", pa.int32()), ("block", pa.int64()),
        ("ids", pa.list_(pa.int64())), ("held", pa.list_(pa.bool_())),
        ("tokens", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64())),
        ("bag_sizes", pa.list_(pa.int64())), ("bag", pa.binary()),
        ("shards", pa.list_(pa.int64())), ("packs", pa.list_(pa.binary())),
        ("shard", pa.int64()), ("group", pa.int64()), ("parted", pa.bool_()),
        ("vocabulary", pa.binary()), ("past", pa.binary()),
        ("blocks", pa.list_(pa.int64())), ("picks", pa.binary()), ("openings", pa.binary()),
        ("train_tokens", pa.int64()), ("train_types", pa.int64()),
    ]
)
_DDL = (
    "kind int, place int, block bigint, ids array<bigint>, held array<boolean>, "
    "tokens array<bigint>, sizes array<bigint>, bag_sizes array<bigint>, bag binary, "
    "shards array<bigint>, packs array<binary>, shard bigint, group bigint, parted boolean, "
    "vocabulary binary, past binary, blocks array<bigint>, picks binary, openings binary, "
    "train_tokens bigint, train_types bigint"
)
_BLOCK, _PACK, _SHARD = 0, 1, 2


@dataclass(frozen=True)
class Deal:
    """How tokens are dealt to shards, and shards to tasks.

    Beginnings of tokens are in groups, by hash. ``parts`` has the number of shards of each group: a
    group of more tokens than a shard takes is parted by the token before, as what is counted of the
    tokens before is counted of each alone. ``runs`` is the number of buckets of previous tokens that
    a task takes one after the other.
    """

    places: int
    parts: np.ndarray
    runs: int = 1

    @cached_property
    def first(self) -> np.ndarray:
        return np.cumsum(self.parts) - self.parts

    @cached_property
    def group(self) -> np.ndarray:
        """Of each shard."""
        return np.repeat(np.arange(len(self.parts)), self.parts)

    def shard(self, group: np.ndarray, previous: np.ndarray) -> np.ndarray:
        part = mix(previous ^ np.uint64(0x5DEECE66D)) % self.parts[group].astype(np.uint64)
        return self.first[group] + part.astype(np.int64)

    def place(self, shard: np.ndarray) -> np.ndarray:
        group = self.group[shard]
        return (group + shard - self.first[group]) % self.places

    def parted(self, shard: int) -> bool:
        return bool(self.parts[self.group[shard]] > 1)

    def bucket(self, previous: np.ndarray) -> np.ndarray:
        return (mix(previous + np.uint64(1)) % np.uint64(self.places * self.runs)).astype(np.int32)


def deal(counts: np.ndarray, places: int) -> Deal:
    """From the tokens in each bucket of beginnings, of which there are a power of two per place.

    A task keeps what blocks send to its shards until it has all of it, so where partitions are few for
    the input there are more tasks than partitions.
    """
    total = counts.sum()
    while places < len(counts) and total > 4 * places * SHARD_TOKENS:
        places *= 2
    groups = places
    while groups < len(counts) and total > groups * SHARD_TOKENS:
        groups *= 2
    load = counts.reshape(-1, groups).sum(axis=0)
    return Deal(
        places, np.maximum(1, np.ceil(load / SHARD_TOKENS)).astype(np.int64),
        max(1, int(np.ceil(total / (2 * SHARD_TOKENS * places)))),
    )


def _dealt(given: DataFrame, places: int) -> Deal:
    buckets = places
    while buckets * 2 <= LEAD_BUCKETS:
        buckets *= 2
    summed = (
        given.select("text").mapInArrow(giving_back(_led(buckets)), "stripe int, counts binary")
        .groupBy("stripe").applyInPandas(_summed, "stripe int, counts binary")
    ).toPandas().sort_values("stripe")
    if not len(summed):
        return deal(np.zeros(buckets), places)
    return deal(np.concatenate([np.frombuffer(c, "<f8") for c in summed["counts"]]), places)


def _led(buckets: int):
    """How many tokens a task has in every bucket of beginnings, in stripes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets)
        end = _lead(END, np.zeros(1, np.int64), np.ones(1, np.int64), buckets)[0]
        for batch in batches:
            for _, part in pieces(batch.column("text")):
                words = Words(part)
                at = _lead(words.data, words.start, words.end - words.start, buckets)
                total += np.bincount(at, minlength=buckets)
                total[end] += len(part)
        if total.any():
            yield _striped(np.array_split(total, max(1, buckets >> 10)))

    return run


def _lead(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, groups: int) -> np.ndarray:
    """The group of every token by its beginning."""
    number = _number(data, starts, np.minimum(lengths, SHARD_BYTES))
    return (number % np.uint64(groups)).astype(np.int64)


def _striped(stripes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(len(stripes), dtype=np.int32)),
            pa.array([s.astype("<f8").tobytes() for s in stripes], type=pa.binary()),
        ],
        ["stripe", "counts"],
    )


def _rows(**values) -> pa.RecordBatch:
    """Rows with the given columns; the others are null."""
    n = len(values["kind"])
    return pa.RecordBatch.from_arrays(
        [pa.array(values.get(f.name, [None] * n), type=f.type) for f in _KINDS], schema=_KINDS
    )


def _row(kind: int, place: int, **values) -> pa.RecordBatch:
    return _rows(kind=[kind], place=[place], **{name: [value] for name, value in values.items()})


_ZSTD = "zstd"


def _packed(*fields) -> bytes:
    """Arrays and bytes as one compressed value: neither shuffles nor the JVM see more of them."""
    fields = [f if isinstance(f, bytes) else np.ascontiguousarray(f).tobytes() for f in fields]
    plain = b"".join(fields)
    head = np.array([len(fields), *map(len, fields)], dtype="<i8").tobytes()
    return head + (pa.compress(plain, codec=_ZSTD, asbytes=True) if plain else b"")


def _unpacked(value: bytes) -> list[memoryview]:
    n = int(np.frombuffer(value, "<i8", 1)[0])
    ends = np.cumsum(np.frombuffer(value, "<i8", n, 8)).tolist()
    size = ends[-1] if ends else 0
    plain = b""
    if size:
        plain = pa.decompress(memoryview(value)[8 * (n + 1) :], size, codec=_ZSTD, asbytes=True)
    plain = memoryview(plain)
    return [plain[a:b] for a, b in zip([0, *ends], ends)]


def _planes(x: np.ndarray) -> bytes:
    """Numbers byte plane by byte plane, which compresses well."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _short(x: np.ndarray) -> bytes:
    """The lower 48 bits of numbers, byte plane by byte plane."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6].T).tobytes()


def _from_short(data: bytes) -> np.ndarray:
    made = np.zeros((len(data) // 6, 8), dtype=np.uint8)
    made[:, :6] = np.frombuffer(data, np.uint8).reshape(6, -1).T
    return made.view("<u8").ravel()


def _number(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 64-bit number per token from its bytes. Tokens are taken in runs of some ``PIECE_BYTES``."""
    found = np.zeros(len(starts), dtype=np.uint64)
    if not len(starts):
        return found
    power = np.full(int(lengths.max()), 0x9E3779B97F4A7C15, dtype=np.uint64)
    power[0] = 1
    power = np.multiply.accumulate(power)
    ends = np.cumsum(lengths)
    first = 0
    while first < len(starts):
        base = ends[first] - lengths[first]
        stop = max(first + 1, int(np.searchsorted(ends, base + PIECE_BYTES, "right")))
        start, length = starts[first:stop], lengths[first:stop]
        opens = ends[first:stop] - length - base
        inner = np.arange(length.sum()) - np.repeat(opens, length)
        value = data[np.repeat(start, length) + inner].astype(np.uint64) + np.uint64(1)
        found[first:stop] = mix(np.add.reduceat(mix(value) * power[inner], opens))
        first = stop
    return found


def _tokens(words: Words):
    """Tokens of some texts: bytes, starts, lengths, text and number of each, in reading order.

    The end of a text is a token too, spelled as a line feed, which no word contains.
    """
    data = np.concatenate([words.data, END])
    texts = len(words.offsets) - 1
    start = np.concatenate([words.start, np.full(texts, len(data) - 1)])
    length = np.concatenate([words.end - words.start, np.ones(texts, dtype=np.int64)])
    text = np.concatenate([words.text, np.arange(texts)])
    number = np.concatenate([words.hashes(), np.full(texts, 0xE0D, dtype=np.uint64)])
    order = np.argsort(text, kind="stable")
    return data, start[order], length[order], text[order], number[order]


def _listed(dealt: Deal, centres: np.ndarray):
    """Texts to one row per block, with the bag of (token, class, previous token) of every document, and
    one row per block and place, with the packs of its shards: the block's distinct tokens, their
    classes, the tokens before them and counts. The class is the document's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 24
        made = 0
        for batch in batches:
            for offset, part in pieces(batch.column("text"), BLOCK_BYTES):
                held = np.asarray(batch.column("held").slice(offset, len(part)))
                ids = batch.column("id").slice(offset, len(part)).to_pylist()
                yield from block_rows(part, ids, held, first + made, dealt, centres)
                made += 1

    return run


def block_rows(part, ids, held, block: int, dealt: Deal, centres) -> Iterator[pa.RecordBatch]:
    listed = Words(part)
    data, start, length, text, number = _tokens(listed)
    kind = nearest(profile(listed.data, listed.offsets), centres)[text]
    words, at, of_word = np.unique(number, return_index=True, return_inverse=True)
    w_start, w_length = start[at], length[at]
    group = _lead(data, w_start, w_length, len(dealt.parts))
    # Words in the order of their groups; items in the order of shards, words, classes, previous tokens.
    order = np.argsort(group, kind="stable")
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    # 0 stands before the first token of a text.
    previous = np.zeros(len(text), dtype=np.int64)
    previous[1:] = np.where(text[1:] == text[:-1], of_word[:-1] + 1, 0)
    pair = ((rank[of_word] * CLASSES + kind) << 32) | previous
    pairs, of_pair = np.unique(pair, return_inverse=True)
    counts = np.bincount(of_pair, weights=(~held)[text], minlength=len(pairs)).astype(np.int64)
    before = np.append(np.uint64(0), words)[pairs & 0xFFFFFFFF]
    pairs >>= 32
    shard = dealt.shard(group[order][pairs // CLASSES], before)
    by_shard = np.argsort(shard, kind="stable")
    place_of = np.empty(len(pairs), dtype=np.int64)
    place_of[by_shard] = np.arange(len(pairs))
    shard, pairs, before, counts = shard[by_shard], pairs[by_shard], before[by_shard], counts[by_shard]
    bag, in_bag = np.unique((text.astype(np.int64) << 32) | place_of[of_pair], return_counts=True)
    owner, item = bag >> 32, bag & 0xFFFFFFFF
    step = np.diff(item, prepend=0)
    opens = np.ones(len(owner), dtype=bool)
    opens[1:] = owner[1:] != owner[:-1]
    step[opens] = item[opens]
    yield _row(
        _BLOCK, int(block % dealt.places), block=block, ids=ids, held=held.tolist(),
        tokens=np.bincount(text, minlength=len(ids)).tolist(), sizes=np.diff(listed.offsets).tolist(),
        bag_sizes=np.bincount(owner, minlength=len(ids)).tolist(),
        bag=_packed(_planes(step), _planes(in_bag)),
    )
    w_start, w_length = w_start[order], w_length[order]
    pair_word = pairs // CLASSES
    filled, opens = np.unique(shard, return_index=True)
    packs: dict[int, tuple[list, list]] = {}
    for own, place, a, b in zip(
        filled.tolist(), dealt.place(filled).tolist(), opens, np.append(opens[1:], len(shard))
    ):
        named, repeats = np.unique(pair_word[a:b], return_counts=True)
        shards, values = packs.setdefault(place, ([], []))
        shards.append(own)
        values.append(
            _packed(
                gathered(data, w_start[named], w_length[named]), _planes(w_length[named]),
                _planes(repeats), (pairs[a:b] % CLASSES).astype(np.uint8), _planes(counts[a:b]),
                _short(before[a:b]),
            )
        )
    yield _rows(
        kind=[_PACK] * len(packs), place=list(packs), block=[block] * len(packs),
        shards=[shards for shards, _ in packs.values()], packs=[values for _, values in packs.values()],
    )


def _merged(dealt: Deal):
    """Pass blocks on; make one row per shard of its packs: its vocabulary with training counts, and
    which of its tokens, in which classes, every block asks for. Packs wait compressed; one shard
    after the other is unpacked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packs: dict[int, list[tuple[int, bytes]]] = {}
        for batch in batches:
            is_pack = pc.equal(batch.column("kind"), _PACK)
            rest = batch.filter(pc.invert(is_pack))
            if rest.num_rows:
                yield rest
            for row in batch.filter(is_pack).select(["block", "shards", "packs"]).to_pylist():
                for shard, pack in zip(row["shards"], row["packs"]):
                    packs.setdefault(shard, []).append((row["block"], pack))
        for shard in sorted(packs):
            yield _shard_row(shard, sorted(packs.pop(shard)), dealt)

    return run


def _joined(data, lengths: np.ndarray, of_word: np.ndarray, kinds: np.ndarray, counts: np.ndarray):
    """Tokens, some of them equal, and entries of a token, a class and a count: the distinct tokens in
    lexicographic order, the distinct pairs of a token's rank and a class as one number, the pair of
    each entry, and the pairs' counts."""
    starts = np.cumsum(lengths) - lengths
    _, at, number = np.unique(_number(data, starts, lengths), return_index=True, return_inverse=True)
    none = np.zeros(len(lengths))
    words = Vocabulary(data, lengths, none, none).take(at)
    order = lexicographic(words.data, words.lengths)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order] = np.arange(len(order))
    pairs, of_pair = np.unique(rank[number][of_word] * CLASSES + kinds, return_inverse=True)
    return words.take(order), pairs, of_pair, np.bincount(of_pair, weights=counts, minlength=len(pairs))


def _vocabulary_values(words: Vocabulary, pairs: np.ndarray, counts: np.ndarray) -> dict:
    by_word = np.bincount(pairs // CLASSES, weights=counts, minlength=len(words.lengths))
    return {
        "vocabulary": _packed(
            words.data, _planes(words.lengths), _planes(pairs // CLASSES),
            (pairs % CLASSES).astype(np.uint8), counts.astype("<i8"),
        ),
        "train_tokens": int(by_word.sum()), "train_types": int((by_word > 0).sum()),
    }


def _shard_row(shard: int, packs: list[tuple[int, bytes]], dealt: Deal) -> pa.RecordBatch:
    fields = [_unpacked(pack) for _, pack in packs]
    data = np.frombuffer(b"".join(f[0] for f in fields), np.uint8)
    lengths = np.concatenate([_from_planes(f[1]) for f in fields]).astype(np.int64)
    repeats = np.concatenate([_from_planes(f[2]) for f in fields])
    kinds = np.concatenate([np.frombuffer(f[3], np.uint8) for f in fields])
    count = np.concatenate([_from_planes(f[4]) for f in fields]).astype(np.float64)
    before = np.concatenate([_from_short(f[5]) for f in fields])
    ends = np.cumsum([len(f[3]) for f in fields])
    del fields
    words, pairs, of_pair, counts = _joined(
        data, lengths, np.repeat(np.arange(len(lengths)), repeats), kinds, count
    )
    # Previous tokens one after the other, and pairs of each in lexicographic order.
    order_past = np.lexsort((of_pair, before))
    pair_at, before_at = of_pair[order_past], before[order_past]
    new = np.ones(len(order_past), dtype=bool)
    new[1:] = (pair_at[1:] != pair_at[:-1]) | (before_at[1:] != before_at[:-1])
    pick = np.empty(len(order_past), dtype=np.int64)
    pick[order_past] = np.cumsum(new) - 1
    past_counts = np.bincount(pick, weights=count, minlength=int(new.sum()))
    made = words.take(pairs // CLASSES)
    made.kinds = pairs % CLASSES
    used, inverse = np.unique(openings_of(made), return_inverse=True)
    opening = np.bincount(inverse, weights=counts, minlength=len(used))
    return _row(
        _SHARD, int(dealt.place(np.array([shard]))[0]), shard=shard, group=int(dealt.group[shard]),
        parted=dealt.parted(shard), **_vocabulary_values(words, pairs, counts),
        past=_packed(_planes(pair_at[new]), _short(before_at[new]), past_counts.astype("<i8")),
        blocks=[block for block, _ in packs],
        picks=_packed(*(_planes(p) for p in np.split(pick, ends[:-1]))),
        openings=used.astype("<i8").tobytes() + opening.astype("<i8").tobytes(),
    )


_WHOLE = "group bigint, vocabulary binary, train_tokens bigint, train_types bigint"


def _wholes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The vocabulary of each group out of those of its shards, added one after the other."""
    found: dict[int, dict] = {}
    for batch in batches:
        for row in batch.to_pylist():
            known = found.get(row["group"])
            both = [_unpacked(v["vocabulary"]) for v in (known, row) if v]
            lengths = [_from_planes(f[1]).astype(np.int64) for f in both]
            shift = np.cumsum([0, *map(len, lengths)])
            words, pairs, _, counts = _joined(
                np.frombuffer(b"".join(f[0] for f in both), np.uint8), np.concatenate(lengths),
                np.concatenate([_from_planes(f[2]) + shift[i] for i, f in enumerate(both)]),
                np.concatenate([np.frombuffer(f[3], np.uint8) for f in both]),
                np.concatenate([np.frombuffer(f[4], "<i8") for f in both]).astype(np.float64),
            )
            found[row["group"]] = _vocabulary_values(words, pairs, counts)
    for group in sorted(found):
        yield pa.RecordBatch.from_pylist([{"group": group, **found.pop(group)}])


def openings_of(words: Vocabulary) -> np.ndarray:
    """Class and first two bytes of each pair as one number."""
    rows = np.arange(len(words.lengths))
    lead = words.byte(0, rows).astype(np.int64) * 256 + words.byte(1, rows)
    return words.kinds.astype(np.int64) * 65536 + lead


def _vocabulary(value: bytes) -> tuple[Vocabulary, np.ndarray]:
    """The pairs of a vocabulary, in lexicographic order, and the training count of each one's token."""
    data, lengths, of_word, kinds, counts = _unpacked(value)
    lengths = _from_planes(lengths).astype(np.int64)
    none = np.zeros(len(lengths))
    of_word = _from_planes(of_word).astype(np.int64)
    pairs = Vocabulary(np.frombuffer(data, np.uint8), lengths, none, none).take(of_word)
    pairs.counts = np.frombuffer(counts, "<i8").astype(np.float64)
    pairs.kinds = np.frombuffer(kinds, np.uint8)
    return pairs, np.bincount(of_word, weights=pairs.counts, minlength=len(lengths))[of_word]


def _found_in(own: Vocabulary, whole: Vocabulary) -> np.ndarray:
    """The row in ``whole`` of every pair of ``own``."""

    def numbers(words: Vocabulary) -> np.ndarray:
        return mix(_number(words.data, words.starts, words.lengths) + words.kinds.astype(np.uint64))

    known = numbers(whole)
    order = np.argsort(known)
    return order[np.searchsorted(known[order], numbers(own))]


def _past(value: bytes, words: Vocabulary) -> tuple[Past, np.ndarray]:
    """What follows which token in a shard; and of every head, which is a previous token and the
    first bytes after it, in the order of rows, these and its training count."""
    pair, previous, counts = _unpacked(value)
    pair = _from_planes(pair).astype(np.int64)
    previous = _from_short(previous)
    counts = np.frombuffer(counts, "<i8").astype(np.float64)
    everyone = np.arange(len(words.lengths))
    lead = np.zeros(len(everyone), dtype=np.uint64)
    for place in range(EXACT_FROM):
        lead = (lead << np.uint64(8)) | words.byte(place, everyone)
    # Rows stand in the order of previous tokens and tokens, so equal heads adjoin.
    lead = lead[pair]
    new = np.ones(len(pair), dtype=bool)
    new[1:] = (previous[1:] != previous[:-1]) | (lead[1:] != lead[:-1])
    head = np.cumsum(new) - 1
    known = np.bincount(head, weights=counts, minlength=int(new.sum()))
    return Past(pair, previous, counts, head, np.zeros((0, 0), np.uint8)), np.stack(
        [previous[new], lead[new], known.astype(np.uint64)]
    )


_HEADS = "shard bigint, bucket int, heads binary"
# In place of the bucket: the vocabulary of the shard's group.
_OF_GROUP = -1


def _heads(dealt: Deal):
    """Heads of a shard, parted by previous token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in ("shard", "vocabulary", "past")}
                previous, lead, counts = _past(row["past"], _vocabulary(row["vocabulary"])[0])[1]
                bucket = dealt.bucket(previous)
                order = np.argsort(bucket, kind="stable")
                filled, opens = np.unique(bucket[order], return_index=True)
                parts = np.split(order, opens[1:])
                values = [_packed(_short(previous[p]), _planes(lead[p]), counts[p].astype("<i8")) for p in parts]
                yield _head_rows([row["shard"]] * len(parts), filled, values)

    return run


def _head_rows(shards, buckets, values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(shards, pa.int64()), pa.array(buckets, pa.int32()), pa.array(values, pa.binary())],
        ["shard", "bucket", "heads"],
    )


def _replied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What followed each previous token, over all shards; back to each shard for its heads. One
    bucket after the other is unpacked."""
    asked: dict[int, list[tuple[int, bytes]]] = {}
    for batch in batches:
        for row in batch.to_pylist():
            asked.setdefault(row["bucket"], []).append((row["shard"], row["heads"]))
    for bucket in sorted(asked):
        rows = asked.pop(bucket)
        fields = [_unpacked(value) for _, value in rows]
        previous = [_from_short(f[0]) for f in fields]
        found = head_counts(
            np.concatenate(previous), np.concatenate([_from_planes(f[1]) for f in fields]),
            np.concatenate([np.frombuffer(f[2], "<i8") for f in fields]).astype(np.float64),
        )
        parts = np.split(found, np.cumsum([len(p) for p in previous])[:-1])
        for (shard, _), part in zip(rows, parts):
            yield _head_rows([shard], [bucket], [_packed(part.T)])


def _with_heads(past: Past, heads: np.ndarray, replies: pd.DataFrame, dealt: Deal) -> Past:
    order = np.argsort(dealt.bucket(heads[0]), kind="stable")
    width = 16 * EXACT_FROM
    past.heads = np.empty((len(order), width), dtype=np.uint8)
    at = 0
    for value in replies.sort_values("bucket")["heads"]:
        part = np.frombuffer(_unpacked(value)[0], np.uint8).reshape(width, -1).T
        past.heads[order[at : at + len(part)]] = part
        at += len(part)
    return past


def _opened(row, replied: pd.DataFrame, dealt: Deal) -> tuple:
    """A shard: its words or those of its group, the training count of each one's token, what follows
    which token, and the pairs that are the shard's own (None if all are)."""
    words, by_word = _vocabulary(row["vocabulary"])
    past, heads = _past(row["past"], words)
    past = _with_heads(past, heads, replied[replied["bucket"] != _OF_GROUP], dealt)
    chosen = None
    if row["parted"]:
        own = words
        words, by_word = _vocabulary(replied.loc[replied["bucket"] == _OF_GROUP, "heads"].iloc[0])
        at = _found_in(own, words)
        past.pair, chosen = at[past.pair], np.sort(at)
    return words, by_word, past, chosen


def _each(columns: list[str], work):
    """Apply ``work`` to one shard row after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = {name: batch.column(name)[at].as_py() for name in columns}
                yield work(row)

    return run


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The hashed counts of all shards of a task, in stripes. Small vocabularies are counted together."""
    table = np.zeros((len(ORDERS), SLOTS, 2))
    waiting: list[Vocabulary] = []
    for batch in batches:
        for value in batch.column("vocabulary"):
            waiting.append(_vocabulary(value.as_py())[0])
            if sum(len(words.lengths) for words in waiting) >= SLOTS:
                table += hashed_counts(_together(waiting))
                waiting = []
    if waiting:
        table += hashed_counts(_together(waiting))
    yield _striped(table.reshape(-1, 1 << 14))


def _together(parts: list[Vocabulary]) -> Vocabulary:
    fields = ("data", "lengths", "counts", "kinds")
    return Vocabulary(*(np.concatenate([getattr(words, name) for words in parts]) for name in fields))


def _summed(pdf: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(c, "<f8") for c in pdf["counts"])
    return pd.DataFrame({"stripe": [pdf["stripe"].iloc[0]], "counts": [total.tobytes()]})


def score_documents(
    docs: DataFrame, held_out: Column, text: str = "text", id_column: str = "doc_id"
) -> DataFrame:
    """Per row: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``,
    ``score``, ``bits_per_byte``.

    Tokens are the words of the lower-cased (A-Z) text and one end per document; a null text is
    empty. ``base_score`` is the base-10 log probability of the text under token counts with one
    added; ``score`` the one under the bit model of ``context_mixing``. Both learn only from rows
    that are not held out. Ids may be null or repeated; every row is a document. An empty table
    gives an empty table.

    A document is coded as its kind, one of ``CLASSES`` that are found without labels, and then its
    tokens, so the score is at most ``-log10(CLASSES)``. A token's bits depend on its bytes so far,
    the class, and the token before it. ``bits_per_byte`` is what that takes per byte of the text as
    given, null for an empty one.

    The corpus is listed once: per block of texts the distinct tokens with the class of their
    document and the token before, sent to shards by the beginning of the token. A shard counts its tokens
    exactly. Tokens are counted by beginning first, so that shards take about ``SHARD_TOKENS`` each: there
    are more of them than tasks where need be, and beginnings of more tokens are parted by the token before;
    their vocabulary, which is what still grows with the corpus, is then put together again. Only
    tables of a fixed size are broadcast: the hashed counts (``len(ORDERS) * 2 ** SLOT_BITS``
    slots), the openings of tokens by class, and the mixers' weights. However common a token is, a
    block sends it once per class and token before it. What follows a token and up to
    ``EXACT_FROM`` - 1 bytes is counted over all shards by a second exchange, by the token before.
    """
    spark = docs.sparkSession
    places = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = docs.select(
        F.col(id_column).cast("bigint").alias("id"), F.col(text).alias("text"),
        F.coalesce(held_out, F.lit(False)).alias("held"),
    )
    dealt = _dealt(given, places)
    tasks = dealt.places
    centres = _classes(given)
    listed = given.mapInArrow(giving_back(_listed(dealt, centres)), _DDL)
    listed = freeze(
        listed.repartitionById(tasks, F.col("place")).mapInArrow(giving_back(_merged(dealt)), _DDL),
        "lm-lists", settings=SMALL_BATCHES,
    )
    blocks = listed.where(F.col("kind") == _BLOCK).select(
        "block", "ids", "held", "tokens", "sizes", "bag_sizes", "bag"
    )
    shards = listed.where(F.col("kind") == _SHARD)
    vocabularies, wholes = shards, None
    if dealt.parts.max() > 1:
        columns = ["group", "vocabulary", "train_tokens", "train_types"]
        wholes = freeze(
            shards.where("parted").select("group", "vocabulary")
            .repartitionById(tasks, (F.col("group") % tasks).cast("int"))
            .mapInArrow(giving_back(_wholes), _WHOLE),
            "lm-words", settings=SMALL_BATCHES,
        )
        vocabularies = shards.where("NOT parted").select(*columns).union(wholes.select(*columns))
    size = vocabularies.agg(F.sum("train_tokens"), F.sum("train_types")).first()
    tokens, types = int(size[0] or 0), int(size[1] or 0)

    few = max(1, int(2 * np.sqrt(places)))
    stripes = (
        vocabularies.select("vocabulary")
        .coalesce(few)
        .mapInArrow(_counted, "stripe int, counts binary")
        .groupBy("stripe")
        .applyInPandas(_summed, "stripe int, counts binary")
        .toPandas()
        .sort_values("stripe")
    )
    counts = np.zeros((len(ORDERS), SLOTS, 2), dtype=np.float32)
    if len(stripes):
        flat = np.concatenate([np.frombuffer(c, "<f8") for c in stripes["counts"]])
        counts = flat.reshape(counts.shape).astype(np.float32)
    openings = np.zeros(CLASSES * 65536)
    for row in (
        shards.select("openings")
        .mapInArrow(_each(["openings"], _opening_rows), "opening bigint, count bigint")
        .groupBy("opening").agg(F.sum("count").alias("count")).toLocalIterator()
    ):
        openings[row["opening"]] = row["count"]
    opening = opening_logits(openings.reshape(CLASSES, 65536))
    opening = [tuple(x.astype(np.float32) for x in tables) for tables in opening]
    replies = freeze(
        shards.select("shard", "vocabulary", "past")
        .mapInArrow(giving_back(_heads(dealt)), _HEADS)
        .repartitionById(tasks, F.col("bucket") % tasks)
        .mapInArrow(giving_back(_replied), _HEADS),
        "lm-heads", settings=SMALL_BATCHES,
    )
    if wholes is not None:
        # Every shard of a group gets the vocabulary of the whole group.
        group_of = [(int(g), int(k)) for k, g in enumerate(dealt.group) if dealt.parts[g] > 1]
        own = F.broadcast(spark.createDataFrame(group_of, "group bigint, shard bigint"))
        replies = replies.union(
            wholes.join(own, "group").select("shard", F.lit(_OF_GROUP), F.col("vocabulary"))
        )
    shared_counts = spark.sparkContext.broadcast((counts, opening))

    def fit(row) -> pa.RecordBatch:
        words, _ = _vocabulary(row["vocabulary"])
        return _learned(train_mixer(words, shared_counts.value[0]), float(words.counts.sum()))

    mixer = _added_up(
        vocabularies.select("vocabulary").mapInArrow(_each(["vocabulary"], fit), _LEARNED),
        Mixer(GATES, INPUTS),
    )
    shared_mixer = spark.sparkContext.broadcast(mixer)

    def fit_past(row, replied) -> pa.RecordBatch:
        words, _, past, chosen = _opened(row, replied, dealt)
        table, opened = shared_counts.value
        logits = token_logits(words, table, shared_mixer.value, opened, True, chosen)
        return _learned(train_past(words, past, logits), float(past.counts.sum()))

    def with_replies(columns: list[str], work, ddl: str) -> DataFrame:
        def run(asking: pd.DataFrame, replied: pd.DataFrame) -> pd.DataFrame:
            return pd.concat([work(row, replied).to_pandas() for row in asking.to_dict("records")])

        return (
            shards.select("shard", "parted", "vocabulary", "past", *columns).groupBy("shard")
            .cogroup(replies.groupBy("shard")).applyInPandas(run, ddl)
        )

    shared_past = spark.sparkContext.broadcast(
        _added_up(with_replies([], fit_past, _LEARNED), past_mixer())
    )

    def answer(row, replied) -> pa.RecordBatch:
        table, opened = shared_counts.value
        words, by_word, past, chosen = _opened(row, replied, dealt)
        logits = token_logits(words, table, shared_mixer.value, opened, False, chosen)
        bits = past_costs(words, past, logits, shared_past.value).astype("<f4")
        values = []
        for pick in _unpacked(row["picks"]):
            at = _from_planes(pick).astype(np.int64)
            count = by_word[past.pair[at]].astype(np.int64)
            small = not len(count) or count.max() < 2**32
            values.append(_packed(bits[at], _planes(count) if small else count.astype("<i8")))
        return pa.RecordBatch.from_arrays(
            [
                pa.array(row["blocks"], type=pa.int64()),
                pa.array([row["shard"]] * len(values), type=pa.int64()),
                pa.array(values, type=pa.binary()),
            ],
            ["block", "shard", "found"],
        )

    answers = with_replies(["blocks", "picks"], answer, "block bigint, shard bigint, found binary")

    def put_together(asked: pd.DataFrame, answered: pd.DataFrame) -> pd.DataFrame:
        fields = [_unpacked(value) for value in answered.sort_values("shard")["found"]]
        bits = np.concatenate([np.frombuffer(b, "<f4") for b, _ in fields]).astype(np.float64)
        seen = np.concatenate(
            [
                _from_planes(s).astype(np.int64) if len(s) == len(b) else np.frombuffer(s, "<i8")
                for b, s in fields
            ]
        )
        found = []
        for row in asked.itertuples(index=False):
            step, many = map(_from_planes, _unpacked(row.bag))
            sizes = np.asarray(row.bag_sizes)
            opens = np.cumsum(sizes) - sizes
            running = np.cumsum(step.astype(np.int64))
            item = running - np.repeat(running[opens] - step[opens], sizes)
            bits_taken = np.add.reduceat(bits[item] * many, opens) + np.log2(CLASSES)
            size = np.asarray(row.sizes, dtype=np.float64)
            base = np.log10((seen + 1.0) / (tokens + types + 1.0))
            found.append(
                pd.DataFrame(
                    {
                        "id": pd.array(list(row.ids), dtype="Int64"),
                        "held_out": list(row.held),
                        "n_tokens": np.asarray(row.tokens, dtype=np.int64),
                        "n_known": np.add.reduceat(np.where(seen[item] > 0, many, 0), opens).astype(np.int64),
                        "train_tokens": tokens,
                        "base_score": np.add.reduceat(base[item] * many, opens),
                        "score": -LOG10_2 * bits_taken,
                        "bits_per_byte": pd.array(
                            np.where(size > 0, bits_taken / np.maximum(size, 1), np.nan), dtype="Float64"
                        ),
                    }
                )
            )
        return pd.concat(found)

    return (
        blocks.groupBy("block")
        .cogroup(answers.groupBy("block"))
        .applyInPandas(
            put_together,
            "id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, "
            "base_score double, score double, bits_per_byte double",
        )
        .withColumnRenamed("id", id_column)
    )


def _profiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for offset, part in pieces(batch.column("text")):
            words = Words(part)
            rows = profile(words.data, words.offsets)
            yield pa.RecordBatch.from_arrays(
                [pa.array([r.tobytes() for r in rows]), batch.column("start").slice(offset, len(part))],
                ["profile", "start"],
            )


def _classes(given: DataFrame) -> np.ndarray:
    """Centres of the kinds of text: they start from a sample of training documents of bounded
    expected size, and are then moved to the means of all training documents nearest to them."""
    rows = given.where("NOT held")
    share = min(1.0, SAMPLE_DOCUMENTS / max(1, rows.count()))
    profiles = freeze(
        rows.select("text", (uniform(F.col("id"), F.lit(7)) < share).alias("start"))
        .mapInArrow(_profiled, "profile binary, start boolean"), "lm-profiles"
    )
    start = profiles.where("start").select("profile").toPandas()["profile"]
    centres = fit_classes(np.array([np.frombuffer(p, np.float32) for p in sorted(start)]))
    for _ in range(CLASS_ROUNDS):
        moved = centres.copy()
        sums = profiles.select("profile").mapInArrow(_class_sums(centres), "kind int, n bigint, total binary")
        for kind, own in sums.toPandas().groupby("kind"):
            total = sum(np.frombuffer(t) for t in own["total"])
            moved[kind] = total / own["n"].sum()
        centres = moved
    return centres


def _class_sums(centres: np.ndarray):
    """Per class the number and the sum of a task's profiles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros(CLASSES, dtype=np.int64), np.zeros((CLASSES, 256))
        for batch in batches:
            rows = np.array([np.frombuffer(p, np.float32) for p in batch.column("profile").to_pylist()])
            kind = nearest(rows.reshape(-1, 256), centres)
            n += np.bincount(kind, minlength=CLASSES)
            for k in np.unique(kind):
                total[k] += rows[kind == k].sum(axis=0, dtype=np.float64)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(used, pa.int32()), pa.array(n[used]),
                pa.array([total[k].tobytes() for k in used], pa.binary()),
            ],
            ["kind", "n", "total"],
        )

    return run


def _opening_rows(row) -> pa.RecordBatch:
    values = np.frombuffer(row["openings"], "<i8")
    half = len(values) // 2
    return pa.RecordBatch.from_arrays(
        [pa.array(values[:half]), pa.array(values[half:])], ["opening", "count"]
    )


_LEARNED = "weights binary, refined binary, mass double"


def _learned(mixer: Mixer, mass: float) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array([(mixer.weights * mass).tobytes()], type=pa.binary()),
            pa.array([mixer.refined.tobytes()], type=pa.binary()),
            pa.array([mass]),
        ],
        ["weights", "refined", "mass"],
    )


def _added_up(learned: DataFrame, mixer: Mixer) -> Mixer:
    """Weights of all shards averaged by the tokens behind them; what was seen is added up.

    They are written, so that the shuffles behind them go before the next step makes its own.
    """
    summed = learned.withColumn("all", F.lit(1)).groupBy("all").applyInPandas(_averaged, _LEARNED)
    rows = freeze(summed, "lm-learned").first()
    if rows and rows["mass"] > 0:
        mixer.weights = np.frombuffer(rows["weights"]).reshape(mixer.weights.shape) / rows["mass"]
        mixer.refined = np.frombuffer(rows["refined"]).reshape(mixer.refined.shape).copy()
    return mixer


def _averaged(pdf: pd.DataFrame) -> pd.DataFrame:
    """Weights averaged by the tokens behind them; what was seen is added up."""
    return pd.DataFrame(
        {
            "weights": [sum(np.frombuffer(w) for w in pdf["weights"]).tobytes()],
            "refined": [sum(np.frombuffer(r) for r in pdf["refined"]).tobytes()],
            "mass": [float(pdf["mass"].sum())],
        }
    )
