"""Packing documents into training sequences, balanced by attention cost."""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import takewhile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapmart.llm.common import giving_back
from tapmart.llm.tokens import pieces

LENGTH = 4_096
END_ID = 2
# Estimated cost of a piece of n tokens: LINEAR * n + QUADRATIC * n * n.
LINEAR, QUADRATIC = 1.0, 1.0 / LENGTH
# Sequences that are filled together, and bytes of text whose words are read together.
BLOCK_SEQUENCES = 768
RUN_BYTES = 8 << 20


def cost(length):
    return LINEAR * length + QUADRATIC * length * length


# Byte-level vocabularies write a byte as one printable character: itself where it is printable in
# Latin-1, else the next free one from 256 on. Blanks stay, as they part words here.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTES = np.zeros(256, dtype="<u4")
_BYTES[_PRINTABLE] = _PRINTABLE
_BYTES[_BYTES == 0] = 256 + np.arange(256 - len(_PRINTABLE))
_BYTES[0x20] = 0x20
# Up to U+017F letters are composed and have one lower-case letter, but for one.
_LETTERS = "".join(c for c in map(chr, range(0x180)) if c.isalpha() and c != "\u0130")


class WordTokenizer:
    """Ids of whole texts, word by word.

    The tokenizer never joins what white space parts, so the ids of a text are those of its words
    in turn. Words repeat, so texts are taken in runs of some megabytes, and a word of a run is read
    once. Nothing is remembered from one run to the next.

    The library's own reading of a word (normal form, splitting) takes longer than its merges, and
    most words are Latin letters, with a comma or full stop at most. Such a word is lower-cased here
    and its letters, one piece in any case, go to the merges at once. All others take the library's
    whole way. A text that contains an added token, in any case, goes there undivided, since such
    tokens are found before words are.
    """

    def __init__(self, path: str, end_id: int = END_ID):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.added = [token.content.lower() for token in added if token.content]
        # What an added token begins with before its first letter; such bytes have no case.
        self.openings = {
            "".join(takewhile(lambda c: c.isascii() and not c.isalpha(), token))
            for token in self.added
        }
        self.bare = Tokenizer(self.tokenizer.model)
        self.bare.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        suffix = self.tokenizer.model.end_of_word_suffix
        self.ending = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ending[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.end = array("I", [end_id]).tobytes()
        self.marks = {mark: self._whole([mark])[0] for mark in (",", ".")}

    def _whole(self, words: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [array("I", one.ids).tobytes() for one in made]

    def _ids_of_stems(self, stems: pa.Array) -> pa.Array:
        """Many at a time, as one text of pieces. A piece ends with the one token that says so."""
        found = []
        for start in range(0, len(stems), 5_000):
            part = stems.slice(start, 5_000)
            text = " ".join(part.to_pylist())
            if not text.isascii():
                raw = np.frombuffer(text.encode(), dtype=np.uint8)
                text = _BYTES[raw].tobytes().decode("utf-32-le")
            (made,) = self.bare.encode_batch_fast([text], add_special_tokens=False)
            ids = np.array(made.ids, dtype="<u4")
            ends = 4 * (np.flatnonzero(self.ending[ids]) + 1)
            if len(ends) != len(part):
                raise ValueError("the tokenizer does not mark the ends of words")
            bounds = pa.py_buffer(np.append(0, ends).astype(np.int64))
            found.append(
                pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(part), [None, bounds, pa.py_buffer(ids)]
                )
            )
        return pa.chunked_array(found, pa.large_binary()).combine_chunks()

    def _ids_of_words(self, words: pa.Array) -> pa.Array:
        """Per word its ids as bytes."""
        binary = words.cast(pa.large_binary())
        marked = pc.or_(*[pc.ends_with(words, mark) for mark in self.marks])
        stems = pc.if_else(marked, pc.binary_slice(binary, 0, -1), binary).cast(pa.large_string())
        plain = pc.match_substring_regex(stems, f"^[{_LETTERS}]+$")
        lowered = pc.utf8_lower(stems.filter(plain)).dictionary_encode()
        ids = self._ids_of_stems(lowered.dictionary).take(lowered.indices)
        for mark, its_ids in self.marks.items():
            ending = pc.ends_with(words.filter(plain), mark)
            tail = pc.if_else(ending, pa.scalar(its_ids, pa.large_binary()), pa.scalar(b"", pa.large_binary()))
            ids = pc.binary_join_element_wise(ids, tail, pa.scalar(b"", pa.large_binary()))
        others, found = words.filter(pc.invert(plain)), [ids]
        for start in range(0, len(others), 2_000):
            made = self._whole(others.slice(start, 2_000).to_pylist())
            found.append(pa.array(made, pa.large_binary()))
        order = np.argsort(~plain.to_numpy(zero_copy_only=False), kind="stable")
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        return pa.concat_arrays(found).take(pa.array(place))

    def _undivided(self, texts: pa.Array) -> list[int]:
        """Places of texts that contain an added token."""
        if not self.added:
            return []
        likely = [pc.match_substring(texts, opening) for opening in self.openings]
        rows = np.flatnonzero(reduce(pc.or_, likely).to_numpy(zero_copy_only=False)).tolist()
        lowered = ((row, texts[row].as_py().lower()) for row in rows)
        return [row for row, text in lowered if any(token in text for token in self.added)]

    def encode(self, texts: pa.Array | list[str | None]) -> Iterator[bytes]:
        """Little-endian unsigned 32-bit ids per text, with the end id; null counts as empty."""
        for _, run in pieces(pa.array(texts, pa.large_string()).fill_null(""), RUN_BYTES):
            undivided = self._undivided(run)
            if undivided:
                apart = np.zeros(len(run), dtype=bool)
                apart[undivided] = True
                whole = dict(zip(undivided, self._whole(run.take(pa.array(undivided)).to_pylist())))
                run = pc.if_else(pa.array(apart), pa.scalar("", pa.large_string()), run)
            words = pc.ascii_split_whitespace(run)
            places = words.values.dictionary_encode()
            ids = self._ids_of_words(places.dictionary).take(places.indices)
            bounds = np.frombuffer(ids.buffers()[1], dtype=np.int64)[words.offsets.to_numpy()]
            data = memoryview(ids.buffers()[2] or b"")
            del words, places, ids
            for row, (start, stop) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                if undivided and row in whole:
                    yield whole[row] + self.end
                else:
                    yield bytes(data[start:stop]) + self.end


@lru_cache(maxsize=1)
def _tokenizer(path: str, end_id: int) -> WordTokenizer:
    """One per Python worker, which serves many tasks."""
    return WordTokenizer(path, end_id)


class Packer:
    """Fills sequences from pieces ``(document, start, length)`` in blocks of bounded size.

    Whole lengths are cut off long documents first; each is a full sequence. The rest goes, the
    costliest piece first, to the sequence of lowest cost that still has room for it. A piece for
    which none has room is cut to fill what is left, at the cheapest sequences first. There are as
    many sequences as the tokens fill, so all are full; fewer than ``length`` tokens are left over
    and wait for the next block. At the end they make sequences whose lengths are powers of two, so
    nothing is padded.
    """

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.waiting: list[tuple[int, int, int]] = []
        self.tokens = 0

    def add(self, document: int, tokens: int) -> None:
        self.waiting.append((document, 0, tokens))
        self.tokens += tokens

    def sequences(self, last: bool) -> Iterator[list[tuple[int, int, int]]]:
        """Full sequences of what waits; with ``last`` all of it."""
        rest = []
        for document, start, tokens in self.waiting:
            while tokens >= self.length:
                yield [(document, start, self.length)]
                start, tokens = start + self.length, tokens - self.length
            if tokens:
                rest.append((document, start, tokens))
        rest.sort(key=lambda piece: -piece[2])
        number = sum(tokens for _, _, tokens in rest) // self.length
        room = np.full(number, self.length, dtype=np.int64)
        spent = np.zeros(number)
        filled: list[list[tuple[int, int, int]]] = [[] for _ in range(number)]
        uncut = []
        for piece in rest:
            open_costs = np.where(room >= piece[2], spent, np.inf)
            at = int(open_costs.argmin()) if number else 0
            if number and open_costs[at] < np.inf:
                filled[at].append(piece)
                room[at] -= piece[2]
                spent[at] += cost(piece[2])
            else:
                uncut.append(piece)
        order = iter(np.argsort(spent, kind="stable"))
        at = next(order, None)
        left = []
        for document, start, tokens in uncut:
            while tokens and at is not None:
                if not room[at]:
                    at = next(order, None)
                    continue
                part = int(min(tokens, room[at]))
                filled[at].append((document, start, part))
                room[at] -= part
                start, tokens = start + part, tokens - part
            if tokens:
                left.append((document, start, tokens))
        yield from filled
        if last:
            yield from self._powers_of_two(left)
            left = []
        self.waiting = left
        self.tokens = sum(tokens for _, _, tokens in left)

    def _powers_of_two(self, pieces) -> Iterator[list[tuple[int, int, int]]]:
        pieces = list(reversed(pieces))
        total = sum(tokens for _, _, tokens in pieces)
        while total:
            size = 1 << (total.bit_length() - 1)
            total -= size
            sequence = []
            while size:
                document, start, tokens = pieces.pop()
                part = min(size, tokens)
                sequence.append((document, start, part))
                size -= part
                if tokens > part:
                    pieces.append((document, start + part, tokens - part))
            yield sequence


def _packed(path: str, length: int, end_id: int, block: int, schema: pa.Schema, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        first = TaskContext.get().partitionId() << 40
        tokenizer = _tokenizer(path, end_id)
        packer = Packer(length)
        held: dict[int, tuple] = {}
        arrived = 0
        number = 0

        def emit(last: bool) -> pa.RecordBatch:
            nonlocal number
            rows = []
            for sequence in packer.sequences(last):
                offset = 0
                for document, start, tokens in sequence:
                    name, ids = held[document]
                    part = ids[4 * start : 4 * (start + tokens)]
                    row = [name, start, tokens, zlib.crc32(part), len(ids) // 4, first + number, offset]
                    rows.append([*row, np.frombuffer(part, "<u4").astype(np.int32)] if with_ids else row)
                    offset += tokens
                number += 1
            going_on = {document for document, _, _ in packer.waiting}
            for document in [d for d in held if d not in going_on]:
                del held[document]
            columns = list(zip(*rows)) or [[] for _ in schema]
            return pa.RecordBatch.from_arrays(
                [pa.array(list(c), type=f.type) for c, f in zip(columns, schema)], schema=schema
            )

        for batch in batches:
            names = batch.column("id").to_pylist()
            for name, ids in zip(names, tokenizer.encode(batch.column("text"))):
                held[arrived] = (name, ids)
                packer.add(arrived, len(ids) // 4)
                arrived += 1
                if packer.tokens >= block * length:
                    yield emit(last=False)
        if arrived:
            yield emit(last=True)

    return run


def pack_documents(
    docs: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    id_column: str = "doc_id",
    length: int = LENGTH,
    end_id: int = END_ID,
    block_sequences: int = BLOCK_SEQUENCES,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece: id, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``; with ``with_ids`` also the piece's ``ids``.

    A null or empty text is its end id alone; ids may be null or repeated, every row is a document
    of its own. An empty table gives an empty table. Long texts are taken whole.

    Every task packs the documents of its own partition, so nothing is shuffled and no step has
    all lengths in one place. A task holds the ids of one block (``block_sequences`` sequences) at
    a time, and those of one run of texts; no words are remembered from task to task.
    ``tokenizer_path`` is read by the tasks.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    ddl = (
        f"id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, "
        "sequence_id bigint, offset bigint" + (", ids array<int>" if with_ids else "")
    )
    given = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(ddl))
    packed = given.mapInArrow(
        giving_back(_packed(tokenizer_path, length, end_id, block_sequences, schema, with_ids)), ddl
    )
    return packed.withColumnRenamed("id", id_column)
