"""Bit-wise language model: hashed-context predictors, gated logistic mixing, adaptive refinement.

A token is spelled as its bytes and a blank, most significant bit first. For every bit several
predictors look up how often 0 and 1 followed in training under their context; a mixer adds up
their logits with weights that a gate selects, and a table moves the mixed probability to where such
probabilities proved right. A second mixer sets that against what followed the previous token and
the bytes so far, so that the order of tokens counts. Everything here works on arrays of many words
at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np

from tapmart.llm.tokens import PIECE_BYTES, mix

BLANK = 0x20
# Kinds of text (languages, say) that documents are sorted into without labels.
CLASSES = 8
# Bytes before which a hashed predictor looks back, within the word and its preceding blank.
ORDERS = (1, 2, 3, 4, 6)
SLOT_BITS = 18
SLOTS = 1 << SLOT_BITS
PRIOR = 0.35
GATES = 34
BINS = 33
# Logits per bit: the hashed contexts, and the exact beginning with and without the class.
INPUTS = len(ORDERS) + 2
# From this byte on, words that share all bytes so far are in one shard, and are counted exactly.
EXACT_FROM = 4
# Weight sets of the second mixer: eight levels of how often the context was seen, by place.
PAST_GATES = 8 * (EXACT_FROM + 1)


def gathered(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The bytes of the given tokens one after the other, taken in runs of some ``PIECE_BYTES``."""
    ends = np.cumsum(lengths)
    found = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    first = 0
    while first < len(ends):
        base = ends[first] - lengths[first]
        stop = max(first + 1, int(np.searchsorted(ends, base + PIECE_BYTES, "right")))
        length = lengths[first:stop]
        inner = np.arange(length.sum()) - np.repeat(ends[first:stop] - length - base, length)
        found[base : ends[stop - 1]] = data[np.repeat(starts[first:stop], length) + inner]
        first = stop
    return found


@dataclass
class Vocabulary:
    """Distinct pairs of a token and a class: bytes one after the other, lengths, training counts
    and classes."""

    data: np.ndarray
    lengths: np.ndarray
    counts: np.ndarray
    kinds: np.ndarray

    @cached_property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.lengths) - self.lengths

    def byte(self, place: int, rows: np.ndarray) -> np.ndarray:
        """Byte ``place`` of the given tokens; the blank after the last one."""
        at = self.starts[rows] + place
        inside = place < self.lengths[rows]
        if not len(self.data):
            return np.full(len(rows), BLANK, dtype=np.uint8)
        return np.where(inside, self.data[np.minimum(at, len(self.data) - 1)], BLANK).astype(np.uint8)

    def take(self, rows: np.ndarray) -> "Vocabulary":
        lengths = self.lengths[rows]
        spelled = gathered(self.data, self.starts[rows], lengths)
        return Vocabulary(spelled, lengths, self.counts[rows], self.kinds[rows])


def bucket(n: np.ndarray) -> np.ndarray:
    """0, 1, 2, 3-4, 5-8, 9-32, 33-256, more."""
    return np.searchsorted(np.array([0, 1, 2, 4, 8, 32, 256]), n, "left").astype(np.int64)


def stretch(n0, n1, prior: float = PRIOR):
    return np.log((n1 + prior) / (n0 + prior))


def squash(x):
    return 1.0 / (1.0 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Step:
    """One bit of the tokens ``rows``: its value, the slot of every hashed context, and how often
    0 and 1 followed the whole beginning of the token, in its class and in any (0 where that is
    not known exactly)."""

    place: int
    rows: np.ndarray
    bits: np.ndarray
    slots: list[np.ndarray]
    exact: list[tuple[np.ndarray, np.ndarray]]


def lexicographic(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The order of tokens by their bytes and closing blank, in which equal beginnings adjoin."""
    spelled, ends = data.tobytes(), np.cumsum(lengths)
    tokens = [spelled[a:b] + b" " for a, b in zip((ends - lengths).tolist(), ends.tolist())]
    return np.array(sorted(range(len(tokens)), key=tokens.__getitem__), dtype=np.int64)


def _prefix_counts(group, byte, counts):
    """How the training counts of tokens with equal beginnings part at each bit of a byte.

    Tokens come in an order in which equal beginnings, and equal bytes after them, adjoin. Returns,
    for bit 7 down to bit 0, the counts of 0 and 1 for every token; each is a sum over runs.
    """
    new_group = np.ones(len(group), dtype=bool)
    new_group[1:] = group[1:] != group[:-1]
    new = new_group.copy()
    new[1:] |= byte[1:] != byte[:-1]
    at = np.flatnonzero(new)
    of_token = np.cumsum(new) - 1
    total = np.add.reduceat(counts, at)
    value, opens = byte[at].astype(np.int64), new_group[at]
    for bit in range(7, -1, -1):
        node = opens.copy()
        node[1:] |= (value[1:] >> (bit + 1)) != (value[:-1] >> (bit + 1))
        first = np.flatnonzero(node)
        both = np.add.reduceat(total, first)
        ones = np.add.reduceat(np.where((value >> bit) & 1, total, 0.0), first)
        of = (np.cumsum(node) - 1)[of_token]
        yield (both - ones)[of], ones[of]


def _in_order(order, group, byte, counts):
    """The same for tokens in another order, given back in their own."""
    back = np.empty(len(order), dtype=np.int64)
    back[order] = np.arange(len(order))
    for zero, one in _prefix_counts(group[order], byte[order], counts[order]):
        yield zero[back], one[back]


def steps(words: Vocabulary, exact: bool = True, chosen: np.ndarray | None = None) -> Iterator[Step]:
    """All bits of all tokens from byte 2 on, place by place. Tokens are in lexicographic order.

    Exact counts are over all tokens of ``words``; with ``chosen`` only these are given out.
    """
    if not len(words.lengths):
        return
    rows = np.flatnonzero(words.lengths >= 2)
    first, second = words.byte(0, rows), words.byte(1, rows)
    history = (np.uint64(BLANK) << np.uint64(16)) | (first.astype(np.uint64) << np.uint64(8)) | second
    group = mix(history + np.uint64(1))
    wanted = None
    if chosen is not None:
        wanted = np.zeros(len(words.lengths), dtype=bool)
        wanted[chosen] = True
    place = 2
    while len(rows):
        byte = words.byte(place, rows)
        if exact and place >= EXACT_FROM:
            counts = words.counts[rows]
            kinds = words.kinds[rows]
            order = np.argsort(kinds, kind="stable")
            own = mix(group + kinds.astype(np.uint64))
            both = zip(_in_order(order, own, byte, counts), _prefix_counts(group, byte, counts))
        else:
            none = np.zeros(len(rows))
            both = [((none, none), (none, none))] * 8
        pick = np.flatnonzero(wanted[rows]) if wanted is not None else slice(None)
        given, target, past = rows[pick], byte[pick].astype(np.uint64), history[pick]
        bases = [
            mix((past & np.uint64((1 << (8 * order)) - 1)) * np.uint64(16) + np.uint64(number + 1))
            for number, order in enumerate(ORDERS)
        ]
        if place < EXACT_FROM:
            # The longest context holds no more than a shorter one yet; the class takes its place.
            named = past + (words.kinds[given].astype(np.uint64) + np.uint64(1) << np.uint64(48))
            bases[-1] = mix(named * np.uint64(16) + np.uint64(len(ORDERS)))
        for bit, known in zip(range(7, -1, -1), both):
            node = (target | np.uint64(256)) >> np.uint64(bit + 1)
            slots = [
                (((base + node * np.uint64(0x9E3779B97F4A7C15)) * np.uint64(0xD6E8FEB86659FD93))
                 >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
                for base in bases
            ]
            value = ((target >> np.uint64(bit)) & np.uint64(1)).astype(np.int8)
            yield Step(place, given, value, slots, [(zero[pick], one[pick]) for zero, one in known])
        going_on = words.lengths[rows] > place
        rows, byte = rows[going_on], byte[going_on]
        history = (history[going_on] << np.uint64(8)) | byte
        group = mix(group[going_on] * np.uint64(257) + byte)
        place += 1


def hashed_counts(words: Vocabulary) -> np.ndarray:
    """Training counts of 0 and 1 in every slot: ``[order, slot, bit]``."""
    known = np.flatnonzero(words.counts > 0)
    words = words.take(known)
    table = np.zeros((len(ORDERS), 2 * SLOTS))
    for step in steps(words, exact=False):
        weight = words.counts[step.rows]
        for number, slot in enumerate(step.slots):
            table[number] += np.bincount(2 * slot + step.bits, weights=weight, minlength=2 * SLOTS)
    return table.reshape(len(ORDERS), SLOTS, 2)


def _gate(step: Step) -> np.ndarray:
    """The weight set: how often the beginning was seen in the class, and how often in any."""
    if step.place < EXACT_FROM:
        return np.full(len(step.rows), 30 + step.place, dtype=np.int64)
    (own0, own1), (any0, any1) = step.exact
    return bucket(own0 + own1) * 4 + bucket(any0 + any1) // 2


class Mixer:
    """Weights per gate, learned online, and the refinement table of mixed probabilities."""

    def __init__(self, gates: int, inputs: int):
        self.weights = np.full((gates, inputs), 1.0 / inputs)
        self.moved = np.full((gates, inputs), 1e-4)
        self.refined = np.zeros((gates, BINS, 2))

    def mixed(self, gate: np.ndarray, inputs: np.ndarray) -> np.ndarray:
        return (self.weights[gate] * inputs).sum(axis=1)

    def learn(self, gate, inputs, bits, weight, rate: float) -> None:
        """One step down the coding cost, with examples as heavy as they are frequent. A weight
        that has moved much moves less from then on."""
        error = (bits - squash(self.mixed(gate, inputs))) * weight
        gates = len(self.weights)
        mass = np.bincount(gate, weights=weight, minlength=gates) + 1e-9
        for k in range(inputs.shape[1]):
            push = np.bincount(gate, weights=error * inputs[:, k], minlength=gates) / mass
            self.moved[:, k] += push * push
            self.weights[:, k] += rate * push / np.sqrt(self.moved[:, k])

    def observe(self, gate, logit, bits, weight) -> None:
        """Record what came out where such a probability was given."""
        at = np.clip(np.rint(logit * 2) + BINS // 2, 0, BINS - 1).astype(np.int64)
        key = (gate * BINS + at) * 2 + bits
        self.refined += np.bincount(key, weights=weight, minlength=self.refined.size).reshape(
            self.refined.shape
        )

    def refinement(self) -> np.ndarray:
        """The refined logit at every bin: seen frequencies, with the bin itself as prior."""
        centre = (np.arange(BINS) - BINS // 2) / 2.0
        p = squash(centre)
        n0, n1 = self.refined[..., 0], self.refined[..., 1]
        prior = 20.0
        return np.log((n1 + prior * p) / (n0 + prior * (1 - p)))

    def refine(self, gate, logit, refinement) -> np.ndarray:
        """The mixed and the refined logit at equal weight."""
        place = np.clip(logit * 2 + BINS // 2, 0, BINS - 1)
        low = np.minimum(place.astype(np.int64), BINS - 2)
        part = place - low
        table = refinement.ravel()
        at = gate * BINS + low
        refined = table[at] * (1 - part) + table[at + 1] * part
        return np.clip(0.5 * (logit + refined), -30, 30)

    def log2_cost(self, gate, logit, bits, refinement) -> np.ndarray:
        """Bits that coding takes with the refined logit."""
        x = self.refine(gate, logit, refinement)
        return np.logaddexp(0.0, np.where(bits == 1, -x, x)) / np.log(2.0)


def train_mixer(
    words: Vocabulary, counts: np.ndarray, rate: float = 0.05, chunk: int = 8_192
) -> Mixer:
    """Learn weights online from all training tokens, in one pass with counts as weights; then
    record for the refinement what came out for each of them.

    A token that is coded again must not count on its own last occurrence, so counts are those
    without one of it; a token that occurs once is as if unseen.
    """
    mixer = Mixer(GATES, INPUTS)
    known = np.flatnonzero(words.counts > 0)
    rng = np.random.default_rng(len(known))
    for learning in (True, False):
        for step in steps(words, chosen=known):
            if not len(step.rows):
                continue
            order = rng.permutation(len(step.rows)) if learning else np.arange(len(step.rows))
            for start in range(0, len(order), chunk):
                part = order[start : start + chunk]
                gate, inputs = _inputs_left_out(step, counts, part)
                bits, weight = step.bits[part], words.counts[step.rows[part]]
                if learning:
                    mixer.learn(gate, inputs, bits, weight, rate)
                else:
                    mixer.observe(gate, mixer.mixed(gate, inputs), bits, weight)
    return mixer


def _inputs_left_out(step: Step, counts: np.ndarray, part) -> tuple[np.ndarray, np.ndarray]:
    """Gate and logits of some tokens of a step, each with itself left out once."""
    one = step.bits[part].astype(np.float64)
    zero = 1 - one
    left = [counts[number][slot[part]] for number, slot in enumerate(step.slots)]
    left = [(np.maximum(n[:, 0] - zero, 0), np.maximum(n[:, 1] - one, 0)) for n in left]
    exact = [(np.maximum(a[part] - zero, 0), np.maximum(b[part] - one, 0)) for a, b in step.exact]
    inputs = np.column_stack([stretch(a, b) for a, b in [*left, *exact]])
    return _gate(Step(step.place, step.rows[part], step.bits[part], [], exact)), inputs


def token_logits(
    words: Vocabulary, counts: np.ndarray, mixer: Mixer, opening, left_out: bool,
    chosen: np.ndarray | None = None,
) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """For every place and bit: the place, the tokens that go so far, their bits, and the refined
    logits of these given the class and the token's bytes so far. ``opening`` is of
    ``opening_logits``; with ``left_out`` every token is left out of the counts once. With
    ``chosen`` only these tokens are given out."""
    rows = np.arange(len(words.lengths)) if chosen is None else chosen
    lead = [words.byte(place, rows).astype(np.int64) for place in (0, 1)]
    kinds = words.kinds[rows].astype(np.int64)
    for place in (0, 1):
        before = kinds if place == 0 else kinds * 256 + lead[0]
        for depth in range(8):
            bits = ((lead[place] >> (7 - depth)) & 1).astype(np.int8)
            at = (before << depth) + (lead[place] >> (8 - depth))
            tables = opening[place * 8 + depth]
            x = np.where(bits == 1, tables[2].ravel()[at], tables[1].ravel()[at]) if left_out else (
                tables[0].ravel()[at]
            )
            yield place, rows, bits, x.astype(np.float32)
    refinement = mixer.refinement()
    size = 1 << 17
    for step in steps(words, chosen=chosen):
        found = np.zeros(len(step.rows), dtype=np.float32)
        for start in range(0, len(step.rows), size):
            part = slice(start, start + size)
            if left_out:
                gate, inputs = _inputs_left_out(step, counts, part)
            else:
                exact = [(a[part], b[part]) for a, b in step.exact]
                gate = _gate(Step(step.place, step.rows[part], step.bits[part], [], exact))
                inputs = np.column_stack(
                    [stretch(*counts[number][slot[part]].T) for number, slot in enumerate(step.slots)]
                    + [stretch(a, b) for a, b in exact]
                )
            found[part] = mixer.refine(gate, mixer.mixed(gate, inputs), refinement)
        yield step.place, step.rows, step.bits, found


@dataclass
class Past:
    """Distinct (token, class, previous token), the previous tokens one after the other and the
    tokens of each in lexicographic order: row of the pair, number of the previous token, training
    count, and row in ``heads`` of what is known of the first ``EXACT_FROM`` bytes after it."""

    pair: np.ndarray
    previous: np.ndarray
    counts: np.ndarray
    head: np.ndarray
    heads: np.ndarray


# A count as one byte: exact up to 128, then in steps of 1/12 up to some 77,000, then in steps of 3/5,
# so that counts differ in level up to 3 * 10 ** 14.
_LEVELS = np.concatenate([np.arange(129.0), 128.0 * (13 / 12) ** np.arange(1, 81)])
_LEVELS = np.concatenate([_LEVELS, _LEVELS[-1] * (8 / 5) ** np.arange(1, 48)])


def packed_counts(counts: np.ndarray) -> np.ndarray:
    """The nearest level of every count."""
    return np.searchsorted((_LEVELS[1:] + _LEVELS[:-1]) / 2, counts).astype(np.uint8)


def head_counts(previous: np.ndarray, lead: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """What followed each previous token: for the bits of the first ``EXACT_FROM`` bytes the counts
    of 0 and 1, packed. ``lead`` has these bytes as one number."""
    order = np.lexsort((lead, previous))
    before, lead, counts = previous[order], lead[order].astype(np.uint64), counts[order]
    made = np.zeros((len(order), 16 * EXACT_FROM), dtype=np.uint8)
    group = mix(before + np.uint64(1))
    column = 0
    for place in range(EXACT_FROM):
        byte = ((lead >> np.uint64(8 * (EXACT_FROM - 1 - place))) & np.uint64(255)).astype(np.uint8)
        for zero, one in _prefix_counts(group, byte, counts):
            made[order, column] = packed_counts(zero)
            made[order, column + 1] = packed_counts(one)
            column += 2
        group = mix(group * np.uint64(257) + byte)
    return made


def past_steps(words: Vocabulary, past: Past, logits) -> Iterator[tuple]:
    """Every bit of every row of ``past``: place, rows, bits, the token's own logit, and how often
    0 and 1 followed the previous token and the bytes so far."""
    group = np.ones(len(words.lengths), dtype=np.uint64)
    alive = np.arange(len(words.lengths))
    own = np.zeros(len(words.lengths), dtype=np.float32)
    value = np.zeros(len(words.lengths), dtype=np.int8)
    at = -1
    rows = np.arange(len(past.pair))
    known = None
    for place, tokens, bits, x in logits:
        if place != at:
            if at >= 0:
                group[alive] = mix(group[alive] * np.uint64(257) + words.byte(at, alive))
            at, number = place, 0
            alive = alive[words.lengths[alive] >= place]
            rows = rows[words.lengths[past.pair[rows]] >= place]
            pair = past.pair[rows]
            if place >= EXACT_FROM:
                byte = words.byte(place, pair)
                known = _prefix_counts(
                    mix(group[pair] + past.previous[rows] * np.uint64(0x9E3779B97F4A7C15)), byte,
                    past.counts[rows],
                )
        own[tokens], value[tokens] = x, bits
        if place >= EXACT_FROM:
            zero, one = next(known)
        else:
            column = 16 * place + 2 * number
            zero, one = (_LEVELS[past.heads[past.head[rows], column + k]] for k in (0, 1))
        number += 1
        yield place, rows, value[pair], own[pair], zero, one


def _past_inputs(place: int, own, zero, one) -> tuple[np.ndarray, np.ndarray]:
    gate = bucket(zero + one) * (EXACT_FROM + 1) + min(place, EXACT_FROM)
    return gate, np.column_stack([own, stretch(zero, one)])


def train_past(words: Vocabulary, past: Past, logits, rate: float = 0.02, chunk: int = 65_536) -> Mixer:
    """Learn how far to trust the previous token, online in one pass over all training rows, each
    left out once. ``logits`` are of ``token_logits`` with ``left_out``."""
    mixer = past_mixer()
    rng = np.random.default_rng(len(past.pair))
    for place, rows, bits, own, zero, one in past_steps(words, past, logits):
        weight = past.counts[rows]
        known = rng.permutation(np.flatnonzero(weight > 0))
        for start in range(0, len(known), chunk):
            part = known[start : start + chunk]
            b = bits[part]
            gate, inputs = _past_inputs(
                place, own[part], np.maximum(zero[part] - (b == 0), 0), np.maximum(one[part] - b, 0)
            )
            mixer.learn(gate, inputs, b, weight[part], rate)
    return mixer


def past_mixer() -> Mixer:
    mixer = Mixer(PAST_GATES, 2)
    mixer.weights[:] = (1.0, 0.0)
    return mixer


def past_costs(words: Vocabulary, past: Past, logits, mixer: Mixer) -> np.ndarray:
    """Bits that coding each row of ``past`` takes, with its closing blank."""
    total = np.zeros(len(past.pair))
    weights = mixer.weights.astype(np.float32)
    size = 1 << 17
    for place, rows, bits, own, zero, one in past_steps(words, past, logits):
        for start in range(0, len(rows), size):
            part = slice(start, start + size)
            gate, inputs = _past_inputs(place, own[part], zero[part], one[part])
            x = (weights[gate] * inputs.astype(np.float32)).sum(axis=1)
            x = np.clip(np.where(bits[part] == 1, x, -x), -30, 30)
            total[rows[part]] += np.log(1 + np.exp(-x)) / np.log(2.0)
    return total


def opening_logits(pairs: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Logits for the bits of the first two bytes of a token, by its class and the bits before.

    ``pairs[class, first * 256 + second]`` are training counts. Two predictors, with and without
    the class, are mixed by how much the class has been seen under that beginning. Per bit there
    are three tables: from all counts, and with one 0 or one 1 left out.
    """
    mixer = Mixer(8, 2)
    joint = pairs.reshape(len(pairs), 256, 256)

    def inputs(counts, depth: int, left_out: bool):
        """For one bit of one byte: gates, logits of both predictors, and the two halves."""
        shape = counts.shape[:-1] + (1 << depth, 2, 1 << (7 - depth))
        halves = counts.reshape(shape).sum(axis=-1)
        shared = halves.sum(axis=0, keepdims=True)
        found = []
        for bit in (0, 1):
            own = np.zeros(2)
            own[bit] = float(left_out)
            a, b = np.maximum(halves - own, 0), np.maximum(shared - own, 0) + np.zeros_like(halves)
            logits = np.stack([stretch(a[..., 0], a[..., 1]), stretch(b[..., 0], b[..., 1])], -1)
            found.append((bucket(a.sum(axis=-1)), logits, halves[..., bit]))
        return found

    for rate in (0.3, 0.2, 0.15, 0.1, 0.05):
        for counts in (joint.sum(axis=2), joint):
            for depth in range(8):
                for bit, (gate, logits, weight) in enumerate(inputs(counts, depth, True)):
                    seen = weight.ravel() > 0
                    if seen.any():
                        w = weight.ravel()[seen]
                        mixer.learn(gate.ravel()[seen], logits.reshape(-1, 2)[seen],
                                    np.full(int(seen.sum()), bit), w, rate)
    found = []
    for counts in (joint.sum(axis=2), joint):
        for depth in range(8):
            plain = inputs(counts, depth, False)[0]
            tables = [plain, *inputs(counts, depth, True)]
            found.append(
                tuple(
                    np.clip(mixer.mixed(g.ravel(), x.reshape(-1, 2)).reshape(g.shape), -30, 30)
                    for g, x, _ in tables
                )
            )
    return found


def opening_costs(pairs: np.ndarray) -> np.ndarray:
    """Bits for the first two bytes of a token by its class."""
    costs = np.zeros((len(pairs), 256, 256))
    for number, (x, _, _) in enumerate(opening_logits(pairs)):
        both = np.stack([np.logaddexp(0, x), np.logaddexp(0, -x)], -1) / np.log(2.0)
        spread = np.repeat(both.reshape(*x.shape[:-1], -1), 1 << (7 - number % 8), axis=-1)
        costs += spread[..., None] if number < 8 else spread
    return costs.reshape(pairs.shape)


def profile(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Per text the square roots of the shares of its byte pairs, hashed to 256 columns."""
    found = np.zeros((len(offsets) - 1, 256), dtype=np.float32)
    for row, (start, stop) in enumerate(zip(offsets[:-1], offsets[1:])):
        pair = data[start:stop].copy()
        pair[:-1] = pair[:-1] * np.uint8(31) + pair[1:] * np.uint8(7)
        found[row] = np.bincount(pair, minlength=256)
    return np.sqrt(found / np.maximum(found.sum(axis=1, keepdims=True), 1))


def nearest(profiles: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (profiles @ centres.T - 0.5 * (centres * centres).sum(axis=1)).argmax(axis=1)


def fit_classes(profiles: np.ndarray, classes: int = CLASSES, rounds: int = 15) -> np.ndarray:
    """Centres of the kinds of text in a sample, by k-means from far apart profiles."""
    if not len(profiles):
        return np.zeros((classes, 256), dtype=np.float32)
    centres = [profiles.mean(axis=0)]
    far = ((profiles - centres[0]) ** 2).sum(axis=1)
    centres = []
    for _ in range(classes):
        at = int(np.argsort(far)[int(0.97 * (len(far) - 1))])
        centres.append(profiles[at])
        far = np.minimum(far, ((profiles - centres[-1]) ** 2).sum(axis=1))
    found = np.array(centres)
    for _ in range(rounds):
        own = nearest(profiles, found)
        for k in range(classes):
            if (own == k).any():
                found[k] = profiles[own == k].mean(axis=0)
    return found
