"""Shards of the language model: how large one gets, and that parting one changes no code length."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tapmart.llm import lm_scoring
from tapmart.llm.context_mixing import (
    CLASSES, GATES, INPUTS, Mixer, hashed_counts, opening_logits, past_costs, past_mixer, token_logits,
)

CENTRES = np.random.default_rng(5).random((CLASSES, 256)).astype(np.float32)


def texts(n: int, size: int = 200) -> list[str]:
    """Half of the tokens begin alike; the tokens before them are many."""
    rng = np.random.default_rng(n)
    made = []
    for _ in range(n):
        a, b = rng.integers(0, 400, size), rng.integers(0, 5_000, size)
        made.append(" ".join(f"w{y} {'the' if x < 150 else f'commonly{x}'}" for x, y in zip(a, b)))
    return made


def led(given: list[str], buckets: int) -> np.ndarray:
    rows = lm_scoring._led(buckets)(iter([pa.RecordBatch.from_pydict({"text": pa.array(given)})]))
    return np.concatenate([np.frombuffer(c, "<f8") for c in next(rows).column("counts").to_pylist()])


def shard_rows(given: list[str], dealt) -> tuple[list[pa.RecordBatch], list[dict]]:
    half, listed = len(given) // 2, []
    for block, part in enumerate((given[:half], given[half:])):
        held = np.arange(len(part)) % 5 == 2
        listed += lm_scoring.block_rows(pa.array(part), list(range(len(part))), held, block, dealt, CENTRES)
    rows = pa.Table.from_batches(list(lm_scoring._merged(dealt)(iter(listed))))
    shards = rows.filter(pa.compute.equal(rows["kind"], lm_scoring._SHARD)).to_batches(1)
    blocks = rows.filter(pa.compute.equal(rows["kind"], lm_scoring._BLOCK)).to_pylist()
    return [b for s in shards for b in (s.slice(i, 1) for i in range(s.num_rows))], blocks


def code_lengths(given: list[str], dealt) -> np.ndarray:
    """Bits of every text, with mixers that have learned nothing, and how often each token was seen."""
    shards, blocks = shard_rows(given, dealt)
    rows = [s.to_pylist()[0] for s in shards]
    parted = [s.select(["group", "vocabulary"]) for s, r in zip(shards, rows) if r["parted"]]
    wholes = {r["group"]: r for b in lm_scoring._wholes(iter(parted)) for r in b.to_pylist()}
    vocabularies = [r for r in rows if not r["parted"]] + list(wholes.values())
    counts = sum(hashed_counts(lm_scoring._vocabulary(v["vocabulary"])[0]) for v in vocabularies)
    openings = np.zeros(CLASSES * 65536)
    for r in rows:
        used, seen = np.frombuffer(r["openings"], "<i8").reshape(2, -1)
        np.add.at(openings, used, seen)
    opening = opening_logits(openings.reshape(CLASSES, 65536))
    asked = lm_scoring._heads(dealt)(iter(shards))
    replies = pa.Table.from_batches(list(lm_scoring._replied(asked))).to_pandas()
    mixer = past_mixer()
    mixer.weights[:] = 0.5
    found: dict[int, dict[int, np.ndarray]] = {}
    for r in rows:
        own = replies[replies["shard"] == r["shard"]]
        if r["parted"]:
            whole = {"shard": r["shard"], "bucket": lm_scoring._OF_GROUP, "heads": wholes[r["group"]]["vocabulary"]}
            own = pd.concat([own, pd.DataFrame([whole])])
        words, by_word, past, chosen = lm_scoring._opened(r, own, dealt)
        logits = token_logits(words, counts, Mixer(GATES, INPUTS), opening, False, chosen)
        bits = past_costs(words, past, logits, mixer)
        for block, pick in zip(r["blocks"], lm_scoring._unpacked(r["picks"])):
            at = lm_scoring._from_planes(pick).astype(np.int64)
            found.setdefault(block, {})[r["shard"]] = np.stack([bits[at], by_word[past.pair[at]]])
    made = [vocabularies, []]
    for block in sorted(blocks, key=lambda b: b["block"]):
        value = np.concatenate([v for _, v in sorted(found[block["block"]].items())], axis=1)
        step, many = map(lm_scoring._from_planes, lm_scoring._unpacked(block["bag"]))
        ends = np.cumsum(block["bag_sizes"])
        for a, b in zip(ends - block["bag_sizes"], ends):
            item = np.cumsum(step[a:b].astype(np.uint32)).astype(np.int64)
            made[1].append((value[:, item] * many[a:b]).sum(axis=1))
    types = sum(v["train_types"] for v in vocabularies), sum(v["train_tokens"] for v in vocabularies)
    return np.array(made[1]), types


def test_a_shard_of_a_common_beginning_is_bounded(monkeypatch):
    monkeypatch.setattr(lm_scoring, "SHARD_TOKENS", 2_000)
    given = texts(100)
    counts = led(given, 256)
    assert counts.sum() == 100 * 401
    dealt = lm_scoring.deal(counts, 4)
    assert dealt.places == 8
    rows = [s.to_pylist()[0] for s in shard_rows(given, dealt)[0]]
    sizes = [sum(len(p) // 4 for p in lm_scoring._unpacked(r["picks"])) for r in rows]
    assert max(sizes) < 1.3 * 2_000
    # All tokens of one beginning went to one shard: 'the' alone has 7,500 previous tokens and classes.
    assert dealt.parts.max() > 3 and any(r["parted"] for r in rows)
    # Parts of one beginning go to different tasks.
    group = int(dealt.parts.argmax())
    first = dealt.first[group]
    assert len(set(dealt.place(np.arange(first, first + dealt.parts[group])).tolist())) > 3


def test_parting_changes_no_code_length():
    given = texts(40) + ["", "the", "the end", "wholly other words"]
    one, seen_one = code_lengths(given, lm_scoring.Deal(1, np.ones(1, dtype=np.int64)))
    parts = np.array([1, 3, 1, 7, 2, 1, 1, 5])
    many, seen_many = code_lengths(given, lm_scoring.Deal(4, parts, runs=3))
    assert seen_one == seen_many
    np.testing.assert_allclose(many[:, 0], one[:, 0], rtol=1e-6)
    np.testing.assert_array_equal(many[:, 1], one[:, 1])


def test_parted_shards_give_the_same_counts_and_base_scores(spark, monkeypatch):
    docs = spark.createDataFrame(list(enumerate([*texts(30), None, "", "the"])), "doc_id bigint, text string")

    def scored():
        found = lm_scoring.score_documents(docs, F.col("doc_id") % 7 == 2).toPandas()
        return found.sort_values("doc_id").reset_index(drop=True)

    whole = scored()
    monkeypatch.setattr(lm_scoring, "SHARD_TOKENS", 1_000)
    parted = scored()
    exact = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens"]
    pd.testing.assert_frame_equal(whole[exact], parted[exact])
    np.testing.assert_allclose(whole["base_score"], parted["base_score"], rtol=1e-9)
    assert np.isfinite(parted["score"]).all()


@pytest.mark.parametrize("fields", [[], [b""], [b"", b"ab", b""], [b"x" * 100_000, b"y"]])
def test_fields_come_back_from_their_compressed_value(fields):
    assert [bytes(f) for f in lm_scoring._unpacked(lm_scoring._packed(*fields))] == fields
