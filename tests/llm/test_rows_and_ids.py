"""Documents under repeated and null ids: links and copies follow rows and texts, not ids."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_documents import components_by_force, variants

import corpus_pipeline as pipeline
from tapmart.llm import ngram_join
from tapmart.llm.ngram_join import near_duplicates, one_of_each

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def words(seed, count=60):
    draw = random.Random(seed)
    return [f"w{draw.randrange(10_000)}" for _ in range(count)]


def near(text, at):
    changed = list(text)
    changed[at] = "changed"
    return " ".join(changed)


def rows():
    a, b, c, d = (words(n, 80) for n in range(4))
    return [
        (7, " ".join(a), "en", "x", 1), (7, " ".join(b), "en", "x", 2), (9, near(a, 0), "en", "y", 3),
        (5, near(b, 79), "en", "y", 4), (None, " ".join(c), "en", "x", 5), (3, near(c, 0), "en", "y", 6),
        (None, " ".join(d), "en", "x", 7), (None, near(d, 0), "en", "x", 8), (7, " ".join(a), "en", "x", 1),
        (11, "", "en", "x", 9), (11, None, "en", "x", 10), (None, None, "en", "x", 11),
    ]


@pytest.mark.parametrize("parts", [1, 2, 3])
def test_links_follow_texts_over_any_partitions(spark, parts):
    docs = spark.createDataFrame(rows(), SCHEMA).repartition(parts)
    found = near_duplicates(docs, width=3, percent=90).collect()
    told = Counter((r["doc_id"], r["component_id"]) for r in found)
    assert told == Counter(
        {(7, 7): 2, (7, 5): 1, (9, 7): 1, (5, 5): 1, (None, 3): 1, (3, 3): 1, (None, None): 3, (11, 11): 2}
    )
    kept = one_of_each(docs, width=3, percent=90)
    assert kept.columns == docs.columns
    left = sorted((r["doc_id"] or 0, r["n_chars"]) for r in kept.collect())
    ones = [pair for pair in left if pair[1] not in (7, 8)]
    assert ones == [(0, 11), (3, 6), (5, 4), (7, 1), (11, 9), (11, 10)] and len(left) == 7


def test_mixture_repeats_rows_and_loses_none(spark):
    plenty = [(None, "one two three", "en", "a", n) for n in range(4)]
    plenty += [(1, "one two three", "en", "b", 10 + n) for n in range(4)]
    docs = spark.createDataFrame(plenty, SCHEMA)
    mixed = Counter(r["n_chars"] for r in pipeline.mixture(spark, docs, "").collect())
    # Source b takes two thirds of 24 words, 16 of its 12; source a 8 of its 12.
    assert sum(v for k, v in mixed.items() if k >= 10) in (5, 6)
    assert sum(v for k, v in mixed.items() if k < 10) in (2, 3)
    assert max(mixed.values()) <= 3 and {10, 11, 12, 13} <= set(mixed)


def test_first_elements_meet_for_families_of_changed_copies(spark):
    base = words(1, 300)
    family = []
    for n in range(60):
        draw = random.Random(100 + n)
        changed = list(base)
        for at in draw.sample(range(300), 2 + n % 7):
            changed[at] = f"c{n}x{at}"
        family.append((n, " ".join(changed), "en", "x", 0))
    docs = spark.createDataFrame(family, SCHEMA).repartition(4)
    sets = [
        {tuple(t.split()[i : i + 3]) for i in range(298)} for _, t, *_ in family
    ]
    least = list(range(60))
    for _ in range(60):
        for i in range(60):
            for j in range(i):
                if 100 * len(sets[i] & sets[j]) >= 90 * len(sets[i] | sets[j]):
                    least[i] = least[j] = min(least[i], least[j])
    found = {r["doc_id"]: r["component_id"] for r in near_duplicates(docs).collect()}
    assert found == dict(enumerate(least))
    assert docs.where(F.col("text").isNull()).count() == 0


@pytest.mark.parametrize(("crowd", "block"), [(0, 4), (2, 1), (5, 128)])
def test_crowded_elements_give_the_same_links(spark, monkeypatch, crowd, block):
    monkeypatch.setattr(ngram_join, "CROWD", crowd)
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    blocks = []
    plain = ngram_join._block_pairs
    monkeypatch.setattr(ngram_join, "_block_pairs", lambda *a: blocks.append(a) or plain(*a))
    texts = variants(11)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(3)
    rows = near_duplicates(docs, width=3, percent=90).collect()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert found == components_by_force(texts, 3, 90)
    assert blocks or crowd


def test_blocks_are_compared_by_sizes_and_sketches(spark):
    rng = np.random.default_rng(2)
    n, percent = 150, 90
    sketches = rng.integers(-(2**63), 2**63 - 1, size=(12, 4))[rng.integers(0, 12, n)]
    sketches[:, 0] ^= 1 << rng.integers(0, 20, n)
    sizes, kinds = rng.integers(200, 240, n), rng.integers(0, 6, n)
    rows = [(7, n, i, int(kinds[i]), int(sizes[i]), *map(int, sketches[i])) for i in range(n)]
    schema = "element bigint, many bigint, node bigint, component bigint, size bigint, " + (
        "s0 bigint, s1 bigint, s2 bigint, s3 bigint"
    )
    frame = spark.createDataFrame(rows, schema).repartition(4)
    found = {(r["a"], r["b"]) for r in ngram_join._block_pairs(frame, percent).collect()}
    expected = set()
    for i in range(n):
        for j in range(i + 1, n):
            apart = sum(int(x & (2**64 - 1)).bit_count() for x in map(int, sketches[i] ^ sketches[j]))
            small, large = sorted((int(sizes[i]), int(sizes[j])))
            if kinds[i] != kinds[j] and 100 * small >= percent * large:
                if (100 + percent) * apart <= (100 - percent) * (small + large):
                    expected.add((i, j))
    assert found == expected and found


def test_block_pairs_come_out_once_however_many_elements_sets_share(spark):
    rng = np.random.default_rng(5)
    sets = {node: set(rng.choice(40, 30, replace=False).tolist()) for node in range(300)}
    rows = [
        (element, node, node, 400, 0, 0, 0, 0, sum(element in s for s in sets.values()))
        for node, own in sets.items()
        for element in own
    ]
    crowded = spark.createDataFrame(
        rows,
        "element bigint, node bigint, component bigint, size bigint, s0 bigint, s1 bigint, "
        "s2 bigint, s3 bigint, many bigint",
    )
    found = [tuple(r) for r in ngram_join._block_pairs(crowded, 90).collect()]
    wanted = {(a, b) for a in sets for b in sets if a < b and sets[a] & sets[b]}
    assert set(found) == wanted
    assert len(found) < 1.1 * len(wanted)
