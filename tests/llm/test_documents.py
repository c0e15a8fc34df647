"""Operators on documents: hand-made cases, and brute force on the small tables."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tapmart.llm.context_mixing import (
    _LEVELS, Mixer, Vocabulary, fit_classes, head_counts, lexicographic, opening_costs, packed_counts,
    profile, train_mixer,
)
from tapmart.llm.exact_dedup import exact_dedup
from tapmart.llm.language_id import calibrated_temperature, fit_languages
from tapmart.llm.line_dedup import drop_common_lines
from tapmart.llm.lm_scoring import _class_sums, score_documents
from tapmart.llm.mixing import mix_sources
from tapmart.llm.ngram_join import PartEnum, near_duplicates
from tapmart.llm.packing import Packer, WordTokenizer, pack_documents
from tapmart.llm.quality import fit_quality, frozen_statistics, score_quality
from tapmart.llm.queries import QUERIES
from tapmart.llm.sharding import difference, shard_by_bytes
from tapmart.llm.tokens import Words
from tapmart.llm.vector_search import top_k

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, size bigint, "
    "_row int, digest string, node bigint"
)
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LONG = " ".join(f"long{i % 997}word{i}" for i in range(30_000))


def words(text) -> list[bytes]:
    return WORD.findall((text or "").encode().translate(LOWER))


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and very long texts, repeated rows, columns with clashing names."""
    texts = [None, "", "   \n\t", "One line", "one LINE \nother", LONG, "é\n\nß 中文  x", "One line"]
    rows = [(i, t, "en", f"s{i % 3}", 1, 7, 1, "d", 5) for i, t in enumerate(texts)]
    rows += [rows[4], rows[4], (None, "One line", None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


RUNS = {
    "lines": lambda d: drop_common_lines(d),
    "exact": lambda d: exact_dedup(d),
    "near": lambda d: near_duplicates(d),
    "mix": lambda d: mix_sources(d, F.length("text")),
    "shard": lambda d: shard_by_bytes(d),
    "lm": lambda d: score_documents(d, F.col("doc_id") == 3),
    "language": lambda d: fit_languages(d, F.lit(True)).predict(d),
    "quality": lambda d: score_quality(frozen_statistics(d), None),
}


@pytest.mark.parametrize("name", RUNS)
def test_every_row_has_a_result_and_an_empty_table_none(odd, empty, name):
    assert RUNS[name](odd).count() == odd.count()
    assert RUNS[name](empty).collect() == []


def test_common_lines_lose_all_their_copies(spark):
    rows = [(i, f"  Shared LINE\x0b\nown {i}\n") for i in range(10)] + [(10, "shared line"), (11, None)]
    rows += [(12, "twice\ntwice")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in drop_common_lines(docs).collect()}
    assert found[3]["line_kept_text"] == "own 3\n" and found[3]["line_dropped"] == 1
    assert found[10]["line_kept_text"] == "" and found[10]["line_count"] == 1
    assert (found[11]["line_count"], found[11]["line_dropped"]) == (1, 0)
    assert found[12]["line_dropped"] == 0
    few = drop_common_lines(docs.where("doc_id < 9"), min_documents=10)
    assert few.agg(F.sum("line_dropped")).first()[0] == 0


def test_exact_dedup_keeps_the_longest_then_the_smallest_id(odd):
    rows = exact_dedup(odd).collect()
    kept = [r for r in rows if r["kept"]]
    assert len(kept) == len({r["text_sha256"] for r in rows})
    blank = [r for r in rows if r["doc_id"] in (0, 1, 2)]
    assert {r["keep_id"] for r in blank} == {2} and {r["group_size"] for r in blank} == {3}
    assert {r["text_sha256"] for r in blank} == {hashlib.sha256(b"").hexdigest()}
    # Three rows of one id and text: one of them stays.
    assert sorted(r["kept"] for r in rows if r["doc_id"] == 4) == [False, False, True]


def components_by_force(texts, width, percent):
    sets = {
        i: {tuple(w[j : j + width]) for j in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
        for i, w in ((i, words(t)) for i, t in texts.items())
    }
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    return {i: (len(sets[i]), find(i)) for i in ids}


def variants(seed: int) -> dict[int, str]:
    """Families of texts that were changed a little, around the similarity that counts."""
    rng = np.random.default_rng(seed)
    texts = {}
    for family in range(6):
        size = int(rng.integers(2, 120))
        base = [f"w{rng.integers(0, 400)}" for _ in range(size)]
        for _ in range(14):
            text = list(base)
            for _ in range(int(rng.integers(0, 1 + size // 12))):
                text[int(rng.integers(0, size))] = f"n{rng.integers(0, 10**6)}"
            texts[len(texts)] = " ".join(text)
    texts[len(texts)] = ""
    return texts


@pytest.mark.parametrize(("width", "percent"), [(3, 90), (5, 80)])
def test_near_duplicates_against_brute_force(spark, width, percent):
    texts = variants(width)
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").repartition(5)
    rows = near_duplicates(docs, width=width, percent=percent).collect()
    found = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows}
    assert found == components_by_force(texts, width, percent)


@pytest.mark.parametrize(("percent", "depth", "n2"), [(90, 0, 1), (80, 0, 1), (80, 1, 3), (60, 2, 4)])
def test_similar_sets_share_a_signature(percent, depth, n2):
    rng = np.random.default_rng(percent + depth)
    scheme = PartEnum(percent, depth, n2)
    for _ in range(300):
        size = int(rng.integers(1, 90))
        a = np.unique(rng.integers(0, 2**62, size, dtype=np.uint64))
        b = a.copy()
        while True:
            c = np.unique(np.append(b[1:], rng.integers(0, 2**62, 1, dtype=np.uint64)))
            rng.shuffle(c)
            common = len(np.intersect1d(a, c))
            if 100 * common < percent * (len(a) + len(c) - common):
                break
            b = c
        x, y = scheme.signatures(np.sort(a)), scheme.signatures(np.sort(b))
        assert len(np.intersect1d(x, y)), (a, b)


def test_packing_is_an_exact_round_trip(odd):
    from tokenizers import Tokenizer

    full = Tokenizer.from_file(tokenizer())
    full.encode_special_tokens = True
    pieces = pack_documents(odd, tokenizer(), with_ids=True, length=256).collect()
    texts = collections.defaultdict(list)
    for row in odd.collect():
        texts[row["doc_id"]].append(row["text"] or "")
    encoded = {
        d: full.encode(t[0], add_special_tokens=False).ids + [2] for d, t in list(texts.items())
    }
    tokens = collections.Counter()
    for p in pieces:
        ids = encoded[p["doc_id"]]
        assert p["ids"] == ids[p["start"] : p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes())
        assert p["doc_tokens"] == len(ids)
        tokens[p["doc_id"]] += p["length"]
    assert all(tokens[d] == len(encoded[d]) * len(texts[d]) for d in texts)
    sequences = collections.defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append((p["offset"], p["length"]))
    for found in sequences.values():
        at = 0
        for offset, length in sorted(found):
            assert offset == at
            at += length
        assert at == 256 or at & (at - 1) == 0
    assert pack_documents(odd.limit(0), tokenizer()).collect() == []


def test_added_tokens_are_read_as_the_tokenizer_reads_them():
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer())
    texts = ["one <|endoftext|> two", "x<|endoftext|>y <|ENDOFTEXT|>", "none of them, here.", None]
    for text, ids in zip(texts, WordTokenizer(tokenizer()).encode(texts)):
        expected = plain.encode(text or "", add_special_tokens=False).ids + [2]
        assert np.frombuffer(ids, "<u4").tolist() == expected
    assert 49407 in plain.encode(texts[0], add_special_tokens=False).ids


def test_words_are_read_as_the_library_reads_them_and_are_not_kept(monkeypatch):
    import random
    import tracemalloc

    from tokenizers import Tokenizer

    from tapmart.llm import packing

    monkeypatch.setattr(packing, "RUN_BYTES", 1 << 18, raising=False)
    plain, ours = Tokenizer.from_file(tokenizer()), WordTokenizer(tokenizer())
    rng = random.Random(7)
    letters = "aAzZ\u00c4\u00e4\u00df\u0149\u0130\u0131\u00c9,. .,\t\n\x0b\x1c\u00a0's09-\u0301\u03a3K\u8a9e\U0001f600"
    texts = ["".join(rng.choices(letters, k=rng.randrange(30))) for _ in range(3_000)]
    for text, ids in zip(texts, ours.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text).ids + [2], text
    words = ["".join(rng.choices("abcdefgh", k=12)) for _ in range(60_000)]
    texts = [" ".join(words[i : i + 100]) for i in range(0, len(words), 100)]
    list(ours.encode(texts[:5]))
    tracemalloc.start()
    assert sum(len(ids) for ids in ours.encode(texts)) > 4 * len(words)
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 1_000_000


def test_packer_balances_cost():
    packer = Packer(1000)
    rng = np.random.default_rng(3)
    for i in range(500):
        packer.add(i, int(rng.integers(1, 700)))
    full = [s for s in packer.sequences(last=False)]
    assert all(sum(n for _, _, n in s) == 1000 for s in full)
    costs = [sum(n * n for _, _, n in s) for s in full]
    assert max(costs) <= 2.5 * (sum(costs) / len(costs))


def test_differencing_is_tighter_than_first_fit_and_complete():
    sizes = [8, 7, 6, 5, 4]
    placed = difference([[s] for s in sizes], 2)
    totals = [0, 0]
    for size, by_part in zip(sizes, placed):
        totals[by_part[0]] += size
    assert sorted(totals) == [14, 16]
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 10_000, 400).tolist()
    totals = np.zeros(24)
    for size, by_part in zip(sizes, difference([[s] for s in sizes], 24)):
        totals[by_part[0]] += size
    greedy = np.zeros(24)
    for size in sorted(sizes, reverse=True):
        greedy[greedy.argmin()] += size
    assert np.ptp(totals) <= np.ptp(greedy) and totals.sum() == greedy.sum()
    assert difference([], 3) == []


def test_equal_texts_share_a_shard(odd):
    rows = shard_by_bytes(odd, shards=3).collect()
    slots = collections.defaultdict(list)
    shard = collections.defaultdict(set)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
        shard[(r["size"], r["text_crc32"])].add(r["shard"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in shard.values())


def test_targets_stop_at_three_times_a_source(spark):
    rows = [(i, "a", 10) for i in range(50)] + [(100 + i, "b", 1) for i in range(20)]
    rows += [(200 + i, None, 7) for i in range(200)] + [(500, "c", None), (501, "c", 0)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, words int")
    mix = mix_sources(docs, F.col("words")).collect()
    total = sum(s or 0 for _, _, s in rows)
    targets = {r["source"]: r["target"] for r in mix}
    assert targets["b"] == 60 and targets["c"] == 0
    assert math.isclose(sum(targets.values()), total)
    assert math.isclose(targets["a"], (total - 60) * 1 / 2)
    taken = collections.Counter()
    for r in mix:
        taken[r["source"]] += r["copies"] * r["size"]
        assert 0 <= r["copies"] <= 3
    assert all(abs(taken[s] - t) <= 10 for s, t in targets.items())
    again = mix_sources(docs.repartition(7), F.col("words")).collect()
    assert sorted(map(str, again)) == sorted(map(str, mix))


def test_top_k_is_exact(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 8))
    vectors[100:160] = vectors[100]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors)]
    rows += [(900, None), (901, [None] * 8), (902, [float("nan")] * 8), (903, []), (904, [float("inf")] * 8)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = top_k(frame, F.col("id") % 100 == 0, k=10).collect()
    v = np.floor(1024 * vectors.astype(np.float32).astype(float)).astype(np.int64)
    for q in (0, 100, 200):
        others = [i for i in range(300) if i != q]
        best = sorted(others, key=lambda i: (-int(v[q] @ v[i]), i))[:10]
        got = sorted((r["rank"], r["id"], r["score"]) for r in found if r["query_id"] == q)
        assert got == [(n + 1, i, int(v[q] @ v[i])) for n, i in enumerate(best)]
    few = top_k(frame.where("vec_id < 3"), F.col("id") == 0, k=10).collect()
    assert sorted(r["rank"] for r in few) == [1, 2]
    assert top_k(frame.where("vec_id > 899"), F.col("id") > 0).collect() == []


def test_language_model_counts_and_probabilities(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in rows}
    tokens = {r["doc_id"]: [*words(r["text"]), b"\n"] for r in rows}
    counts = collections.Counter(w for i, t in tokens.items() if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    for r in QUERIES["op2_lm_scoring"](spark, SF_DIR).collect():
        own = tokens[r["doc_id"]]
        assert r["held_out"] == held[r["doc_id"]] and r["train_tokens"] == n
        assert r["n_tokens"] == len(own) and r["n_known"] == sum(w in counts for w in own)
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9)
        # Well under two bytes' worth of bits per byte, and no more likely than certain.
        size = sum(len(w) + 1 for w in own)
        assert -size * 8 * math.log10(2) < r["score"] < 0


def test_order_of_words_counts_in_the_score(spark):
    rng = np.random.default_rng(5)
    follows = {f"word{i}": f"word{(7 * i + 3) % 40}" for i in range(40)}
    rows = []
    for i in range(300):
        text = [f"word{rng.integers(40)}"]
        while len(text) < 30:
            text.append(follows[text[-1]])
        rows.append((i, " ".join(text)))
    shuffled = rows[-1][1].split()
    rng.shuffle(shuffled)
    rows.append((300, " ".join(shuffled)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in score_documents(docs, F.col("doc_id") >= 299).collect()}
    assert got[299]["base_score"] == pytest.approx(got[300]["base_score"])
    assert got[299]["score"] > got[300]["score"] + 5
    size = len(rows[299][1])
    assert got[299]["bits_per_byte"] == pytest.approx(-got[299]["score"] / math.log10(2) / size)


def test_counts_after_the_previous_token_and_their_packing():
    n = np.arange(129)
    assert (_LEVELS[packed_counts(n)] == n).all()
    many = np.array([200.0, 1_000.0, 50_000.0])
    assert np.allclose(_LEVELS[packed_counts(many)], many, rtol=0.05)
    huge = 10.0 ** np.arange(6, 15)
    assert len(_LEVELS) == 256 and np.allclose(_LEVELS[packed_counts(huge)], huge, rtol=0.31)
    lead = np.array([0x61622020, 0x61632020, 0x61622020], dtype=np.uint64)
    found = head_counts(np.array([1, 1, 2], dtype=np.uint64), lead, np.array([3.0, 5.0, 7.0]))
    # The second byte is b or c, which part at the last bit; the second token is never mixed in.
    assert found[:, 30:32].tolist() == [[3, 5], [3, 5], [7, 0]]
    assert found[0, :2].tolist() == [8, 0] and found[2, :2].tolist() == [7, 0]


def test_mixer_learns_from_every_training_token():
    tokens = sorted(f"same{i:05d}".encode() + b" " for i in range(9_000))
    data = np.frombuffer(b"".join(t[:-1] for t in tokens), np.uint8)
    lengths = np.full(len(tokens), 9)
    counts = np.arange(len(tokens)) % 3.0
    words = Vocabulary(data, lengths, counts, np.zeros(len(tokens), dtype=np.uint8))
    mixer = train_mixer(words, np.zeros((5, 1 << 18, 2), dtype=np.float32))
    # Bytes 2 to 8 and the closing blank of every token, as often as it occurs.
    assert mixer.refined.sum() == 8 * 8 * counts.sum()


def test_classes_are_means_of_all_documents():
    texts = pa.array(["ab ab ab"] * 3 + ["xyz xyz"] * 5)
    words = Words(texts)
    rows = profile(words.data, words.offsets)
    batch = pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in rows])], ["profile"])
    (made,) = _class_sums(np.concatenate([rows[[0, 7]], np.full((6, 256), 9, np.float32)]))([batch])
    assert made.column("n").to_pylist() == [3, 5]


def test_openings_are_probabilities():
    rng = np.random.default_rng(0)
    pairs = np.zeros((2, 65536))
    pairs[:, rng.integers(0, 65536, 50)] = 5
    costs = opening_costs(pairs)
    assert np.allclose((2.0**-costs).sum(axis=1), 1.0, atol=1e-6)


def test_refined_probabilities_of_a_bit_add_up_to_one():
    mixer = Mixer(4, 2)
    gate, logit = np.array([0, 1, 2, 3]), np.array([-3.0, 0.2, 9.0, 0.0])
    mixer.observe(gate, logit, np.array([1, 0, 1, 1]), np.ones(4))
    table = mixer.refinement()
    zero = mixer.log2_cost(gate, logit, np.zeros(4, int), table)
    one = mixer.log2_cost(gate, logit, np.ones(4, int), table)
    assert np.allclose(2.0**-zero + 2.0**-one, 1.0)


def test_lexicographic_order_and_classes_of_nothing():
    data = np.frombuffer(b"baab", np.uint8)
    assert lexicographic(data, np.array([1, 1, 2])).tolist() == [1, 2, 0]
    assert fit_classes(np.zeros((0, 256))).shape == (8, 256)


def test_languages_are_told_apart_on_held_out_documents(spark):
    rows = QUERIES["op5_language_id"](spark, "/root/testdata/sf0.01").collect()
    langs = {
        r["doc_id"]: r["lang"]
        for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()
    }
    kept = [r for r in rows if r["held_out"]]
    assert sum(r["lang_pred"] == langs[r["doc_id"]] for r in kept) >= 0.97 * len(kept)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_texts_without_letters_are_undetermined(odd):
    found = {r["doc_id"]: r for r in fit_languages(odd, F.lit(True)).predict(odd).collect()}
    assert {found[i]["lang_pred"] for i in (0, 1, 2)} == {"und"} and found[0]["score"] == 0
    assert found[3]["lang_pred"] == "en"
    assert calibrated_temperature(np.zeros((0, 2)), np.zeros(0, int)) == 1.0


def test_quality_on_held_out_labels(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op9_quality"](spark, sf_dir).collect() if labels.get(r["doc_id"]) in (0, 1)]
    kept = [r for r in rows if r["held_out"]]
    assert sum(r["predicted"] == labels[r["doc_id"]] for r in kept) >= 0.97 * len(kept)
    one_class = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    statistics = frozen_statistics(spark.read.parquet(f"{SF_DIR}/documents.parquet"))
    assert fit_quality(statistics, one_class, F.lit(True)) is None
