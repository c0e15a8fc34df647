"""Rows that share an id, or have none: lines, language samples and vector search."""

from __future__ import annotations

import time

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tapmart import session
from tapmart.llm import components, ngram_join
from tapmart.llm.language_id import fit_languages, sampled
from tapmart.llm.line_dedup import drop_common_lines
from tapmart.llm.vector_search import top_k


def test_rows_of_one_id_are_one_document_for_its_lines(spark):
    rows = [(1, f"often here\nown {i}") for i in range(12)]
    rows += [(i, "nine ids\nsame") for i in range(2, 11)] + [(2, "nine ids again\nsame")]
    rows += [(None, f"no id\n{i}") for i in range(10)] + [(None, "one text, no id")] * 12
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    for parts in (1, 3):
        found = drop_common_lines(docs.repartition(parts)).collect()
        assert len(found) == len(rows)
        lost = {r["text"]: r["line_dropped"] for r in found}
        assert {n for t, n in lost.items() if t.startswith(("often", "nine", "one text"))} == {0}
        assert {n for t, n in lost.items() if t.startswith("no id")} == {1}
    tenth = docs.union(spark.createDataFrame([(20, "SAME ")], docs.schema))
    told = {r["text"]: r["line_kept_text"] for r in drop_common_lines(tenth).collect()}
    assert told["nine ids\nsame"] == "nine ids" and told["SAME "] == ""
    assert told["nine ids again\nsame"] == "nine ids again"


def test_the_language_sample_is_bounded_whatever_repeats(spark):
    rows = [(7, "the same row", "en")] * 500 + [(7, f"one id, text {i}", "en") for i in range(300)]
    rows += [(None, f"sans numéro {i}", "fr") for i in range(40)] + [(9, "seul", "de")]
    frame = spark.createDataFrame(rows, "id bigint, text string, lang string")
    for parts in (1, 5):
        sample, languages = sampled(frame.repartition(parts), 100)
        got = [(r["lang"], r["text"]) for r in sample.collect()]
        assert languages == ["de", "en", "fr"] and len(got) == len(set(got))
        assert [sum(lang == name for lang, _ in got) for name in languages] == [1, 100, 40]
        if parts == 1:
            before = sorted(got)
    assert sorted(got) == before


def test_rows_without_an_id_teach_their_language(spark):
    rows = [(None, f"ein kleines Haus steht dort {i}", "de") for i in range(60)]
    rows += [(3, f"the little house is over there {i}", "en") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    told = fit_languages(docs, F.lit(True)).predict(docs).collect()
    assert len(told) == 120 and all(r["lang_pred"] == r["lang"] for r in told)


def test_vectors_under_one_id_are_rows_of_their_own(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(60, 6)).astype(np.float32))]
    # Other vectors under ids 0 and 5; copies of rows 0 and 7 with their vectors.
    vectors += [(0, vectors[9][1]), (5, vectors[11][1]), (5, vectors[12][1])]
    vectors += [vectors[0], vectors[7], vectors[7], vectors[7]]
    table = np.floor(1024 * np.array([v for _, v in vectors], dtype=float)).astype(np.int64)
    ids = [i for i, _ in vectors]
    expected = []
    for q, query in enumerate(ids):
        if query in (0, 7):
            others = sorted((-int(table[q] @ table[c]), ids[c]) for c in range(len(ids)) if c != q)
            expected += [(query, n + 1, i, -s) for n, (s, i) in enumerate(others[:10])]
    for parts in (1, 3):
        frame = spark.createDataFrame(vectors, "vec_id bigint, embedding array<float>")
        found = top_k(frame.repartition(parts), F.col("id").isin(0, 7)).collect()
        got = [(r["query_id"], r["rank"], r["id"], r["score"]) for r in found]
        assert sorted(got) == sorted(expected)
    # Crowded under one id: more rows than a task's share, and equal ones.
    crowd = [(100, [1.0, 0.0])] * 3 + [(100, [float(i), 1.0]) for i in range(20)]
    found = top_k(spark.createDataFrame(crowd, "vec_id bigint, embedding array<float>"), F.lit(True), 2)
    assert found.count() == 2 * len(crowd)


def test_few_open_sets_are_found_without_moving_all_sets(spark, monkeypatch):
    """What is still open is small and of known size, so whole sets are not shuffled for it."""
    plans = []
    settle = ngram_join._rare_sharers

    def seen(sets, *rest):
        plans.append(sets._jdf.queryExecution().executedPlan().toString())
        return settle(sets, *rest)

    monkeypatch.setattr(ngram_join, "_rare_sharers", seen)
    words = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([*words, f"own{i}"][: 58 + i % 4])) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert {r["component_id"] for r in ngram_join.near_duplicates(docs).collect()} == {0}
    assert len(plans) == 1 and "BroadcastHashJoin" in plans[0] and "Exchange hash" not in plans[0]


def test_freezing_leaves_no_shuffle_files_and_the_settings_as_they_were(spark):
    before = {name: spark.conf.get(name, None) for name in session._FREEZING | session.SMALL_BATCHES}
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return disk.getAllFiles().mkString("|").count("/shuffle_")

    had, end = files(), time.time() + 20
    wide = spark.range(1000).select(F.col("id"), F.expr("repeat('x', 20000)").alias("text"))
    kept = session.freeze(wide.repartition(3, "id"), "test-freezing")
    while files() > had and time.time() < end:
        time.sleep(0.2)
    assert files() <= had and kept.count() == 1000

    def rows(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"rows": pa.array([batch.num_rows], pa.int64())})

    counted = wide.coalesce(1).mapInArrow(rows, "rows bigint")
    found = session.freeze(counted, "test-batches", settings=session.SMALL_BATCHES).collect()
    assert sum(r["rows"] for r in found) == 1000 and max(r["rows"] for r in found) < 500
    assert before == {name: spark.conf.get(name, None) for name in before}


def test_links_that_are_stars_take_no_round(spark, monkeypatch):
    written = []
    monkeypatch.setattr(
        components, "freeze", lambda df, name: (written.append(name), session.freeze(df, name))[1]
    )
    stars = [(i, i % 3) for i in range(3, 60)]
    links = session.freeze(spark.createDataFrame(stars, "a bigint, b bigint"), "test-stars")
    found = components.components(links, frozen=True).collect()
    assert sorted(map(tuple, found)) == [(i, i % 3) for i in range(60)] and not written
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a bigint, b bigint")
    found = components.components(chain.union(chain)).collect()
    assert sorted(map(tuple, found)) == [(i, 0) for i in range(41)]


def test_few_counts_of_cells_travel_alone():
    size = (1 << ngram_join.SKETCH_BITS) // ngram_join.SKETCH_PARTS
    few, many = np.zeros(size, dtype=np.int64), np.arange(size, dtype=np.int64)
    few[[3, size - 1]] = 70000, 1
    assert len(ngram_join._packed(few)) == 16 and len(ngram_join._packed(many)) == 4 * size
    total = np.zeros(size, dtype=np.int64)
    for counts in (few, many, few):
        ngram_join._add_packed(total, ngram_join._packed(counts))
    assert (total == 2 * few + many).all()


def test_a_task_gives_memory_back_after_its_last_batch(monkeypatch):
    given = []

    class Pool:
        def release_unused(self):
            given.append("back")

    monkeypatch.setattr(ngram_join.pa, "system_memory_pool", Pool)
    batches = [pa.RecordBatch.from_pydict({"node": pa.array([i])}) for i in range(3)]
    task = ngram_join._giving_back(lambda rows: iter(list(rows)))(iter(batches))
    assert [next(task) for _ in range(3)] == batches and not given
    assert list(task) == [] and given == ["back"]


def test_adding_up_what_shards_learned_leaves_no_shuffle_files(spark):
    from tapmart.llm import lm_scoring
    from tapmart.llm.context_mixing import GATES, INPUTS, Mixer

    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def files():
        return disk.getAllFiles().mkString("|").count("/shuffle_")

    mixers = [Mixer(GATES, INPUTS) for _ in range(3)]
    rows = []
    for mass, mixer in enumerate(mixers, 1):
        mixer.weights = mixer.weights + mass
        learned = lm_scoring._learned(mixer, float(mass)).to_pylist()[0]
        rows.append(tuple(learned[c] for c in ("weights", "refined", "mass")))
    given = spark.createDataFrame(rows, "weights binary, refined binary, mass double")
    had, end = files(), time.time() + 20
    made = lm_scoring._added_up(given.repartition(3), Mixer(GATES, INPUTS))
    while files() > had and time.time() < end:
        time.sleep(0.2)
    assert files() <= had
    expected = sum(m.weights * mass for mass, m in enumerate(mixers, 1)) / 6
    assert np.allclose(made.weights, expected)
    assert np.array_equal(made.refined, sum(m.refined for m in mixers))
