"""Whitening, phrase collocations and the url filter, against plain versions of the same."""

import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tapmart.llm import phrases, url_filter, whitening

NAN, INF = float("nan"), float("inf")


# ------------------------------------------------------------------------------------- whitening
def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, whitening string")


def told(df):
    return [(r["vec_id"], r["whitening"]) for r in df.collect()]


def test_whitening_agrees_with_a_plain_eigenvalue_decomposition(spark):
    rng = np.random.default_rng(5)
    data = rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) * 0.3 + 40
    data = data.astype(np.float32)
    rows = [(i, row.tolist(), "taken") for i, row in enumerate(data)]
    rows += [(1000 + i, data[7].tolist(), None) for i in range(200)]  # a hot copy
    rows += [(None, data[3].tolist(), None), (2000, data[4].tolist(), None)]
    holes = [(3000, None, None), (3001, [1.0] * 11 + [None], None), (3002, [NAN] * 12, None),
             (3003, [INF] * 12, None), (3004, [], None)]
    found = told(whitening.whiten(vectors_of(spark, rows + holes).repartition(7)))
    assert len(found) == len(rows)
    x = np.floor(256 * data.astype(np.float64)).astype(np.int64)
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(axis=0)
    covariance = np.cov(distinct.T, bias=True)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    expected = (x - sums / n) @ vectors[:, :4] / np.sqrt(values[:4])
    by_id = {i: w for i, w in found if i is not None}
    signs = np.sign(np.array(by_id[0]["whitened"]) * expected[0])
    for i in range(300):
        assert np.allclose(by_id[i]["whitened"], expected[i] * signs, atol=1e-8)
        assert by_id[i]["n"] == n
        assert int(by_id[i]["deviation"]) == sum(
            (n * int(a) - int(s)) ** 2 for a, s in zip(x[i], sums)
        )
        assert np.allclose(by_id[i]["explained"], values[:4] / values.sum(), rtol=1e-9)
        assert by_id[i]["identity_error"] < 1e-9
    assert by_id[1005]["whitened"] == pytest.approx(by_id[7]["whitened"])


def test_whitening_does_not_depend_on_the_partitions(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=5).astype(np.float32).tolist(), None) for i in range(100)]
    kept = []
    for parts in (1, 6):
        found = told(whitening.whiten(vectors_of(spark, rows).repartition(parts, "vec_id")))
        kept.append({i: (w["explained"], w["deviation"]) for i, w in found})
    assert kept[0] == kept[1]


def test_whitening_of_degenerate_and_extreme_vectors(spark):
    (_, one), = told(whitening.whiten(vectors_of(spark, [(1, [2.0, 3.0], None)])))
    assert one["whitened"] == [None, None] and one["explained"] == [0.0, 0.0]
    assert one["n"] == 1 and one["deviation"] == 0 and one["identity_error"] is None
    # A line in the plane, and vectors of another length, which have a whitening of their own.
    rows = [(i, [float(i), 2.0 * i], None) for i in range(9)] + [(50, [1.0], None), (51, [3.0], None)]
    found = dict(told(whitening.whiten(vectors_of(spark, rows))))
    assert found[0]["whitened"][1] is None and found[0]["explained"] == pytest.approx([1.0, 0.0])
    assert found[50]["n"] == 2 and found[50]["whitened"] == [pytest.approx(-1.0)]
    # Far from zero, and beyond the range of a long.
    big = [(i, [1e12 + 65536.0 * (i % 3), 1e30 * (i % 2)], None) for i in range(12)]
    found = dict(told(whitening.whiten(vectors_of(spark, big))))
    assert all(math.isfinite(v) for v in found[1]["whitened"])
    assert found[0]["identity_error"] < 1e-9
    assert whitening.whiten(vectors_of(spark, [])).count() == 0


def test_decomposition_keeps_small_eigenvalues_of_graded_matrices():
    scale = np.diag([1e8, 1.0, 1e-3, 1e-6])
    base = np.array([[2, 1, 0, 1], [1, 3, 1, 0], [0, 1, 4, 1], [1, 0, 1, 5.0]])
    graded = scale @ base @ scale
    values, vectors = whitening.components_of(graded, 4)
    assert len(values) == 4 and np.all(values > 0)
    for k in range(4):
        rest = graded @ vectors[:, k] - values[k] * vectors[:, k]
        assert np.abs(rest).max() <= 1e-9 * values[0]
    # The determinant is the product of the eigenvalues; eigh loses the small ones here.
    assert np.prod(values) == pytest.approx(np.linalg.det(base) * np.prod(np.diag(scale)) ** 2)


def test_cholesky_stops_at_the_rank():
    rng = np.random.default_rng(3)
    half = rng.normal(size=(9, 4))
    order, factor = whitening.pivoted_cholesky(half @ half.T)
    assert factor.shape == (9, 4)
    assert np.allclose(factor @ factor.T, (half @ half.T)[order][:, order])


# ----------------------------------------------------------------------------------- collocations
def plain_collocations(rows, longest=3, enough=10, limit=2000):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = lang or "und"
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            n[lang] += len(words)
            for i in range(len(words)):
                for m in range(1, longest + 1):
                    if i + m <= len(words):
                        f[lang, tuple(words[i : i + m])] += 1
    found = {}
    candidates = {k: a for k, a in f.items() if len(k[1]) >= 2 and a >= enough}
    absorbed = {
        (lang, w[i : i + m])
        for (lang, w), b in candidates.items()
        for m in range(2, len(w))
        for i in range(len(w) - m + 1)
        if 100 * b >= 50 * f[lang, w[i : i + m]]
    }
    for (lang, w), a in candidates.items():
        if (lang, w) not in absorbed:
            score, k = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k)
                           for k in range(1, len(w)))
            row = (-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]])
            found.setdefault(lang, []).append(row)
    return {
        (lang, rank, p.decode(), -a, left, right, n[lang], -score)
        for lang, all_ in found.items()
        for rank, (score, a, p, left, right) in enumerate(sorted(all_)[:limit], 1)
    }


def documents_of(spark, rows):
    return spark.createDataFrame(
        [(t, lang, "x") for t, lang in rows], "text string, lang string, phrase string"
    )


def collected(df):
    names = ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    rows = [tuple(r) for r in df.select(*names).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def phrase_rows():
    draw = random.Random(9)
    words = ["The", "of", "new", "york", "times", "Été", "straße", "x" * 40, "ÀB", "don't", "日本", "a\u00a0b"]
    rows = []
    for i in range(160):
        text = "".join(
            draw.choice(words[: 4 + i % 9]) + draw.choice([" ", " ", "  ", "\t", ". ", ",", "\n", "\r"])
            for _ in range(draw.randrange(60))
        )
        rows.append((text, draw.choice(["en", "de", None, "und"])))
    rows += [("new york times", "en")] * 25 + [("again and again " * 30, "fr")]
    return rows + [(None, "en"), ("", None), (" .,; \t", "en"), ("alone", "it")]


def test_collocations_agree_with_brute_force(spark):
    rows = phrase_rows()
    docs = documents_of(spark, rows).repartition(5)
    expected = plain_collocations(rows)
    assert len(expected) > 60
    assert collected(phrases.collocations(docs)) == expected
    # Trees of a few leaves, so that prefixes are extended to one, two and three words.
    small = phrases.collocations(docs, group_leaves=12, prefix_leaves=3)
    assert collected(small) == expected
    assert collected(phrases.collocations(docs, limit=3)) == plain_collocations(rows, limit=3)
    longer = phrases.collocations(docs, max_words=5, prefix_leaves=4, group_leaves=16)
    assert collected(longer) == plain_collocations(rows, longest=5)


def test_collocations_do_not_depend_on_runs_maps_and_parts(spark, monkeypatch):
    rows = phrase_rows()
    docs = documents_of(spark, rows)
    expected = plain_collocations(rows)
    # Tasks import the module anew, so runs of another length are tried without Spark.
    monkeypatch.setattr(phrases, "_RUN_WORDS", 7)
    import pyarrow as pa

    pieces = phrases.Pieces(pa.array([t for t, _ in rows]))
    starts, seen = 0, []
    for count, codes, words, follows in pieces.runs(2):
        starts += count
        listed = words.to_pylist()
        seen += [listed[c] for c in codes[:count]]
        assert len(follows) == len(codes) <= 9
    assert starts == len(pieces.follows)
    joined = " ".join(t or "" for t, _ in rows)
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), joined)
    assert seen == [w for w in re.split("[ \t.,;:!?\n\x0b\x0c\r]+", lowered) if w]
    monkeypatch.undo()
    # Many parts of cells with few bits each: every pair is let through, the result is the same.
    monkeypatch.setattr(phrases, "_PART_BYTES", 64)
    monkeypatch.setattr(phrases, "_MAP_BITS", 3)
    assert collected(phrases.collocations(docs)) == expected


def test_exact_scores_beyond_64_bits(spark):
    counts = spark.createDataFrame(
        [("en", "a b", 2, 10**13), ("en", "a", 1, 10**13 + 3), ("en", "b", 1, 10**13 + 1)],
        "lang string, phrase string, words int, total bigint",
    )
    n = spark.createDataFrame([("en", 2 * 10**13 + 4)], "lang string, n bigint")
    original = phrases.count_phrases
    phrases.count_phrases = lambda *a: (counts, n)
    try:
        (row,) = phrases.collocations(spark.createDataFrame([], "text string, lang string")).collect()
    finally:
        phrases.count_phrases = original
    assert row["score"] == 10**6 * 10**26 // ((10**13 + 3) * (10**13 + 1))


def test_collocations_of_nothing(spark):
    assert phrases.collocations(documents_of(spark, [])).count() == 0
    assert phrases.collocations(documents_of(spark, [(None, None), ("", "en")])).count() == 0
    assert phrases.collocations(documents_of(spark, [("one two", "en")] * 9)).count() == 0


def test_a_very_long_text_and_a_very_long_word(spark):
    rows = [("to be or not " * 60_000, "en"), ("w" * 3_000_000 + " to be", "en")]
    found = {r["phrase"]: r["a"] for r in phrases.collocations(documents_of(spark, rows)).collect()}
    assert found["be or not"] == 60_000 and found["to be or"] == 60_000


# -------------------------------------------------------------------------------------- url filter
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "Net", "/f"),
    ("block", "a.b.example.com", ""),
    ("allow", "example.com", "/en/a/b"),
    ("block", "", "/private/"),
    ("allow", "tie.org", "/x"),
    ("block", "tie.org", "/x"),
]


def plain_verdict(url):
    host = path = ""
    if url is not None and "://" in url:
        rest = re.split(r"[?#]", url.split("://", 1)[1])[0]
        host, _, path = rest.partition("/")
        path = rest[len(host) :]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for verdict, of, start in RULES:
        of = of.lower()
        if (not of or host == of or host.endswith("." + of)) and path.startswith(start):
            key = (len(of) + len(start), len(of), verdict == "block")
            best = max(best, (key, of + start, verdict)) if best else (key, of + start, verdict)
    return (host, path, best[1], best[2]) if best else (host, path, None, "allow")


def urls():
    hosts = ["example.com", "WWW.Example.com", "m.www.example.com", "notexample.com", "example.com.",
             "x.net", "net", ".net", "a..net", "a.b.example.com", "z.a.b.example.com", "tie.org",
             "user@Example.com:80", "", "com", "ÉX.com"]
    paths = ["", "/", "/en", "/en/", "/en/a", "/en/a/bc/d", "/es/1", "/f", "/fr/x/y", "/EN/", "//en/",
             "/private/", "/private", "/x", "/xyz/1"]
    tails = ["", "?q=http://a.com/es/", "#top", "?"]
    built = [f"http://{h}{p}{t}" for h, p, t in itertools.product(hosts, paths, tails)]
    odd = [None, "", "no scheme", "example.com/en/", "://example.com/en/x", "a://b://example.com/en/",
           "http://example.com/en/\nx", "http:/example.com/en/", "http://x.net/es/" + "s/" * 50_000]
    return built + odd


def test_url_filter_agrees_with_brute_force_by_trie_and_by_join(spark):
    given = urls()
    pages = spark.createDataFrame(
        [(i, u, "h", "v", i) for i, u in enumerate(given)] + [(0, given[0], "h", "v", 0)],
        "page_id bigint, url string, host string, verdict string, `odd.name` int",
    )
    rules = spark.createDataFrame(
        RULES + RULES[:2] + [(None, "com", "/"), ("block", None, "")],
        "verdict string, host string, path string",
    )
    for limit in (url_filter.TRIE_BYTES, 0):
        found = url_filter.filter_urls(pages, rules, trie_bytes=limit)
        assert found.columns == ["page_id", "url", "odd.name", "host", "path", "rule", "verdict"]
        rows = found.collect()
        assert len(rows) == len(given) + 1
        for row in rows:
            told = (row["host"], row["path"], row["rule"], row["verdict"])
            assert told == plain_verdict(given[row["page_id"]]), row["url"]


def test_url_filter_of_nothing_and_with_no_rules(spark):
    none = spark.createDataFrame([], "verdict string, host string, path string")
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id bigint, url string")
    (row,) = url_filter.filter_urls(pages, none, default="block").collect()
    assert (row["rule"], row["verdict"]) == (None, "block")
    rules = spark.createDataFrame(RULES, none.schema)
    assert url_filter.filter_urls(pages.where("page_id < 0"), rules).count() == 0


def test_registered_queries_have_the_columns_of_their_contracts(spark):
    from tapmart.llm.queries import QUERIES

    frame = QUERIES["op11_whitening"](spark, "/root/testdata/sf0.001")
    rows = frame.select(F.count("*"), F.countDistinct("vec_id"), F.max("component")).first()
    assert rows[0] == 4 * rows[1] and rows[2] == 4
    assert dict(frame.dtypes)["deviation"] == "bigint" and dict(frame.dtypes)["component"] == "int"
    expected = {"page_id", "host", "path", "rule", "verdict"}
    assert set(QUERIES["op13_url_filter"](spark, "/root/testdata/sf0.001").columns) == expected


def test_cells_are_sent_before_many_are_held():
    words = np.random.default_rng(7).integers(0, 50_000, 3_000_000)
    texts = [" ".join(map(str, part)) for part in np.array_split(words, 300)]
    batch = pa.RecordBatch.from_pydict({"lang": ["xx"] * 300, "text": texts})
    sent = list(phrases._cell_counts(8, 10)(iter([batch])))
    held = [sum(len(b) for b in s.column("counts").to_pylist()) for s in sent]
    assert max(held) < 1_500_000
    total = sum(np.frombuffer(b, np.uint8).sum() for s in sent for b in s.column("counts").to_pylist())
    assert total == 3_000_000 - 300
