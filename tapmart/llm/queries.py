"""Registered queries of the operators on documents, each next to its oracle in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapmart.llm.common import WORD, documents, held_out, whole
from tapmart.llm.exact_dedup import exact_dedup
from tapmart.llm.language_id import fit_languages
from tapmart.llm.line_dedup import drop_common_lines
from tapmart.llm.lm_scoring import score_documents
from tapmart.llm.mixing import mix_sources
from tapmart.llm.ngram_join import near_duplicates
from tapmart.llm.packing import pack_documents
from tapmart.llm.phrases import collocations
from tapmart.llm.quality import fit_quality, frozen_statistics, score_quality
from tapmart.llm.sharding import shard_by_bytes
from tapmart.llm.url_filter import filter_urls
from tapmart.llm.vector_search import top_k
from tapmart.llm.whitening import whiten

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(run):
        QUERIES[name] = run
        if sql:
            ORACLE_SQL[name] = sql
        return run

    return add


@query(
    "op1_line_dedup",
    r"""
    WITH lines AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
      FROM documents
    ), keyed AS (
      SELECT *, translate(
        trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
      FROM lines
    ), common AS (
      SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT doc_id) >= 10
    ), marked AS (
      SELECT keyed.*, common.k IS NOT NULL AS dropped FROM keyed LEFT JOIN common USING (k)
    )
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
      sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), ''))
        AS kept_sha256
    FROM marked GROUP BY doc_id
    """,
)
def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_common_lines(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id",
        F.col("line_count").alias("n_lines"),
        F.col("line_dropped").alias("n_dropped"),
        F.sha2(F.col("line_kept_text").cast("binary"), 256).alias("kept_sha256"),
    )


@query("op2_lm_scoring")
def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(documents(spark, sf_dir), held_out(F.col("doc_id"), 7))


@query(
    "op3_exact_dedup",
    r"""
    WITH plain AS (
      SELECT doc_id, length(coalesce(text, '')) AS chars, translate(coalesce(text, ''),
        ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS body
      FROM documents
    ), ranked AS (
      SELECT *, first_value(doc_id) OVER (PARTITION BY body ORDER BY chars DESC, doc_id) AS keep_id,
        count(*) OVER (PARTITION BY body) AS group_size
      FROM plain
    )
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
    FROM ranked
    """,
)
def exact_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir))


@query("op4_packing")
def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return pack_documents(documents(spark, sf_dir), path)


@query("op5_language_id")
def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    kept_back = held_out(F.col("doc_id"), 4)
    model = fit_languages(docs, ~kept_back)
    return model.predict(docs.select("doc_id", "text")).select(
        "doc_id", kept_back.alias("held_out"), "lang_pred", "score"
    )


@query("op6_ngram_jaccard")
def ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), width=3, percent=90)


@query("op7_sharding")
def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_bytes(documents(spark, sf_dir).select("doc_id", "text")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op8_source_mixing")
def source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.regexp_count(whole(F.col("text")), F.lit(WORD))
    return mix_sources(documents(spark, sf_dir), words).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("copies") * F.col("size")).alias("taken"),
    )


@query("op9_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    statistics = frozen_statistics(documents(spark, sf_dir))
    kept_back = held_out(F.col("id"), 4)
    model = fit_quality(statistics, labels, ~kept_back)
    return score_quality(statistics, model).select(
        F.col("id").alias("doc_id"), kept_back.alias("held_out"), "score", "predicted"
    )


@query(
    "op10_topk_search",
    """
    WITH ints AS (
      SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1024) AS BIGINT))
        AS v
      FROM embeddings
      WHERE embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), scored AS (
      SELECT q.vec_id AS query_id, c.vec_id,
        CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
      FROM ints q JOIN ints c ON q.vec_id <> c.vec_id
      WHERE q.vec_id % 100 = 0
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place
      FROM scored
    )
    SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM ranked WHERE place <= 10
    """,
)
def topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return top_k(vectors, F.col("id") % 100 == 0).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score"
    )


@query("op11_whitening")
def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    told = whiten(vectors).select("vec_id", "whitening.*")
    each = F.posexplode(F.arrays_zip("whitened", "explained")).alias("_at", "_value")
    return told.select(
        "vec_id",
        "n",
        F.col("deviation").try_cast("bigint").alias("deviation"),
        "identity_error",
        each,
    ).select(
        "vec_id",
        (F.col("_at") + 1).alias("component"),
        "n",
        "deviation",
        F.col("_value.whitened").alias("whitened"),
        F.col("_value.explained").alias("explained"),
        "identity_error",
    )


@query(
    "op12_collocations",
    r"""
    WITH pieces AS (
      SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(
        coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\x0A-\x0D]')) AS piece
      FROM documents
    ), worded AS (
      SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w
      FROM pieces
    ), placed AS (
      SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded
    ), counted AS (
      SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase, count(*) AS f
      FROM placed, (VALUES (1), (2), (3)) AS lengths(m)
      WHERE i + m - 1 <= len(w) GROUP BY ALL
    ), words AS (
      SELECT lang, sum(f) AS n FROM counted WHERE m = 1 GROUP BY lang
    ), candidates AS (
      SELECT *, string_split(phrase, ' ') AS w FROM counted WHERE m >= 2 AND f >= 10
    ), longer AS (
      SELECT lang, phrase, max(f) AS f FROM (
        SELECT lang, array_to_string(w[1:2], ' ') AS phrase, f FROM candidates WHERE m = 3
        UNION ALL
        SELECT lang, array_to_string(w[2:3], ' '), f FROM candidates WHERE m = 3)
      GROUP BY ALL
    ), kept AS (
      SELECT c.* FROM candidates c LEFT JOIN longer g ON c.m = 2 AND g.lang = c.lang
        AND g.phrase = c.phrase
      WHERE g.f IS NULL OR 100 * g.f < 50 * c.f
    ), cuts AS (
      SELECT lang, phrase, f AS a, w, m, unnest(range(1, m)) AS k FROM kept
    ), scored AS (
      SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r,
        CAST(CAST(a AS HUGEINT) * a * 1000000 // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
      FROM cuts
      JOIN counted x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.w[1:k], ' ')
      JOIN counted y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.w[k + 1 : cuts.m], ' ')
    ), lowest AS (
      SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS place FROM scored
    ), ranked AS (
      SELECT lang, row_number() OVER (PARTITION BY lang
        ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
      FROM lowest WHERE place = 1
    )
    SELECT lang, CAST(rank AS INTEGER) AS rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score
    FROM ranked JOIN words USING (lang) WHERE rank <= 2000
    """,
)
def phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(documents(spark, sf_dir))


URL_RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)


@query(
    "op13_url_filter",
    """
    WITH cut AS (
      SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3)
        ELSE '' END AS rest
      FROM pages
    ), parsed AS (
      SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
      FROM cut
    ), rules(verdict, rule_host, rule_path) AS (VALUES ('allow', 'com', '/'),
      ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
      ('block', 'net', '/es/'), ('block', 'net', '/fr/')
    ), fits AS (
      SELECT parsed.*, rule_host || rule_path AS rule, verdict, row_number() OVER (
        PARTITION BY page_id, host, path ORDER BY length(rule_host) + length(rule_path) DESC) AS place
      FROM parsed LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host))
        AND starts_with(path, rule_path)
    )
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
    """,
)
def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    rules = spark.createDataFrame(list(URL_RULES), "verdict string, host string, path string")
    return filter_urls(pages, rules).drop("url")
