"""From raw documents to packed training sequences, in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and works on all that its predecessor kept. What it
returns is written as Parquet in the shared folder and read again by the next one. The first four
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapmart.llm.common import WORD, documents, held_out, whole
from tapmart.llm.language_id import UNDETERMINED, fit_languages
from tapmart.llm.line_dedup import drop_common_lines
from tapmart.llm.mixing import mix_sources
from tapmart.llm.ngram_join import one_of_each
from tapmart.llm.packing import pack_documents
from tapmart.session import freeze

# A document is rejected when its language can't be told from noise: it has no letter, or no
# language reaches half of the probability.
MIN_LANGUAGE_SCORE = 0.5
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

#: The stages work on models and similarities that SQL does not express; tests compare them with
#: brute force.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known; the others go."""
    model = fit_languages(docs, ~held_out(F.col("doc_id"), 4))
    names = docs.columns
    told = model.predict(docs)
    sure = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return told.where(sure).select(*names)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents without the lines that many documents share."""
    names = docs.columns
    kept = drop_common_lines(docs).withColumn("text", F.col("line_kept_text"))
    return kept.withColumn("n_chars", F.char_length("text").cast("bigint")).select(*names)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, that of the smallest id.

    Links follow texts: different texts under one id are told apart, rows without an id take part,
    and rows without words all stay.
    """
    return one_of_each(docs, width=5, percent=80).select(*docs.columns)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; such without words take no part.

    Every row is repeated by its own number of copies, rows without an id and rows under one id
    too.
    """
    names = docs.columns
    words = F.regexp_count(whole(F.col("text")), F.lit(WORD))
    mix = mix_sources(docs, words, keep=names).where("copies > 0 AND size > 0")
    repeated = F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))
    return mix.withColumn("_copy", repeated).select(*names)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in full sequences."""
    return pack_documents(docs, TOKENIZER)


STAGES = [
    ("language", language),
    ("lines", lines),
    ("near_copies", near_copies),
    ("mixture", mixture),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = freeze(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
