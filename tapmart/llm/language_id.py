"""Language identification: sparse multinomial logistic regression on character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapmart.llm.tokens import pieces
from tapmart.session import freeze

UNDETERMINED = "und"
BITS = 16
ORDERS = (1, 2, 3)
# Rows per language that weights and temperature are fitted on. Document frequencies are counted
# over all rows that may be learned from.
SAMPLE_PER_LANGUAGE = 1_500
SAMPLE_BUCKETS = 64
EPOCHS = 3
ALPHA, BETA, L1, L2 = 2.0, 1.0, 1e-4, 1e-4
SCALE = 20.0

_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], dtype=np.uint32)


def grams(texts: pa.Array, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per order: the hashed n-gram at every place of the texts, whether it lies in one text, and
    the place at which each text begins. An n-gram is made of lower-cased code points."""
    lowered = [(text or "").lower() for text in texts.to_pylist()]
    ends = np.cumsum([len(text) for text in lowered])
    starts = np.concatenate([[0], ends[:-1]])
    code = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    left = np.repeat(ends, ends - starts) - np.arange(len(code))
    for order in ORDERS:
        value = np.full(len(code), order * 0x165667B1 & 0xFFFFFFFF, dtype=np.uint32)
        for j in range(min(order, len(code))):
            value[: len(code) - j] += code[j:] * _FACTORS[j]
        value ^= value >> np.uint32(15)
        value *= np.uint32(0x2C1B3C6D)
        yield value >> np.uint32(32 - bits), left >= order, starts


def _counted(bits: int):
    """Document frequencies of one task, and its number of documents as feature -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(1 << bits, dtype=np.int64)
        documents = 0
        seen = np.zeros(1 << bits, dtype=np.int8)
        for batch in batches:
            documents += batch.num_rows
            for _, part in pieces(batch.column("text")):
                orders = list(grams(part, bits))
                starts = np.append(orders[0][2], len(orders[0][0]))
                for begin, stop in zip(starts[:-1], starts[1:]):
                    seen[:] = 0
                    for value, inside, _ in orders:
                        seen[value[begin:stop][inside[begin:stop]]] = 1
                    found += seen
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.append(used, -1).astype(np.int32)),
                pa.array(np.append(found[used], documents)),
            ],
            ["feature", "documents"],
        )

    return run


def _sparse(idf: np.ndarray, bits: int):
    """Labelled texts to sparse TF-IDF rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            langs = batch.column("lang").to_pylist()
            marks = batch.column("mark").to_pylist()
            for offset, part in pieces(batch.column("text")):
                orders = list(grams(part, bits))
                starts = np.append(orders[0][2], len(orders[0][0]))
                rows = []
                for row, (begin, stop) in enumerate(zip(starts[:-1], starts[1:])):
                    values = np.concatenate(
                        [v[begin:stop][inside[begin:stop]] for v, inside, _ in orders]
                    )
                    feature, count = np.unique(values, return_counts=True)
                    weight = count * idf[feature] * (SCALE / max(1, count.sum()))
                    rows.append(
                        (
                            langs[offset + row],
                            marks[offset + row],
                            feature.astype(np.int32).tobytes(),
                            weight.astype(np.float32).tobytes(),
                        )
                    )
                made = pd.DataFrame(rows, columns=["lang", "mark", "feature", "weight"])
                yield pa.RecordBatch.from_pandas(
                    made, schema=pa.schema([("lang", pa.string()), ("mark", pa.int64()),
                                            ("feature", pa.binary()), ("weight", pa.binary())]),
                    preserve_index=False,
                )

    return run


class FollowTheLeader:
    """Multinomial FTRL-proximal with elastic-net penalties, one example at a time.

    A weight stays 0 until what speaks for it exceeds the L1 penalty, so the model is sparse.
    """

    def __init__(self, size: int, classes: int):
        self.z = np.zeros((size, classes))
        self.n = np.zeros((size, classes))

    def weights(self, rows=slice(None)) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - L1, 0.0)
        return -shrunk / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, feature: np.ndarray, value: np.ndarray, label: int) -> None:
        w = self.weights(feature)
        p = softmax(value @ w)
        p[label] -= 1.0
        gradient = value[:, None] * p[None, :]
        squared = gradient * gradient
        n = self.n[feature]
        sigma = (np.sqrt(n + squared) - np.sqrt(n)) / ALPHA
        self.z[feature] += gradient - sigma * w
        self.n[feature] = n + squared


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def calibrated_temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The temperature under which held-back labels are likeliest, by golden section."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / np.exp(log_t))[np.arange(len(labels)), labels]
        return -np.log(np.maximum(p, 1e-12)).mean()

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5) - 1) / 2
    for _ in range(60):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _trained(languages: list[str], bits: int):
    """The bounded sample, in one task, to a weight row per language and the temperature."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["mark", "lang", "feature"], kind="stable")
        examples = [
            (np.frombuffer(f, np.int32), np.frombuffer(w, np.float32).astype(float),
             languages.index(lang), mark % 5 == 0)
            for lang, mark, f, w in rows[["lang", "mark", "feature", "weight"]].itertuples(index=False)
        ]
        model = FollowTheLeader(1 << bits, len(languages))
        for _ in range(EPOCHS):
            for feature, value, label, kept_back in examples:
                if not kept_back and len(feature):
                    model.learn(feature, value, label)
        weights = model.weights()
        kept = [e for e in examples if e[3] and len(e[0])]
        logits = np.array([value @ weights[feature] for feature, value, _, _ in kept])
        labels = np.array([label for _, _, label, _ in kept], dtype=int)
        temperature = calibrated_temperature(logits.reshape(len(kept), len(languages)), labels)
        return pd.DataFrame(
            {
                "language": np.arange(len(languages), dtype="int32"),
                "weights": [column.astype(np.float32).tobytes() for column in weights.T],
                "temperature": temperature,
            }
        )

    return run


@dataclass
class LanguageModel:
    """Weights per n-gram and language with the inverse document frequency multiplied in.

    Its size is fixed: ``2 ** bits`` rows for every language.
    """

    languages: list[str]
    table: np.ndarray
    temperature: float
    bits: int = BITS

    def predict(self, docs: DataFrame, text: str = "text") -> DataFrame:
        """``docs`` with ``lang_pred`` and ``score`` added, columns of those names replaced.

        A text that is null or has no letter is ``und`` with score 0. The score is the calibrated
        probability of the predicted language. All n-grams of the whole text count.
        """
        docs = docs.drop("lang_pred", "score")
        names = docs.columns
        at = names.index(text)
        schema = docs.withColumns(
            {"lang_pred": F.lit(None).cast("string"), "score": F.lit(None).cast("double")}
        ).schema
        lettered = docs.withColumn("_lettered", F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)))
        languages, table, temperature, bits = self.languages, self.table, self.temperature, self.bits

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                table_rows = []
                for _, part in pieces(batch.column(at)):
                    table_rows.append(logits_of(part, table, bits))
                if languages and table_rows:
                    p = softmax(np.concatenate(table_rows) / temperature)
                    best, score = p.argmax(axis=1), p.max(axis=1)
                else:
                    best, score = np.zeros(batch.num_rows, int), np.zeros(batch.num_rows)
                known = np.asarray(batch.column("_lettered").to_pylist(), dtype=bool) & bool(languages)
                named = [languages[b] if k else UNDETERMINED for b, k in zip(best, known)]
                columns = [batch.column(i) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(named, pa.string()), pa.array(np.where(known, score, 0.0))],
                    [*names, "lang_pred", "score"],
                )

        return lettered.mapInArrow(run, schema)


def logits_of(texts: pa.Array, table: np.ndarray, bits: int) -> np.ndarray:
    """One row of logits per text: the mean over all its n-grams of their weights."""
    total = np.zeros((len(texts), table.shape[1]))
    count = np.zeros(len(texts))
    for value, inside, starts in grams(texts, bits):
        full = np.append(starts[1:], len(value)) > starts
        if not full.any():
            continue
        weights = table[value]
        weights[~inside] = 0.0
        at = starts[full]
        total[full] += np.add.reduceat(weights, at, axis=0)
        count[full] += np.add.reduceat(inside.astype(np.int64), at)
    return total * (SCALE / np.maximum(count, 1))[:, None]


def sampled(rows: DataFrame, per_language: int) -> tuple[DataFrame, list[str]]:
    """``text, lang, mark`` of at most ``per_language`` different rows of each language, those of
    the smallest marks, and the languages.

    A mark is a hash of id and text. The largest mark of each language's sample is found from marks
    alone, per bucket of marks first, so that a language's task gets a bounded number of them
    however many rows it has. Texts of rows beyond it stay where they are.
    """
    marked = rows.withColumn("mark", F.xxhash64("id", "text"))
    bucket = Window.partitionBy("lang", F.pmod("mark", F.lit(SAMPLE_BUCKETS))).orderBy("mark")
    every = Window.partitionBy("lang").orderBy("mark")
    last = marked.select("lang", "mark").distinct()
    for window in (bucket, every):
        last = last.withColumn("at", F.row_number().over(window)).where(F.col("at") <= per_language)
    last = freeze(last.groupBy("lang").agg(F.max("mark").alias("last")), "language-sample")
    languages = sorted(r["lang"] for r in last.select("lang").collect())
    chosen = marked.join(last, "lang").where("mark <= last").dropDuplicates(["lang", "mark"])
    return chosen.select("text", "lang", F.pmod("mark", F.lit(1 << 40)).alias("mark")), languages


def fit_languages(
    docs: DataFrame,
    learn: Column,
    text: str = "text",
    label: str = "lang",
    id_column: str = "doc_id",
    sample_per_language: int = SAMPLE_PER_LANGUAGE,
    bits: int = BITS,
) -> LanguageModel:
    """Learn from the rows that satisfy ``learn`` and have a label.

    Document frequencies cover all of these rows; weights and temperature are fitted on at most
    ``sample_per_language`` rows of each language, chosen by a hash of id and text. A row that is
    repeated counts once in the sample; rows of different texts under one id, and rows without an
    id, are rows like others. A fifth of the sample is held back for the temperature. Without
    labelled rows the model knows no language.
    """
    rows = docs.where(learn & F.col(label).isNotNull() & F.col(text).isNotNull()).select(
        F.col(id_column).alias("id"), F.col(text).alias("text"), F.col(label).alias("lang")
    )
    counts = (
        rows.select("text")
        .mapInArrow(_counted(bits), "feature int, documents bigint")
        .groupBy("feature")
        .agg(F.sum("documents").alias("documents"))
        .toPandas()
    )
    frequency = np.zeros(1 << bits)
    seen = counts[counts["feature"] >= 0]
    frequency[seen["feature"].to_numpy()] = seen["documents"].to_numpy()
    number = int(counts.loc[counts["feature"] < 0, "documents"].sum())
    idf = np.log((1 + number) / (1 + frequency)) + 1

    sample, languages = sampled(rows, sample_per_language)
    model = (
        sample.mapInArrow(_sparse(idf, bits), "lang string, mark bigint, feature binary, weight binary")
        .groupBy(F.lit(1).alias("all"))
        .applyInPandas(
            _trained(languages, bits), "language int, weights binary, temperature double"
        )
        .toPandas()
        .sort_values("language")
    )
    if model.empty:
        return LanguageModel([], np.zeros((1 << bits, 0), np.float32), 1.0, bits)
    weights = np.stack([np.frombuffer(w, np.float32) for w in model["weights"]], axis=1)
    table = (weights * idf[:, None]).astype(np.float32)
    return LanguageModel(languages, table, float(model["temperature"].iloc[0]), bits)
