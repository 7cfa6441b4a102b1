"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesflow.llm.sampling import drawn

#: Hash buckets, as a power of two, and the lengths of the n-grams.
BITS, ORDERS = 16, (2, 3)
#: Documents of each language that the model is fitted on, about, and documents counted by one task.
MOST_DOCUMENTS, COUNTED = 5000, 2000
#: Languages whose counts a counting task holds at once, and numbers that scoring holds at once (at least one text's).
HELD, AT_ONCE = 64, 1 << 19
#: Characters scored at once; a longer text is scored in parts.
PART = 1 << 20
UNDETERMINED = "und"

# odd multipliers of the n-gram hash, one per place
_MULTIPLIERS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], dtype=np.uint32)
_LETTERS = np.array([c if chr(c).isalpha() else 32 for c in range(0x300)], dtype=np.uint32)


def ngrams(text: str, orders: tuple[int, ...], bits: int) -> Iterator[np.ndarray]:
    """Bucket numbers of all n-grams of the lower-cased text, part by part; what is no letter is a blank."""
    longest = max(orders)
    for at in range(0, len(text), PART):
        part = text[at : at + PART].lower().encode("utf-32-le", "surrogatepass")
        codes = np.frombuffer(part, dtype=np.uint32)
        codes = np.where(codes < 0x300, _LETTERS[np.minimum(codes, 0x2FF)], codes)
        codes = np.concatenate([[32], codes, [32]]).astype(np.uint32)
        for order in orders[: longest]:
            if len(codes) < order:
                continue
            mixed = np.full(len(codes) - order + 1, order, dtype=np.uint32)
            for place in range(order):
                mixed += codes[place : len(codes) - order + 1 + place] * _MULTIPLIERS[place]
                mixed ^= mixed >> 15
            mixed *= _MULTIPLIERS[-1]
            yield (mixed >> np.uint32(32 - bits)).astype(np.int64)


def counted(text: str, orders: tuple[int, ...], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that the n-grams of a text fall in, and how many fall in each."""
    counts = np.zeros(1 << bits, dtype=np.int64)
    for buckets in ngrams(text, orders, bits):
        counts += np.bincount(buckets, minlength=1 << bits)
    found = np.flatnonzero(counts)
    return found, counts[found]


@dataclass(frozen=True)
class LanguageModel:
    """Log probabilities: one row per bucket, one column per language."""

    languages: list[str]
    prior: np.ndarray
    matrix: np.ndarray
    orders: tuple[int, ...]
    bits: int

    def scores(self, texts: list[str]) -> np.ndarray:
        """Log scores of ``texts`` in every language: their sparse counts times the matrix, a few texts at a time."""
        total = np.tile(self.prior, (len(texts), 1))
        first, held, size = 0, [], 0
        for i, text in enumerate(texts):
            held.append(counted(text, self.orders, self.bits))
            size += len(held[-1][0])
            if i + 1 == len(texts) or size * len(self.languages) >= AT_ONCE:
                self._add(total[first : i + 1], held)
                first, held, size = i + 1, [], 0
        return total

    def _add(self, total: np.ndarray, held: list[tuple[np.ndarray, np.ndarray]]) -> None:
        sizes = np.array([len(buckets) for buckets, _ in held])
        filled = np.flatnonzero(sizes)
        if len(filled):
            entries = self.matrix[np.concatenate([b for b, _ in held])] * np.concatenate([n for _, n in held])[:, None]
            total[filled] += np.add.reduceat(entries, np.cumsum(sizes[filled]) - sizes[filled], axis=0)

    def predict(self, texts: list[str]) -> list[tuple[str, float]]:
        """The likeliest language of each text and its posterior; ties go to the first in alphabetical order."""
        if not self.languages:
            return [(UNDETERMINED, 0.0)] * len(texts)
        total = self.scores(texts)
        best = total.argmax(axis=1)
        chance = 1 / np.exp(total - total[np.arange(len(texts)), best][:, None]).sum(axis=1)
        return [(self.languages[i], float(p)) for i, p in zip(best, chance)]


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(
    labelled: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    language: str = "lang",
    orders: tuple[int, ...] = ORDERS,
    bits: int = BITS,
    most_documents: int = MOST_DOCUMENTS,
) -> LanguageModel:
    """Fit on about ``most_documents`` documents of each language, among the rows that have a language and a letter.

    Every language is learned, however rare. Priors are counted over all
    distinct documents (key and text), so a document that is repeated counts
    once. The n-grams of the sample are counted in tasks and summed by Spark;
    the driver gets at most 2**``bits`` sums a language.
    """
    rows = labelled.where(F.col(language).isNotNull() & has_letter(F.col(text))).select(
        F.col(language).cast("string").alias("lang"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias("doc_id"), F.col(text).alias("text")
    )
    told = rows.select("lang", "doc_id", F.xxhash64("text").alias("body")).distinct().groupBy("lang").count().orderBy("lang").collect()
    documents = {r["lang"]: r["count"] for r in told}
    names = list(documents)
    if not names:
        return LanguageModel([], np.zeros(0), np.zeros((1 << bits, 0), dtype=np.float32), orders, bits)
    place = {name: i for i, name in enumerate(names)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def rows_of(lang: int) -> pa.RecordBatch:
            bucket = np.flatnonzero(held[lang])
            columns = [pa.array(np.full(len(bucket), lang), pa.int32()), pa.array(bucket, pa.int32()), pa.array(held[lang][bucket], pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])

        for batch in batches:
            for lang, body in zip(batch.column(0).to_pylist(), batch.column(1)):
                if place[lang] not in held and len(held) == HELD:
                    yield from map(rows_of, held)
                    held.clear()
                own = held.setdefault(place[lang], np.zeros(1 << bits, dtype=np.int64))
                buckets, n = counted(body.as_py(), orders, bits)
                own[buckets] += n
        yield from map(rows_of, held)

    sample = drawn(rows, documents, "lang", "doc_id", "text", most_documents)
    tasks = -(-sum(min(n, most_documents) for n in documents.values()) // COUNTED)
    sums = (
        sample.select("lang", "text")
        .repartition(tasks)
        .mapInArrow(count, "lang int, bucket int, n long")
        .groupBy("lang", "bucket")
        .agg(F.sum("n").alias("n"))
        .toPandas()
    )
    table = np.ones((1 << bits, len(names)), dtype=np.float32)  # add-one smoothing
    table[sums["bucket"], sums["lang"]] += sums["n"].to_numpy(dtype=np.float32)
    total = table.sum(axis=0, dtype=np.float64)
    prior = np.array([math.log(n / sum(documents.values())) for n in documents.values()])
    return LanguageModel(names, prior, (np.log(table) - np.log(total)).astype(np.float32), orders, bits)


def with_language(df: DataFrame, model: LanguageModel, text: str = "text", into: str = "lang_pred", score: str = "score") -> DataFrame:
    """``df`` with the predicted language and its posterior, scored from the whole text alone.

    A missing text, or one without a letter, is ``und`` with score 0; so is
    every text if the model has no language. The model is broadcast: its size
    is fixed by buckets and languages. Very long texts are read in parts; what
    is held beside a text are its counts, one number a bucket. Columns called
    like the results are replaced, all others kept; no shuffle.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def predict(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = shared.value
        for part in parts:
            told = iter(known.predict([t for t in part if t is not None]))
            found = [(UNDETERMINED, 0.0) if t is None else next(told) for t in part]
            yield pd.DataFrame(found, columns=["lang", "score"])

    guess = F.pandas_udf(predict, "lang string, score double")
    held = "_guess"
    while held in df.columns:
        held += "_"
    return (
        df.withColumn(held, guess(F.when(has_letter(F.col(text)), F.col(text))))
        .withColumns({into: F.col(f"{held}.lang"), score: F.col(f"{held}.score")})
        .drop(held)
    )
