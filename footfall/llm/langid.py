"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

N-grams of 1 to 3 bytes inside words (with a mark at either end) are hashed into a fixed number
of features. The weights are trained with follow-the-regularised-leader (FTRL-Proximal) under an
elastic-net penalty, which leaves most of them at zero, and one temperature is fitted afterwards
on labelled texts that the training did not see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from footfall.llm.common import quoted

#: Features are hashes of n-grams of these lengths, in bytes of UTF-8.
SIZES = (1, 2, 3)
BUCKETS = 1 << 14
#: At most so many labelled texts are learned from, dealt evenly over the languages.
MAX_TRAINING_ROWS = 4000
#: A part of them, one in so many, is set aside for the temperature.
CALIBRATION = 5
#: FTRL-Proximal: step size, its smoothing, and the two penalties.
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
EPOCHS = 3
UNKNOWN = "und"
#: Bytes of a text that are hashed at a time.
SLICE_BYTES = 1 << 20

_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)
# ASCII signs, digits and blanks end words and count as one mark; A-Z is read as a-z.
_CODE = np.arange(256, dtype=np.uint32)
_CODE[:128] = 32
_CODE[97:123] = np.arange(97, 123)
_CODE[65:91] = np.arange(97, 123)


def counts(text: str) -> np.ndarray:
    """How often each feature occurs in the whole text."""
    data = text.encode("utf-8", "replace")
    total = np.zeros(BUCKETS, dtype=np.int64)
    for start in range(0, max(len(data), 1), SLICE_BYTES):
        # Each piece begins with what the last one's n-grams may reach into.
        lead = min(start, SIZES[-1] - 1)
        piece = np.frombuffer(data, np.uint8)[start - lead : start + SLICE_BYTES]
        code = _CODE[piece]
        if start == 0:
            code = np.concatenate([np.array([32], np.uint32), code])
            lead = 0
        if start + SLICE_BYTES >= len(data):
            code = np.concatenate([code, np.array([32], np.uint32)])
        for size in SIZES:
            value = np.zeros(max(0, len(code) - size + 1), dtype=np.uint32)
            for i in range(size):
                value += (code[i : i + len(value)] + np.uint32(size)) * _FACTORS[i]
            value ^= value >> np.uint32(15)
            value *= np.uint32(0x2C1B3C6D)
            value ^= value >> np.uint32(12)
            skip = max(0, lead - size + 1)
            total += np.bincount(value[skip:] & np.uint32(BUCKETS - 1), minlength=BUCKETS)
    return total


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


@dataclass
class Model:
    """What a prediction needs: languages, inverse document frequencies, weights, temperature."""

    languages: list[str]
    idf: np.ndarray  # BUCKETS
    weights: np.ndarray  # BUCKETS + 1 for the bias, by language
    temperature: float

    def vector(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Features present and their TF-IDF, of length one; the last feature is the bias."""
        return tf_idf(counts(text), self.idf)

    def predict(self, text: str | None) -> tuple[str, float]:
        if not text or not has_letter(text) or not self.languages:
            return UNKNOWN, 0.0
        at, value = self.vector(text)
        chance = softmax((value @ self.weights[at]) / self.temperature)
        best = int(chance.argmax())
        return self.languages[best], float(chance[best])


def tf_idf(count: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.flatnonzero(count)
    value = (1 + np.log(count[at])) * idf[at]
    norm = np.sqrt(value @ value)
    return np.append(at, len(idf)), np.append(value / norm if norm else value, 1.0)


def softmax(scores: np.ndarray) -> np.ndarray:
    high = np.exp(scores - scores.max(axis=-1, keepdims=True))
    return high / high.sum(axis=-1, keepdims=True)


def ftrl(
    rows: list[tuple[np.ndarray, np.ndarray]],
    labels: np.ndarray,
    classes: int,
    epochs: int = EPOCHS,
) -> np.ndarray:
    """Weights by FTRL-Proximal with one learning rate per weight, in the order of ``rows``.

    A weight is zero until its summed gradients exceed the L1 penalty; beyond it, L2 and the
    weight's own rate shrink it. The bias is not penalised by L1.
    """
    z = np.zeros((BUCKETS + 1, classes))
    n = np.zeros_like(z)

    def weights(at):
        part = z[at]
        penalty = np.where(at < BUCKETS, L1, 0.0)[:, None]
        over = np.sign(part) * np.maximum(np.abs(part) - penalty, 0.0)
        return -over / ((BETA + np.sqrt(n[at])) / ALPHA + L2)

    for _ in range(epochs):
        for (at, value), label in zip(rows, labels, strict=True):
            w = weights(at)
            error = softmax(value @ w)
            error[label] -= 1.0
            gradient = value[:, None] * error[None, :]
            squared = gradient * gradient
            rate = (np.sqrt(n[at] + squared) - np.sqrt(n[at])) / ALPHA
            z[at] += gradient - rate * w
            n[at] += squared
    return weights(np.arange(BUCKETS + 1))


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature in 0.05..20 with the smallest log loss (golden section on its logarithm)."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        chance = softmax(scores / np.exp(log_t))
        return -float(np.log(np.maximum(chance[np.arange(len(labels)), labels], 1e-300)).sum())

    low, high, ratio = np.log(0.05), np.log(20.0), (np.sqrt(5.0) - 1) / 2
    for _ in range(60):
        left, right = high - ratio * (high - low), low + ratio * (high - low)
        if loss(left) <= loss(right):
            high = right
        else:
            low = left
    return float(np.exp((low + high) / 2))


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """In how many of ``texts`` (text) each feature occurs, and their number; over all rows.

    Each task adds up its own rows, so ``BUCKETS`` numbers per task are shuffled and ``BUCKETS``
    numbers reach the driver, however many texts there are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS + 1, dtype=np.int64)
        for batch in batches:
            for text in batch.column(0):
                total[:BUCKETS] += counts(text.as_py() or "") > 0
                total[BUCKETS] += 1
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at, pa.int32()), pa.array(total[at])], names=["feature", "n"]
        )

    counted = texts.mapInArrow(run, "feature int, n long")
    summed = counted.groupBy("feature").agg(F.sum("n").alias("n"))
    found = np.zeros(BUCKETS + 1, dtype=np.int64)
    for row in summed.toLocalIterator():
        found[row.feature] = row.n
    return found[:BUCKETS], int(found[BUCKETS])


def train(
    labelled: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    max_rows: int = MAX_TRAINING_ROWS,
) -> Model:
    """A model of the languages in ``labelled``; rows without text or language teach nothing.

    Document frequencies come from all rows. The weights are fitted on at most about
    ``max_rows`` texts, evenly over the languages: those whose hash of id and text is lowest.
    Training needs their sparse counts on the driver, which this number bounds. Without any
    labelled row the model knows no language, and every text is ``und``.
    """
    rows = labelled.select(
        F.col(quoted(text_col)).alias("text"),
        F.col(quoted(lang_col)).cast("string").alias("lang"),
        F.xxhash64(F.col(quoted(id_col)), F.length(quoted(text_col))).alias("hash"),
    ).filter("text IS NOT NULL AND lang IS NOT NULL")
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros(BUCKETS), np.zeros((BUCKETS + 1, 0)), 1.0)
    frequency, total = document_frequencies(rows.select("text"))
    idf = np.log((1 + total) / (1 + frequency)) + 1
    # A language is thinned by the hash, so that about its share of max_rows is left.
    share = max(1, max_rows // len(languages))
    part = F.pmod("hash", F.lit(1_000_003)) / F.lit(1_000_003.0)
    limits = F.create_map(
        *[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, share / n)))]
    )
    sample = rows.filter(part < limits[F.col("lang")]).select("hash", "lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                count = counts(batch.column(2)[i].as_py())
                at = np.flatnonzero(count)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(i, 1),
                        batch.column(1).slice(i, 1),
                        pa.array([at.astype(np.int32)]),
                        pa.array([count[at].astype(np.int32)]),
                    ],
                    names=["hash", "lang", "at", "n"],
                )

    taken = sample.mapInArrow(run, "hash long, lang string, at array<int>, n array<int>")
    # As Arrow columns: numbers of 4 bytes, not Python objects.
    found = taken.toArrow().combine_chunks()
    hashes = found.column("hash").to_numpy()
    langs = found.column("lang").to_pylist()
    ends = np.cumsum([0, *found.column("at").combine_chunks().value_lengths().to_pylist()])
    at, n = (found.column(c).combine_chunks().flatten().to_numpy() for c in ("at", "n"))
    number = {k: i for i, k in enumerate(languages)}
    vectors, labels = [], []
    # In an order that does not depend on how the rows were read.
    for i in sorted(range(len(langs)), key=lambda i: (hashes[i], langs[i], ends[i + 1] - ends[i])):
        count = np.zeros(BUCKETS, dtype=np.int64)
        count[at[ends[i] : ends[i + 1]]] = n[ends[i] : ends[i + 1]]
        vectors.append(tf_idf(count, idf))
        labels.append(number[langs[i]])
    labels = np.array(labels, dtype=np.int64)
    held = np.arange(len(labels)) % CALIBRATION == CALIBRATION - 1
    weights = ftrl(
        [v for v, h in zip(vectors, held, strict=True) if not h], labels[~held], len(languages)
    )
    scores = [v @ weights[at] for (at, v), h in zip(vectors, held, strict=True) if h]
    temperature = fit_temperature(np.array(scores), labels[held])
    return Model(languages, idf, weights, temperature)


def predict(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    pred_col: str = "lang_pred",
    score_col: str = "lang_score",
) -> DataFrame:
    """``docs`` with ``pred_col`` and ``score_col``, from the whole text alone.

    A text that is null or has no letter is ``und`` with score 0. The score is the calibrated
    probability of the language. Own columns of these names are replaced.
    """
    added = (pred_col.lower(), score_col.lower())
    docs = docs.drop(*[c for c in docs.columns if c.lower() in added])
    at = docs.columns.index(text_col)
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField(pred_col, T.StringType(), False),
            T.StructField(score_col, T.DoubleType(), False),
        ]
    )
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS numbers per language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            found = [known.predict(text.as_py()) for text in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                ],
                names=[*batch.schema.names, pred_col, score_col],
            )

    return docs.mapInArrow(run, schema)


def held_out(id_col: Column | str = "doc_id") -> Column:
    """One id in three, by CRC-32 of the id as text; false where the id is null."""
    column = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(column.cast("string")) % 3 == 1, F.lit(False))
