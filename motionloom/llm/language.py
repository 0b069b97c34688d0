"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lower-cased, every run of characters that are no letters becomes one blank, and n-grams of one to three
characters are hashed to 2**16 features.  Document frequencies come from every labelled document outside the held-out
fold.  Weights are fitted by follow-the-regularised-leader with elastic-net penalties, in one task over a bounded
sample (about ``FIT_DOCUMENTS`` in all, the same number from each language, those with the smallest hashes of the id); every fifth sampled
document is set aside to calibrate one temperature.  Scoring covers all documents, whole texts, in one map.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import small_batches, stored, text_groups

FEATURES = 1 << 16
FIT_DOCUMENTS = 12_000
CALIBRATION_SHARE = 5
EPOCHS = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.02, 0.1
FOLDS = 5
UNKNOWN = "und"
_FACTORS = np.random.Generator(np.random.PCG64(7)).integers(0, 1 << 32, (3, 3), dtype=np.uint32) | np.uint32(1)


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_counts(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Features and their counts, for each text; none for a text without letters."""
    lowered = [t.decode("utf-8", "replace").lower() + "\n" for t in texts]
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    keep = letter | np.concatenate([[True], letter[:-1]])  # of a run of others only the first
    ends = np.cumsum(keep)[np.cumsum([len(t) for t in lowered]) - 1] if lowered else []
    codes = np.where(letter, codes, np.uint32(32))[keep]
    grams = []
    for n in (1, 2, 3):
        value = np.zeros(max(len(codes) - n + 1, 0), np.uint32)
        for k in range(n):
            value += codes[k:len(codes) - n + 1 + k] * _FACTORS[n - 1, k]
        grams.append((value ^ (value >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> np.uint32(16))
    has = np.concatenate([[0], np.cumsum(codes != 32)])
    first = 0
    for last in ends:
        if has[last] == has[first]:
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
        else:
            counts = sum(np.bincount(grams[n - 1][first:last - n + 1], minlength=FEATURES) for n in (1, 2, 3) if last - first >= n)
            at = np.flatnonzero(counts)
            yield at, counts[at]
        first = last


@dataclass(frozen=True)
class Model:
    """Languages in order, inverse document frequencies, weights per feature and language, and the temperature."""

    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float

    def logits(self, at: np.ndarray, counts: np.ndarray) -> np.ndarray:
        tf = (1 + np.log(counts)) * self.idf[at]
        return tf @ self.weights[at] / max(np.sqrt(tf @ tf), 1e-12) + self.bias


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Ftrl:
    """Follow the regularised leader, per coordinate, for ``k`` classes."""

    def __init__(self, k: int):
        self.z, self.n = np.zeros((FEATURES, k)), np.zeros((FEATURES, k))
        self.bias_z, self.bias_n = np.zeros(k), np.zeros(k)

    @staticmethod
    def weights(z: np.ndarray, n: np.ndarray, l1: float = L1) -> np.ndarray:
        return -np.sign(z) * np.maximum(np.abs(z) - l1, 0) / ((BETA + np.sqrt(n)) / ALPHA + L2)

    def learn(self, at: np.ndarray, x: np.ndarray, label: int) -> None:
        z, n = self.z[at], self.n[at]
        w, b = self.weights(z, n), self.weights(self.bias_z, self.bias_n, 0.0)
        error = softmax(x @ w + b)
        error[label] -= 1
        for g, old_z, old_n, old_w, put in ((x[:, None] * error, z, n, w, at), (error, self.bias_z, self.bias_n, b, None)):
            new_n = old_n + g * g
            new_z = old_z + g - (np.sqrt(new_n) - np.sqrt(old_n)) / ALPHA * old_w
            if put is None:
                self.bias_z, self.bias_n = new_z, new_n
            else:
                self.z[put], self.n[put] = new_z, new_n


def calibrated(logits: np.ndarray, labels: np.ndarray) -> float:
    """Temperature with the smallest negative log-likelihood, by golden-section search over its logarithm.

    One imagined error keeps it away from zero where every document is predicted right.
    """
    if not len(labels):
        return 1.0

    def loss(t: float) -> float:
        p = np.maximum(softmax(logits / np.exp(t)), 1e-12)
        right = -np.log(p[np.arange(len(labels)), labels]).mean()
        return (1 - error) * right + error * -np.log(p).mean()

    error = 1 / (len(labels) + 2)
    low, high, part = -4.0, 3.0, (5 ** 0.5 - 1) / 2
    for _ in range(40):
        a, b = high - part * (high - low), low + part * (high - low)
        low, high = (low, b) if loss(a) < loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def fit(labels: list[str], features: list[tuple[np.ndarray, np.ndarray]], idf: np.ndarray) -> Model | None:
    """A model from the sampled documents, in the order given."""
    rows = [(language, at, counts) for language, (at, counts) in zip(labels, features, strict=True) if len(at)]
    languages = tuple(sorted({r[0] for r in rows}))
    if not languages:
        return None
    number = {language: i for i, language in enumerate(languages)}
    learned, aside = [r for i, r in enumerate(rows) if i % CALIBRATION_SHARE], [r for i, r in enumerate(rows) if not i % CALIBRATION_SHARE]
    state = Ftrl(len(languages))
    for _ in range(EPOCHS):
        for language, at, counts in learned or aside:
            tf = (1 + np.log(counts)) * idf[at]
            state.learn(at, tf / max(np.sqrt(tf @ tf), 1e-12), number[language])
    model = Model(languages, idf, state.weights(state.z, state.n), state.weights(state.bias_z, state.bias_n, 0.0), 1.0)
    logits = np.array([model.logits(at, counts) for _, at, counts in aside]).reshape(-1, len(languages))
    return Model(languages, idf, model.weights, model.bias, calibrated(logits, np.array([number[r[0]] for r in aside], int)))


def held_out(doc_id: str = "doc_id"):
    """Whether a document's id puts it into the fold that nothing is learned from; so is one without id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == 0, F.lit(True))


def _frequencies(learnable: DataFrame) -> tuple[np.ndarray, int]:
    """Documents with each feature, and documents in all; both have a fixed size."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, documents = np.zeros(FEATURES, np.int64), 0
        for _, texts in text_groups(batches):
            for at, _ in gram_counts(texts):
                total[at] += 1
                documents += len(at) > 0
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at], pa.int32()), pa.array([documents, *total[at]], pa.int64())], names=["feature", "n"])

    frequency, documents = np.zeros(FEATURES, np.int64), 0
    for feature, n in small_batches(learnable.select("text")).mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n")).collect():
        if feature < 0:
            documents = n
        else:
            frequency[feature] = n
    return frequency, documents


def train(docs: DataFrame, fit_documents: int = FIT_DOCUMENTS) -> Model | None:
    """A model from ``docs`` (doc_id, text, lang) outside the held-out fold; None if no document with letters has a language.

    A NULL language or text teaches nothing.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.col("lang").cast("string"))
    learnable = rows.filter(~held_out()).filter("lang is not null and text is not null").withColumn("place", F.xxhash64("doc_id"))
    frequency, documents = _frequencies(learnable)
    if not documents:
        return None
    idf = np.where(frequency > 0, np.log((1 + documents) / (1 + frequency)) + 1, 0.0)
    counts = learnable.groupBy(F.col("lang").alias("of")).count()  # a row for each language
    each = max(50, fit_documents // counts.count())
    # Hashes are spread evenly, so this share of their range holds about ``each`` documents of the language.
    limits = counts.select("of", (F.least(F.lit(1.0), each / F.col("count")) * 2.0**64 - 2.0**63).alias("most"))
    sample = (learnable.join(F.broadcast(limits), (F.col("lang") == F.col("of")) & (F.col("place").cast("double") <= F.col("most")))
              .select("place", "doc_id", "lang", "text"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_groups(batches):
            found = list(gram_counts(texts))
            yield pa.RecordBatch.from_arrays(
                [part.column("place"), part.column("doc_id"), part.column("lang"),
                 *(pa.array([x[k].astype(np.int32).tobytes() for x in found], pa.binary()) for k in (0, 1))], names=["place", "doc_id", "lang", "at", "counts"])

    def learn(table: pa.Table) -> pa.Table:
        table = table.sort_by([("place", "ascending"), ("doc_id", "ascending")])
        at, counts = ([np.frombuffer(x, np.int32) for x in table.column(c).to_pylist()] for c in ("at", "counts"))
        model = fit(table.column("lang").to_pylist(), list(zip(at, counts, strict=True)), idf)
        found = [model] if model else []
        return pa.table({"languages": pa.array([list(m.languages) for m in found], pa.list_(pa.string())),
                         "weights": pa.array([m.weights.tobytes() for m in found], pa.binary()),
                         "bias": pa.array([m.bias.tolist() for m in found], pa.list_(pa.float64())),
                         "temperature": pa.array([m.temperature for m in found], pa.float64())})

    features = stored(small_batches(sample).mapInArrow(extract, "place long, doc_id long, lang string, at binary, counts binary"), "features")
    learned = features.groupBy(F.lit("all").alias("sample")).applyInArrow(learn, "languages array<string>, weights binary, bias array<double>, temperature double").first()
    if learned is None:
        return None
    weights = np.frombuffer(learned.weights).reshape(FEATURES, -1)
    return Model(tuple(learned.languages), idf, weights, np.array(learned.bias), learned.temperature)


def predict(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with lang_pred and score, from the text alone.

    A text that is NULL or has no letters is ``und`` with score 0, as is every text if nothing could be learned.  Ties
    go to the language that sorts first.  Repeated rows and NULL ids are scored like any other; columns of these names are
    replaced, all others are kept.
    """
    spark, names = docs.sparkSession, [c for c in docs.columns if c not in ("lang_pred", "score")]
    shared = spark.sparkContext.broadcast(model)  # FEATURES times languages numbers
    docs = docs.select(*names)
    schema = docs.select("*", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for part, texts in text_groups(batches):
            said: list[tuple[str, float]] = []
            for at, counts in gram_counts(texts):
                if m is None or not len(at):
                    said.append((UNKNOWN, 0.0))
                else:
                    p = softmax(m.logits(at, counts) / m.temperature)
                    said.append((m.languages[int(p.argmax())], float(p.max())))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array([s[0] for s in said], pa.string()), pa.array([s[1] for s in said], pa.float64())],
                                             names=[*part.schema.names, "lang_pred", "score"])

    return small_batches(docs).mapInArrow(score, schema)
