"""Language identification: multinomial logistic regression on TF-IDF character n-grams.

N-grams of one to three characters of the lower-cased text are hashed into ``BUCKETS``
features. A feature's weight in a document is (1 + log count) * idf, scaled to length one.
Document frequencies cover every row that may be learned from. Weights are learned by
follow-the-regularised-leader with an elastic net, whose first part keeps them sparse, on
a bounded sample of rows; a part of the sample sets the temperature that turns scores into
probabilities.
"""

from __future__ import annotations

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemirror.llm.texts import mix, slices, with_fields

cloudpickle.register_pickle_by_value(sys.modules[__name__])

UNKNOWN = "und"


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the rows that weights are learned from, over all languages together, and ``languages``
    the labels that are learned: those of most rows, since the model has as many weights per bucket."""

    buckets: int = 1 << 14
    orders: int = 3
    sample: int = 6000
    languages: int = 256
    calibration: int = 5
    epochs: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.02
    l2: float = 0.01
    seed: int = 3


@dataclass
class Model:
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float
    settings: Settings


def counts(text: str, settings: Settings) -> np.ndarray:
    """How often each bucket's n-grams occur in a text."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    total = np.zeros(settings.buckets, np.int64)
    shift = np.uint64(64 - (settings.buckets.bit_length() - 1))
    factor = np.uint64(0x9E3779B97F4A7C15)
    grams = points
    for order in range(1, settings.orders + 1):
        if len(points) < order:
            break
        if order > 1:
            grams = grams[:-1] * np.uint64(0x100000001B3) + points[order - 1 :]
        total += np.bincount(((grams + np.uint64(order)) * factor >> shift).astype(np.int64), minlength=settings.buckets)
    return total


def features(text: str, idf: np.ndarray, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features, of length one."""
    total = counts(text, settings)
    at = np.flatnonzero(total)
    values = (1 + np.log(total[at])) * idf[at]
    length = math.sqrt(float(values @ values))
    return at, values / length if length else values


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, s: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Weights and bias by FTRL-proximal, one row at a time, a class a column; the bias is not penalised."""
    z, n = np.zeros((s.buckets + 1, classes)), np.zeros((s.buckets + 1, classes))

    def solved(zi: np.ndarray, ni: np.ndarray) -> np.ndarray:
        l1, l2 = np.full((len(zi), 1), s.l1), np.full((len(zi), 1), s.l2)
        l1[-1] = l2[-1] = 0
        return -np.sign(zi) * np.maximum(np.abs(zi) - l1, 0) / ((s.beta + np.sqrt(ni)) / s.alpha + l2)

    order = np.random.default_rng(s.seed)
    for _ in range(s.epochs):
        for i in order.permutation(len(rows)):
            at, x = rows[i]
            at, x = np.append(at.astype(np.int64), s.buckets), np.append(x.astype(float), 1.0)
            zi, ni = z[at], n[at]
            w = solved(zi, ni)
            p = softmax(x @ w)
            p[labels[i]] -= 1
            g = x[:, None] * p
            step = (np.sqrt(ni + g * g) - np.sqrt(ni)) / s.alpha
            z[at], n[at] = zi + g - step * w, ni + g * g
    w = solved(z, n)
    return w[:-1], w[-1]


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, by golden section over its logarithm."""
    if not len(labels):
        return 1.0

    def loss(log_t: float) -> float:
        p = softmax(logits / math.exp(log_t))[np.arange(len(labels)), labels]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high, ratio = math.log(0.02), math.log(20), (math.sqrt(5) - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return math.exp((low + high) / 2)


def document_frequencies(texts: DataFrame, s: Settings) -> tuple[np.ndarray, int]:
    """How many texts hold each bucket, and how many texts there are; every task sends ``buckets`` numbers."""

    def run(batches):
        found, n = np.zeros(s.buckets, np.int64), 0
        for batch in slices(batches, "text"):
            for text in batch.column("text").to_pylist():
                found += counts(text, s) > 0
                n += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(-1, s.buckets), pa.int32()), pa.array(np.concatenate([[n], found]), pa.int64())], ["bucket", "n"]
        )

    rows = texts.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).where("n > 0").collect()
    out, n = np.zeros(s.buckets), 0
    for bucket, count in rows:
        if bucket < 0:
            n = count
        else:
            out[bucket] = count
    return out, n


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", key: Column | str = "doc_id", settings: Settings | None = None) -> Model:
    """Learn from all rows that have a text with a letter and a language.

    ``key`` and the text order the sample by hash; each language gives as many rows as fit
    into ``settings.sample``. Rows that repeat language, key and text are learned from once.
    Labels beyond the ``settings.languages`` most frequent ones are not learned.
    Without such rows the model knows no language.
    """
    s = settings or Settings()
    key = F.col(key) if isinstance(key, str) else key
    usable = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"), key.alias("key"))
    usable = usable.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("text").rlike(r"\p{L}"))
    sizes = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).groupBy(F.col(lang).cast("string").alias("lang")).agg(F.count("*").alias("n"))
    # At most ``languages`` rows, however many labels a dirty column has.
    learned = sizes.orderBy(F.desc("n"), "lang").limit(s.languages).collect()
    df, n = document_frequencies(usable, s)
    idf = np.log((1 + n) / (1 + df)) + 1
    each = max(s.sample // max(len(learned), 1), 1)
    # A hash picks about twice the rows wanted before they are ordered, so no large group is sorted.
    shares = docs.sparkSession.createDataFrame([(r["lang"], min(1.0, 2 * each / r["n"])) for r in learned], "lang STRING, share DOUBLE")
    place = F.pmod(F.xxhash64("key", "text", F.lit(s.seed)), F.lit(1 << 40)) / float(1 << 40)
    placed = usable.withColumn("place", place).join(F.broadcast(shares), "lang")
    # Equal rows share a place, so they are combined before the sort.
    picked = placed.where("place < share").select("lang", "place", "text").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("place", "text"))
    sample = picked.withColumn("rank", rank).where(F.col("rank") <= each).drop("rank")

    def run(batches):
        for batch in slices(batches, "text"):
            got = [features(t, idf, s) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), batch.column("place"), pa.array([a.astype("<u2").tobytes() for a, _ in got], pa.binary()),
                 pa.array([v.astype("<f4").tobytes() for _, v in got], pa.binary())],
                ["lang", "place", "at", "value"],
            )

    found = sample.mapInArrow(run, with_fields(sample.select("lang", "place").schema, at="binary", value="binary"))
    # A partition at a time, and as packed as it came: the bounded sample is all the driver holds.
    rows = sorted((r["place"], r["lang"], bytes(r["at"]), bytes(r["value"])) for r in found.toLocalIterator())
    languages = sorted({lang for _, lang, _, _ in rows})
    index = {k: i for i, k in enumerate(languages)}
    x = [(np.frombuffer(at, "<u2"), np.frombuffer(value, "<f4")) for _, _, at, value in rows]
    y = np.array([index[lang] for _, lang, _, _ in rows], int)
    held = np.arange(len(x)) % s.calibration == s.calibration - 1
    weights, bias = train([r for r, h in zip(x, held) if not h], y[~held], max(len(languages), 1), s)
    logits = np.array([weights[a].T @ v + bias for (a, v), h in zip(x, held) if h])
    return Model(languages, idf, weights, bias, temperature(logits, y[held]), s)


def predict(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", lang_pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """Add ``lang_pred`` and ``score``, the calibrated probability of that language.

    A text that is null or has no letter is ``und`` with score 0, and so is every text when
    no language was learned. All columns are passed on, of the same name replaced; repeated
    rows stay and an empty table gives an empty result.
    """
    docs = docs.drop(lang_pred, score)
    # buckets x languages numbers, whatever the corpus. As plain arrays, since a broadcast refers to a
    # class by its module, which executors need not have.
    sent = docs.sparkSession.sparkContext.broadcast(vars(model) | {"settings": vars(model.settings)})

    def run(batches):
        m = Model(**{**sent.value, "settings": Settings(**sent.value["settings"])})
        for batch in slices(batches, text):
            best, sure = [], []
            for t in batch.column(text).to_pylist():
                if not m.languages or not has_letter(t):
                    best.append(UNKNOWN)
                    sure.append(0.0)
                    continue
                at, values = features(t, m.idf, m.settings)
                p = softmax((values @ m.weights[at] + m.bias) / m.temperature)
                top = int(p.argmax())
                best.append(m.languages[top])
                sure.append(float(p[top]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(best, pa.string()), pa.array(sure, pa.float64())], [*batch.schema.names, lang_pred, score]
            )

    return docs.mapInArrow(run, with_fields(docs.schema, **{lang_pred: "string", score: "double"}))
