"""Language identification by sparse multinomial logistic regression.

Features: n-grams of 1 to 3 characters of the whole lower-cased text, every run
of other characters than letters taken as one space, hashed into
``2 ** FEATURE_BITS`` places; weights are ``log(1 + count)`` times inverse
document frequency, scaled to unit length.  Document frequencies cover all
training documents and are summed by Spark.

Training: follow-the-regularised-leader with an elastic-net penalty over a
bounded sample, ``SAMPLE_DOCS`` documents in all, the same number of each
language (those with the smallest hash of their id; a bound on the hash leaves a
few times as many to be ranked, so that no language is in one task).  Of more than
``MAX_LABELS`` labels the most frequent are learned.  A fifth of the sample is
kept from training and sets the temperature that the class scores are divided
by, so that the score of a prediction is its probability of being right.

Prediction sees the text alone.

Defined results: a null text, and one without a letter, is ``und`` with score 0;
so is every text if no row can be learned from; rows without a label or an id
are not learned from, and a row without an id is not held out; repeated rows
are predicted one by one and are in the sample once; ties go to the label that
comes first; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.llm.common import fold, quoted

FEATURE_BITS = 15
SAMPLE_DOCS = 2048
#: The languages that can be learned: those with the most documents.
MAX_LABELS = 256
EPOCHS = 6
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.2, 0.05
FOLDS, HELD_OUT = 4, 2
UNDETERMINED = "und"
STRETCH = 1 << 20


def letters() -> np.ndarray:
    """For every code point of the basic plane, whether it is a letter."""
    return np.fromiter((chr(i).isalpha() for i in range(1 << 16)), bool, 1 << 16)


def code_points(text: str, is_letter: np.ndarray) -> np.ndarray:
    """Lower-cased letters, runs of anything else as one space; empty without a letter."""
    codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
    low = np.minimum(codes, 0xFFFF)
    found = is_letter[low]
    for i in np.flatnonzero(codes > 0xFFFF):
        found[i] = chr(codes[i]).isalpha()
    if not found.any():
        return codes[:0]
    keep = found.copy()
    keep[1:] |= found[:-1]
    codes = np.where(found, codes, 32)[keep]
    return np.concatenate([[32], codes, [32]] if codes[0] != 32 else [codes, [32]]).astype(
        np.uint32)


def features(text: str | None, is_letter: np.ndarray, bits: int = FEATURE_BITS):
    """(places, log(1 + count)) of a text's hashed n-grams, or None without a letter."""
    codes = code_points(text, is_letter) if text else ()
    if not len(codes):
        return None
    counts = np.zeros(1 << bits, np.int64)
    shift = np.uint32(32 - bits)
    for first in range(0, len(codes), STRETCH):
        c = codes[first:first + STRETCH + 2]
        own = min(STRETCH, len(codes) - first)
        h = c * np.uint32(2654435761)
        for n in (1, 2, 3):
            if n > 1:
                h = (h[:-1] ^ (h[:-1] >> np.uint32(15))) * np.uint32(2246822519) + c[n - 1:]
                h *= np.uint32(3266489917)
            counts += np.bincount(h[:own] >> shift, minlength=1 << bits)
    places = np.flatnonzero(counts)
    return places, np.log1p(counts[places]).astype(np.float32)


def weighted(found, idf: np.ndarray):
    places, tf = found
    x = tf * idf[places]
    return places, x / np.sqrt((x * x).sum())


class FtrlProximal:
    """Multinomial logistic regression by per-coordinate FTRL-proximal steps."""

    def __init__(self, size: int, classes: int):
        self.z = np.zeros((size + 1, classes))
        self.n = np.zeros((size + 1, classes))

    def weights(self, rows) -> np.ndarray:
        z, n = self.z[rows], self.n[rows]
        return np.where(np.abs(z) > L1,
                        -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2), 0.0)

    def step(self, places: np.ndarray, x: np.ndarray, label: int) -> None:
        rows = np.append(places, len(self.z) - 1)  # the last row is the intercept
        x = np.append(x, 1.0)
        w = self.weights(rows)
        g = softmax(x @ w)
        g[label] -= 1
        g = x[:, None] * g
        old = self.n[rows]
        new = old + g * g
        self.z[rows] += g - (np.sqrt(new) - np.sqrt(old)) / ALPHA * w
        self.n[rows] = new


def softmax(s: np.ndarray) -> np.ndarray:
    e = np.exp(s - s.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the scores under which the labels are most likely.

    Of ``n`` labels ``n + 1`` in ``n + 2`` count as right (Platt's targets), so a
    sample without an error does not claim certainty.
    """
    n, k = scores.shape if len(labels) else (0, 0)
    if n == 0 or k < 2:
        return 1.0
    right = np.arange(n), labels
    target = (n + 1) / (n + 2)
    grid = np.exp(np.linspace(-4, 3, 141))
    loss = []
    for t in grid:
        s = scores / t
        s = s - s.max(axis=1, keepdims=True)
        log_p = s - np.log(np.exp(s).sum(axis=1, keepdims=True))
        rest = (log_p.sum(axis=1) - log_p[right]) / (k - 1)
        loss.append(-(target * log_p[right] + (1 - target) * rest).sum())
    return float(grid[int(np.argmin(loss))])


class Model:
    """Weights, inverse document frequencies, labels and temperature."""

    def __init__(self, labels, weights, idf, divisor):
        self.labels, self.weights, self.idf, self.divisor = labels, weights, idf, divisor

    def scores(self, found) -> np.ndarray:
        places, x = weighted(found, self.idf)
        return x @ self.weights[places] + self.weights[-1]

    def predict(self, found) -> tuple[str, float]:
        if found is None or not self.labels:
            return UNDETERMINED, 0.0
        p = softmax(self.scores(found).astype(np.float64) / self.divisor)
        best = int(np.argmax(p))
        return self.labels[best], float(p[best])


def _sample(rows: DataFrame, size: int) -> tuple[list[str], DataFrame]:
    """The labels, and the (id, label) pairs to train on: equally many a label."""
    known = rows.select("id", "label").filter("id is not null and label is not null").distinct()
    counts = dict(tuple(r) for r in known.groupBy("label").agg(F.count("*").alias("n")).orderBy(
        F.desc("n"), "label").limit(MAX_LABELS).collect())
    labels = sorted(counts)
    if not labels:
        return labels, known
    quota = max(1, size // len(labels))

    def below(shares: dict[str, float]) -> DataFrame:
        # At most MAX_LABELS bounds.
        bounds = rows.sparkSession.createDataFrame(
            [(k, min((1 << 63) - 1, int(s * (1 << 64)) - (1 << 63))) for k, s in shares.items()],
            "label string, bound long")
        return known.join(F.broadcast(bounds), "label").filter(
            F.xxhash64("id") <= F.col("bound")).drop("bound")

    shares = {k: min(1.0, (4 * quota + 64) / n) for k, n in counts.items()}
    got = dict(tuple(r) for r in below(shares).groupBy("label").agg(F.count("*")).collect())
    # A label that has fewer below its bound than asked for is ranked as a whole.
    shares = {k: s if got.get(k, 0) >= min(quota, counts[k]) else 1.0 for k, s in shares.items()}
    by_hash = Window.partitionBy("label").orderBy(F.xxhash64("id"), "id")
    picked = below(shares).withColumn("nth", F.row_number().over(by_hash)).filter(
        F.col("nth") <= quota)
    return labels, picked.select("id", "label")


def fit(rows: DataFrame, size: int = SAMPLE_DOCS, bits: int = FEATURE_BITS) -> Model:
    """Learn from (id, label, text) rows; every one of them counts for the frequencies."""
    rows = rows.filter("id is not null and label is not null")
    labels, picked = _sample(rows, size)
    # A row of a label that is not learned counts for the frequencies alone.
    if not labels:
        return Model([], None, None, 1.0)
    # At most ``size`` pairs.
    tagged = rows.join(F.broadcast(picked.withColumn("picked", F.lit(True))),
                       ["id", "label"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = letters()
        df, total = np.zeros(1 << bits, np.int64), 0

        def row(ids, labels, places, values):
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(labels, pa.string()),
                 pa.array(places, pa.list_(pa.int32())),
                 pa.array(values, pa.list_(pa.float32()))],
                names=["id", "label", "places", "tf"])

        for b in batches:
            for i, label, text, use in zip(*(b.column(k).to_pylist() for k in (0, 1)),
                                           b.column(2), b.column(3).to_pylist()):
                found = features(text.as_py(), is_letter, bits)
                total += 1
                if found is not None:
                    df[found[0]] += 1
                    if use:
                        yield row([i], [label], [found[0]], [found[1]])
        yield row([None], [None], [np.append(np.flatnonzero(df), 1 << bits)],
                  [np.append(df[df > 0], total).astype(np.float32)])

    found = tagged.select("id", "label", "text", "picked").mapInArrow(
        run, "id long, label string, places array<int>, tf array<float>").persist()
    try:
        counts = (found.filter("label is null")
                  .select(F.explode(F.arrays_zip("places", "tf")).alias("x"))
                  .groupBy("x.places").agg(F.sum(F.col("x.tf").cast("long")).alias("df"))
                  .toPandas())
        sample = found.filter("label is not null").dropDuplicates(["id", "label"]).orderBy(
            F.xxhash64("id", "label"), "id", "label").toPandas()
    finally:
        found.unpersist()
    df = np.zeros((1 << bits) + 1)
    df[counts["places"].to_numpy()] = counts["df"].to_numpy()
    idf = (np.log((1 + df[-1]) / (1 + df[:-1])) + 1).astype(np.float32)
    number = {label: k for k, label in enumerate(labels)}
    data = [(*weighted((np.asarray(p), np.asarray(t)), idf), number[label])
            for p, t, label in zip(sample["places"], sample["tf"], sample["label"])]
    kept = data[::5] if len(data) >= 20 else []
    train = [d for k, d in enumerate(data) if k % 5] if kept else data
    ftrl = FtrlProximal(1 << bits, len(labels))
    for _ in range(EPOCHS):
        for places, x, label in train:
            ftrl.step(places, x, label)
    model = Model(labels, ftrl.weights(slice(None)).astype(np.float32), idf, 1.0)
    scores = np.array([x @ model.weights[p] + model.weights[-1] for p, x, _ in kept])
    model.divisor = temperature(scores, np.array([label for *_, label in kept], int))
    return model


def learnable(doc_id: str = "doc_id", folds: int = FOLDS, held_out: int = HELD_OUT) -> Column:
    return F.coalesce(fold(doc_id, folds) != held_out, F.lit(False))


def identify(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text",
             label: str = "lang", names: tuple = ("lang_pred", "score"),
             keep: tuple | None = None) -> DataFrame:
    """The columns ``keep`` (all) and the prediction under ``names``; learns where ``train`` holds."""
    return predict(learn(docs, train, doc_id, text, label), docs, text, names, keep)


def learn(docs: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text",
          label: str = "lang") -> Model:
    return fit(docs.filter(train).select(F.col(doc_id).cast("long").alias("id"),
                                         F.col(label).cast("string").alias("label"),
                                         F.col(text).alias("text")))


def predict(model: Model, docs: DataFrame, text: str = "text",
            names: tuple = ("lang_pred", "score"), keep: tuple | None = None) -> DataFrame:
    """The columns ``keep`` (all) and the prediction, which replaces columns of its names."""
    keep = [c for c in (docs.columns if keep is None else keep) if c not in names]
    # By places and under names of their own, so that nothing can clash.
    rows = docs.select(quoted(text).alias("text"), *[
        quoted(c).alias(f"k{k}") for k, c in enumerate(keep) if c != text])
    order = [0 if c == text else rows.columns.index(f"k{k}") for k, c in enumerate(keep)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        is_letter = letters()
        for b in batches:
            got = [model.predict(features(t.as_py(), is_letter)) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in order), pa.array([g[0] for g in got], pa.string()),
                 pa.array([g[1] for g in got], pa.float64())], names=[*keep, *names])

    schema = T.StructType([*(docs.schema[c] for c in keep),
                           T.StructField(names[0], T.StringType()),
                           T.StructField(names[1], T.DoubleType())])
    return rows.mapInArrow(run, schema)
