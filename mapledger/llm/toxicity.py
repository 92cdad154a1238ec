"""Toxicity by compression distance.

Two zstandard dictionaries are trained, one on toxic text and one on ordinary text. A window is a word, or
twelve bytes of a longer one; it is written four times over and compressed with either dictionary, as the
compressor needs some length before a dictionary pays. How many bytes the toxic dictionary saves against
the ordinary one is the window's distance. A few numbers about the distances of all windows of a text go
through a calibrated logistic threshold.

What is toxic in a toxic text is a few words among many ordinary ones, so its dictionary is trained on the
windows whose first bytes are far more frequent in toxic than in ordinary texts, counted in Spark.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mapledger.session import written

from .common import utf8

WINDOW_BYTES, LEAST_BYTES, HEAD_BYTES, COPIES = 12, 5, 6, 4
TOXIC_BYTES, ORDINARY_BYTES, LEVEL = 8192, 32768, 19
# Bounds of the training sample: texts of each class, and distinct windows behind each dictionary.
SAMPLE_TOXIC, SAMPLE_ORDINARY = 1500, 3000
SAMPLE_TOXIC_WINDOWS, SAMPLE_ORDINARY_WINDOWS, SAMPLE_HEADS = 8192, 200_000, 4000
# A head speaks for toxic text if it is in three such texts, and this many times likelier there.
LEAST_TEXTS, LIKELIER = 3, 20.0
# Windows that a task remembers.
STORE_WINDOWS = 600_000


def windows(text: bytes) -> list[bytes]:
    """Words of a text in lower case, each after a space; longer ones go on in further windows. Less than five
    bytes are hardly more than a match of the compressor: a short word is written until it has them, and
    the last window of a long word reaches back into the one before."""
    found = []
    for word in text.lower().split():
        word = b" " + word
        if len(word) <= WINDOW_BYTES:
            found.append(word if len(word) >= LEAST_BYTES else word * -(-LEAST_BYTES // len(word)))
        else:
            found += [word[i : i + WINDOW_BYTES] for i in range(0, len(word), WINDOW_BYTES)]
            if len(found[-1]) < LEAST_BYTES:
                found[-1] = word[-WINDOW_BYTES:]
    return found


@dataclass(frozen=True)
class ToxicityModel:
    """Two dictionaries (trained, or plain content where there was too little to train on) and weights."""

    toxic: tuple[bytes, bool] = (b"", False)
    ordinary: tuple[bytes, bool] = (b"", False)
    weights: tuple[float, ...] = field(default=())


def dictionary(counts: list[tuple[bytes, int]], size: int) -> tuple[bytes, bool]:
    """A dictionary trained on windows by their counts, six to a sample."""
    samples = [window for window, n in counts for _ in range(min(n, 8))]
    random.Random(7).shuffle(samples)
    grouped = [b"".join(samples[i : i + 6]) for i in range(0, len(samples), 6)]
    try:
        return zstandard.train_dictionary(size, grouped[:60_000]).as_bytes(), True
    except zstandard.ZstdError:
        return b"".join(window for window, _ in reversed(counts))[-size:], False


def compressor(source: tuple[bytes, bool]) -> zstandard.ZstdCompressor:
    content, trained = source
    kind = zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT
    made = zstandard.ZstdCompressionDict(content, dict_type=kind)
    made.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(
        level=LEVEL, dict_data=made, write_content_size=False, write_checksum=False, write_dict_id=False
    )


class Distances:
    """Distances of windows, with a store of bounded size."""

    def __init__(self, toxic: tuple[bytes, bool], ordinary: tuple[bytes, bool]):
        self.toxic, self.ordinary = compressor(toxic), compressor(ordinary)
        self.store: dict[bytes, int] = {}

    def of(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Distances of windows, and of those that are short words."""
        store, found, short = self.store, [], []
        if len(store) > STORE_WINDOWS:
            store.clear()
        for window in windows(text):
            distance = store.get(window)
            if distance is None:
                copies = window * COPIES
                distance = len(self.ordinary.compress(copies)) - len(self.toxic.compress(copies))
                store[window] = distance
            (short if b" " in window[1:] else found).append(distance)
        return np.array(found or [0]), np.array(short or [0])

    def features(self, text: bytes) -> list[float]:
        distances, short = self.of(text)
        top = np.sort(distances)[::-1][:3]
        top = np.concatenate([top, np.repeat(top[-1:], 3 - len(top))])
        return [
            1.0, *top.tolist(), *(np.log1p((distances >= d).sum()) for d in (1, 2, 3, 4)), np.log1p(len(distances)),
            float(short.max()), *(np.log1p((short >= d).sum()) for d in (2, 4)),
        ]


@cache
def distances(toxic: tuple[bytes, bool], ordinary: tuple[bytes, bool]) -> Distances:
    """One store for a Python worker, kept from task to task."""
    return Distances(toxic, ordinary)


def _features(text: Column, toxic: tuple[bytes, bool], ordinary: tuple[bytes, bool]) -> Column:
    @F.arrow_udf("array<double>")
    def features(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known = distances(toxic, ordinary)
        for batch in batches:
            yield pa.array([known.features(text) for text in batch.to_pylist()], pa.list_(pa.float64()))

    return features(text)


def _counted(sample: DataFrame, heads: bool) -> DataFrame:
    """(toxic, window, n): texts of the sample that hold a window, or a window's head."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic, found = [], []
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {w[:HEAD_BYTES] if heads else w for w in windows(text)}
                toxic += [label] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays([pa.array(toxic, pa.int32()), pa.array(found, pa.binary())], ["toxic", "window"])

    rows = sample.select("toxic", "bytes").mapInArrow(count, "toxic int, window binary")
    return rows.groupBy("toxic", "window").agg(F.count("*").alias("n"))


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of a logistic regression with a small ridge, by Newton's method, with the threshold moved to
    where precision and recall are best together."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    z, w = x / scale, np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - y) + 0.05 * w
        bend = (z * (p * (1 - p))[:, None]).T @ z + 0.05 * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    score = z @ w
    order = np.argsort(-score, kind="stable")
    hits = np.cumsum(y[order])
    f1 = 2 * hits / (np.arange(1, len(y) + 1) + y.sum())
    ends = np.append(np.diff(score[order]) != 0, True)
    best = int(np.where(ends, f1, -1).argmax())
    after = score[order][best + 1] if best + 1 < len(y) else score[order][best] - 1
    w = w / scale
    w[0] -= np.clip((score[order][best] + after) / 2, -4, 4)
    return w


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """Whether a document is kept from training: crc32 of its id as text, modulo 5, is 0. Null: false."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(column.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame) -> ToxicityModel:
    """Train on labelled rows that are not held out.

    The sample is bounded: per class, the documents whose id has the smallest hash, up to SAMPLE_TOXIC and
    SAMPLE_ORDINARY. Two thirds of it train the dictionaries and the rest sets the weights. Label rows
    with null toxic or doc_id are left out; a document labelled more than once is toxic if one label says
    so. Without texts of both classes the model is empty, and every score is 0.
    """
    marked = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    marked = marked.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    ids = marked.where(~held_out()).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    mark = F.xxhash64("doc_id").alias("mark")
    taken = [
        ids.where(F.col("toxic") == toxic).select("doc_id", "toxic", mark).orderBy("mark").limit(most)
        for toxic, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY))
    ]
    # Ids are chosen first, by narrow columns; texts are read for at most SAMPLE_TOXIC + SAMPLE_ORDINARY of them.
    chosen = written(taken[0].unionByName(taken[1]), "toxicity-ids")
    # Copies of a row count once, or one document could fill the sample.
    rows = docs.select("doc_id", utf8().alias("bytes")).join(F.broadcast(chosen), "doc_id").dropDuplicates(["doc_id", "bytes"])
    bounded = [
        rows.where(F.col("toxic") == toxic).orderBy("mark", "bytes").limit(most)
        for toxic, most in ((1, SAMPLE_TOXIC), (0, SAMPLE_ORDINARY))
    ]
    sample = written(bounded[0].unionByName(bounded[1]).repartition(16), "toxicity-sample")
    teaching = F.pmod(F.xxhash64("mark"), F.lit(3)) < 2
    sizes = {r["toxic"]: r["n"] for r in sample.where(teaching).groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return ToxicityModel()
    teach = sample.where(teaching)
    heads = _counted(teach, heads=True).groupBy("window").agg(
        *(F.coalesce(F.sum(F.when(F.col("toxic") == c, F.col("n"))), F.lit(0)).alias(f"n{c}") for c in (0, 1))
    )
    odds = (F.col("n1") + 0.5) / (sizes[1] + 1) / ((F.col("n0") + 0.5) / (sizes[0] + 1))
    telling = heads.where((F.col("n1") >= LEAST_TEXTS) & (odds > LIKELIER)).orderBy(F.desc("n1"), "window").limit(SAMPLE_HEADS)
    counted = written(_counted(teach, heads=False), "toxicity-windows")
    toxic = counted.where(F.col("toxic") == 1).withColumn("head", F.substring("window", 1, HEAD_BYTES))
    told = toxic.join(telling.select(F.col("window").alias("head")), "head", "left_semi")

    def most(df: DataFrame, n: int) -> list[tuple[bytes, int]]:
        return [(bytes(r["window"]), r["n"]) for r in df.orderBy(F.desc("n"), "window").limit(n).collect()]

    bad = most(told, SAMPLE_TOXIC_WINDOWS) or most(toxic, SAMPLE_TOXIC_WINDOWS)
    # Short words are in most texts and would fill the ordinary dictionary; without them there, both are even.
    longer = F.locate(" ", F.col("window").cast("string"), 2) == 0
    good = most(counted.where((F.col("toxic") == 0) & longer), SAMPLE_ORDINARY_WINDOWS)
    if not bad or not good:
        return ToxicityModel()
    dictionaries = dictionary(bad, TOXIC_BYTES), dictionary(good, ORDINARY_BYTES)
    check = sample.where(~teaching).select("toxic", _features(F.col("bytes"), *dictionaries).alias("x")).collect()
    if len({r["toxic"] for r in check}) < 2:
        check = sample.select("toxic", _features(F.col("bytes"), *dictionaries).alias("x")).collect()
    check.sort(key=lambda r: (r["toxic"], r["x"]))
    weights = _logistic(np.array([r["x"] for r in check]), np.array([float(r["toxic"]) for r in check]))
    return ToxicityModel(*dictionaries, tuple(weights.tolist()))


def toxicity_score(model: ToxicityModel, text: Column | str = "text") -> Column:
    """Score from 0 to 1 of a whole text; null and empty texts have the score of a text without any window."""
    if not model.weights:
        return F.lit(0.0)
    x = _features(utf8(text), model.toxic, model.ordinary)
    weights = F.array(*map(F.lit, model.weights))
    total = F.aggregate(F.zip_with(x, weights, lambda a, b: a * b), F.lit(0.0), lambda total, part: total + part)
    return 1 / (1 + F.exp(-total))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all ``documents`` by a model that has not seen the held-out ones."""
    scored = docs.select("doc_id", held_out().alias("held_out"), toxicity_score(fit_toxicity(docs, labels)).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those whose score is 0.5 or more."""
    return docs.where(toxicity_score(fit_toxicity(docs, labels)) < 0.5)
