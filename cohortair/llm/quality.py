"""Quality classifier: random-indexing word vectors, a two-layer network, calibrated."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortair.llm.common import crc_fold, free_name, map_texts, only, ship, slices
from cohortair.operators.joins import broadcast_if_small

WORDS, SHAPES, SIZE = 8192, 1024, 32
ROWS = WORDS + SHAPES + 1
REPEAT, PAD = WORDS + SHAPES - 1, ROWS - 1
REACH = 2
BLOCK = 100_000
TOKENS_KEPT = 400_000
FOLDS = 5
THRESHOLD = 0.3
# Lower case and all but ASCII become a, upper case A, digits 0.
SHAPE = bytes(
    0x41 if 0x41 <= b <= 0x5A else 0x61 if 0x61 <= b <= 0x7A or b >= 0x80 else 0x30 if 0x30 <= b <= 0x39 else b
    for b in range(256)
)
RUN = re.compile(rb"(.)\1+", re.DOTALL)


def index_vectors(seed: int = 7, marks: int = 4) -> np.ndarray:
    """A sparse random vector of a few +1 and -1 per row; none for the padding."""
    rng = np.random.default_rng(seed)
    out = np.zeros((ROWS, SIZE), np.float32)
    for row in range(ROWS - 1):
        out[row, rng.choice(SIZE, marks, replace=False)] = rng.choice((-1, 1), marks)
    return out


class Reader:
    """Turns texts into rows of the vector table: a word's row and its shape's."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def look_up(self, token: bytes) -> int:
        shape = RUN.sub(rb"\1", token.translate(SHAPE))
        word = zlib.crc32(token.lower()) % WORDS
        found = word * SHAPES + zlib.crc32(shape) % (SHAPES - 1)
        if len(self.known) > TOKENS_KEPT:
            self.known.clear()
        self.known[token] = found
        return found

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word rows, shape rows, and the first place of each text (and the end).

        Padding lies between texts. A word that repeats the one before has the
        shape row of repeats.
        """
        found, starts = [PAD * SHAPES] * REACH, []
        for text in texts:
            starts.append(len(found))
            tokens = text.encode("utf-8", "replace").split() if text else []
            try:
                found += map(self.known.__getitem__, tokens)
            except KeyError:
                del found[starts[-1] :]
                get = self.known.get
                found += [x if (x := get(t)) is not None else self.look_up(t) for t in tokens]
            found += [PAD * SHAPES] * REACH
        codes = np.array(found, np.int32)
        words = codes // SHAPES
        shapes = WORDS + codes % SHAPES
        shapes[1:][codes[1:] == codes[:-1]] = REPEAT
        shapes[words == PAD] = PAD
        return words, shapes, np.array([*starts, len(found)], np.int64)


def _sum_by(rows: np.ndarray, values: np.ndarray, out: np.ndarray) -> None:
    order = np.argsort(rows.astype(np.int16), kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    out[rows[first]] += np.add.reduceat(values[order], first, axis=0)


def context_sums(words: np.ndarray, shapes: np.ndarray, index: np.ndarray, out: np.ndarray) -> None:
    """Adds to each row the index vectors of what stands up to two words away, and of its own shape."""
    for a in range(REACH, len(words) - REACH, BLOCK):
        b = min(a + BLOCK, len(words) - REACH)
        near = index[words[a - REACH : b + REACH]] + index[shapes[a - REACH : b + REACH]]
        size = b - a
        around = sum(near[k : k + size] for k in range(2 * REACH + 1) if k != REACH)
        around += index[shapes[a:b]]
        _sum_by(words[a:b], around, out)
        _sum_by(shapes[a:b], around, out)


def pooled(words: np.ndarray, shapes: np.ndarray, starts: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Mean word and mean shape vector of each text; zeros without words."""
    out = np.zeros((len(starts) - 1, 2 * SIZE), np.float64)
    for a in range(0, len(words), BLOCK):
        b = min(a + BLOCK, len(words))
        inside = np.clip(starts, a, b)
        full = np.flatnonzero(inside[1:] > inside[:-1])
        at = inside[:-1][full] - a
        out[full, :SIZE] += np.add.reduceat(vectors[words[a:b]], at, axis=0)
        out[full, SIZE:] += np.add.reduceat(vectors[shapes[a:b]], at, axis=0)
    counts = np.diff(starts) - REACH
    return out / np.maximum(counts, 1)[:, None]


def learn_vectors(docs: DataFrame) -> np.ndarray:
    """Word and shape vectors from all texts: summed by tasks, then by Spark per row.

    The table has WORDS + SHAPES rows, whatever the input; rows are scaled to
    length one.
    """
    ship(docs.sparkSession)
    names = [f"v{i}" for i in range(SIZE)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(__name__)
        reader, index, sums = Reader(), index_vectors(), np.zeros((ROWS, SIZE))
        for batch in batches:
            texts = batch.column(0).to_pylist()
            for a, b in slices(texts, 4_000_000):
                words, shapes, _ = reader.read(texts[a:b])
                context_sums(words, shapes, index, sums)
        met = np.flatnonzero(sums.any(axis=1)[:-1])
        arrays = [pa.array(met.astype(np.int32))] + [pa.array(sums[met, i]) for i in range(SIZE)]
        yield pa.RecordBatch.from_arrays(arrays, names=["row", *names])

    schema = "row int, " + ", ".join(f"{n} double" for n in names)
    summed = docs.select("text").mapInArrow(run, schema).groupBy("row").agg(*(F.sum(n).alias(n) for n in names))
    found = summed.toPandas()
    out = np.zeros((ROWS, SIZE), np.float32)
    values = found[names].to_numpy(np.float64)
    out[found.row.to_numpy()] = values / np.maximum(np.linalg.norm(values, axis=1), 1e-12)[:, None]
    return out


@dataclass
class Network:
    """Two layers over standardised inputs; the logit is divided by the temperature."""

    mean: np.ndarray
    scale: np.ndarray
    first: np.ndarray
    first_bias: np.ndarray
    second: np.ndarray
    second_bias: float
    temperature: float = 1.0

    def hidden(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(((x - self.mean) / self.scale) @ self.first + self.first_bias)

    def logits(self, x: np.ndarray) -> np.ndarray:
        return self.hidden(x) @ self.second + self.second_bias

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -60, 60)))


def fit(x: np.ndarray, y: np.ndarray, hidden: int = 32, rounds: int = 400, decay: float = 1e-4) -> Network:
    """Adam over all rows; every fifth row is kept for the temperature."""
    scale = x.std(0)
    net = Network(x.mean(0), np.where(scale > 1e-9, scale, 1.0), *(np.zeros(0),) * 3, 0.0)
    rng = np.random.default_rng(11)
    size = x.shape[1]
    w = [rng.normal(0, size**-0.5, (size, hidden)), np.zeros(hidden), rng.normal(0, hidden**-0.5, hidden), np.zeros(1)]
    aside = np.arange(len(y)) % 5 == 4
    z, target = ((x - net.mean) / net.scale)[~aside], y[~aside]
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    for t in range(1, rounds + 1):
        h = np.tanh(z @ w[0] + w[1])
        off = (1 / (1 + np.exp(-np.clip(h @ w[2] + w[3], -60, 60))) - target) / len(target)
        back = np.outer(off, w[2]) * (1 - h * h)
        grads = [z.T @ back + decay * w[0], back.sum(0), h.T @ off + decay * w[2], off.sum(keepdims=True)]
        for i, g in enumerate(grads):
            m[i] = 0.9 * m[i] + 0.1 * g
            v[i] = 0.999 * v[i] + 0.001 * g * g
            w[i] = w[i] - 0.02 * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    net.first, net.first_bias, net.second, net.second_bias = w[0], w[1], w[2], float(w[3][0])
    if aside.any():
        logits, target = net.logits(x[aside]), y[aside]

        def loss(temperature: float) -> float:
            return float(np.logaddexp(0, np.where(target == 1, -1, 1) * logits / temperature).mean())

        net.temperature = float(min(np.geomspace(0.25, 16, 97), key=loss))
    return net


@dataclass
class Classifier:
    """Vectors and network; without labels of both kinds, `always` is the score of all texts."""

    vectors: np.ndarray
    network: Network | None
    always: float = 0.5

    def scorer(self):
        reader = Reader()

        def run(texts):
            if self.network is None:
                return [[self.always] * len(texts)]
            words, shapes, starts = reader.read(texts)
            return [self.network.scores(pooled(words, shapes, starts, self.vectors))]

        return run


def train(docs: DataFrame, labels: DataFrame, max_labels: int = 20_000) -> Classifier:
    """A classifier of `labels.quality` from texts alone.

    Vectors come from all texts. The network is fitted on about `max_labels`
    labelled rows at most, chosen by a hash of the id among those whose
    crc32(id) modulo 5 isn't 0: their pooled vectors reach the driver. Several
    labels of an id count as their mean, halves as 1; null labels don't count.
    """
    vectors = learn_vectors(docs)
    usable = (
        labels.where((crc_fold(F.col("doc_id"), FOLDS) != 0) & F.col("quality").isNotNull())
        .groupBy("doc_id")
        .agg(F.round(F.avg("quality")).cast("int").alias("quality"))
    )
    share = min(1.0, max_labels / max(1, usable.count()))
    chosen = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share * (1 << 20))
    # About max_labels rows of an id and a number; the bound is measured all the same.
    labelled = docs.select("doc_id", "text").join(broadcast_if_small(chosen), "doc_id")

    def work():
        reader = Reader()
        return lambda texts: [list(pooled(*reader.read(texts), vectors))]

    fields = [T.StructField("pooled", T.ArrayType(T.DoubleType()))]
    found: pd.DataFrame = map_texts(labelled, ["doc_id", "quality"], fields, work, 4_000_000).toPandas()
    # Rows arrive in any order; the fit must not depend on it.
    found = found.sort_values("doc_id", kind="stable")
    if found.quality.nunique() < 2:
        return Classifier(vectors, None, float(found.quality.mean()) if len(found) else 0.5)
    return Classifier(vectors, fit(np.stack(found.pooled.to_list()), found.quality.to_numpy(np.float64)))


def score(docs: DataFrame, model: Classifier, keys: tuple[str, ...], name: str = "score") -> DataFrame:
    """Key columns and the score of each row's whole text; null and empty texts have one too."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work():
        return shared.value.scorer()

    return map_texts(docs, keys, [T.StructField(name, T.DoubleType())], work, 4_000_000)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every row.

    Scores depend on the text alone: 0 to 1, higher where label 1 is likelier.
    Repeated rows and ids give one row each; other columns are ignored,
    whatever their names; an empty table gives none.
    """
    model = train(docs, labels)
    return score(docs, model, ("doc_id",)).select(
        "doc_id",
        (crc_fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, all columns as they are."""
    name = free_name(docs, "score")
    scored = score(docs, train(docs, labels), tuple(docs.columns), name)
    return scored.where(F.col(name) >= threshold).drop(name)
