"""Toxicity by a subsequence string-kernel SVM with Nystrom landmarks.

Kernel: the gap-weighted subsequence kernel of length 3 over the characters
of a word (Lodhi et al.): every subsequence (c1, c2, c3) of a word counts
lambda^span, span being how many characters it covers; the kernel is the
normalised dot product of these weights. So "idiot", "idioot" and "i-d-i-o-t"
share most of their weight: inserted and gapped characters cost a factor of
lambda each. Spans are limited to MAX_SPAN characters (at most two skipped),
which makes the feature map explicit and its evaluation linear in the text.

Nystrom: m landmark words give features z(u) = K_mm^(-1/2) k(u, landmarks);
a linear SVM on z (squared hinge, L2) scores words. A document's raw scores
are the highest score of its words (an insult anywhere makes a text toxic) and
their share of positive score (one word that resembles an insult by chance in
a long text weighs less than several in a short one); a sigmoid of both fitted
on labelled training documents (Platt) gives the score.

Training: word instances get labels from the documents' labels by contrast.
Over all labelled training documents, Spark counts the toxic documents that
hold each word, and for words of two such documents or more the clean ones;
words whose log likelihood ratio (G2) is at least G2 and whose share of toxic
documents is at least RATIO times their share of clean ones (one clean
document added) are positive. G2 and not the odds ratio's z ranks them: z
divides by a standard error that is largest for words no clean document
holds, so it puts chance words before insults. Negatives are the most frequent
other words of a sample of MAX_LABELS labelled rows
(by a hash of the id), a hashed sample of the words only clean documents
of that sample hold, and the clean documents' words the SVM still takes for
insults: HARD of them in each of ROUNDS, out of the POOL words that most clean
documents of the sample hold. Landmarks and examples are bounded, documented
samples of these; the same sample fits Platt's sigmoid.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortair.llm.common import ascii_lower, crc_fold, keeps, map_texts, store
from cohortair.operators.joins import broadcast_if_small

# Fixed values of the contract: words and training folds.
WORD = "[^\\x20\\x09-\\x0D]+"
FOLDS, HELD_OUT = 5, 0
LENGTH, DECAY, MAX_SPAN = 3, 0.5, 5
LANDMARKS, POSITIVES, NEGATIVES, MAX_LABELS = 128, 400, 1200, 20_000
G2, C, RATIO = 10.0, 100.0, 10
ROUNDS, HARD, POOL = 3, 400, 100_000
PRIOR_WORDS = 10
PATTERN = re.compile("[^\x20\x09-\x0d]+")
ASCII_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
CACHE: dict[str, dict[str, float]] = {}
keeps(__name__, CACHE.clear)


def subsequences(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word index, feature code, weight) of every gapped subsequence of length 3, summed per word and code.

    A code packs three code points (21 bits each); the weight of one
    occurrence is DECAY ** span. Words shorter than 3 characters have none.
    Rows come sorted by word. Within one call, word index and ranks of the
    three characters in the call's alphabet form one integer key, so one sort
    gathers equal subsequences; a batch whose key would pass 63 bits is
    split in halves.
    """
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    points = np.frombuffer("".join(words).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
    # Code points ranked within the batch, so that word and subsequence pack into one sort key.
    alphabet, rank = np.unique(points, return_inverse=True)
    size = max(len(alphabet), 1)
    if len(words) > 1 and len(words) * size**3 >= 2**63:  # key would overflow: halves, each sorted by word
        half = len(words) // 2
        a, b = subsequences(words[:half]), subsequences(words[half:])
        return np.r_[a[0], b[0] + half], np.r_[a[1], b[1]], np.r_[a[2], b[2]]
    sizes = np.fromiter((len(w) for w in words), np.int64, len(words))
    owner = np.repeat(np.arange(len(words)), sizes)
    total = len(points)
    keys, weights = [], []
    for g1 in range(MAX_SPAN - LENGTH + 1):
        for g2 in range(MAX_SPAN - LENGTH + 1 - g1):
            first = np.arange(max(total - 2 - g1 - g2, 0))
            third = first + 2 + g1 + g2
            first = first[owner[first] == owner[third]]
            second, third = first + 1 + g1, first + 2 + g1 + g2
            keys.append(((owner[first] * size + rank[first]) * size + rank[second]) * size + rank[third])
            weights.append(np.full(len(first), DECAY ** (3 + g1 + g2)))
    key, weight = np.concatenate(keys), np.concatenate(weights)
    if len(key) == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    unique, where = np.unique(key, return_inverse=True)
    summed = np.bincount(where, weight, minlength=len(unique))
    third, rest = unique % size, unique // size
    second, rest = rest % size, rest // size
    first, ids = rest % size, rest // size
    codes = (alphabet[first] << 42) | (alphabet[second] << 21) | alphabet[third]
    return ids, codes, summed


@dataclass
class Landmarks:
    codes: np.ndarray  # sorted feature codes of all landmarks
    weights: np.ndarray  # len(codes) x m, normalised feature weights
    count: int

    @staticmethod
    def of(words: list[str]) -> Landmarks:
        ids, codes, weights = subsequences(words)
        norms = np.sqrt(np.bincount(ids, weights**2, minlength=len(words)))
        unique, place = np.unique(codes, return_inverse=True)
        table = np.zeros((len(unique), len(words)))
        np.add.at(table, (place, ids), weights / np.where(norms[ids] > 0, norms[ids], 1.0))
        return Landmarks(unique, table, len(words))

    def kernel(self, words: list[str]) -> np.ndarray:
        """Normalised kernel of each word with each landmark (a word without subsequences: zeros)."""
        out = np.zeros((len(words), self.count))
        ids, codes, weights = subsequences(words)
        if len(ids) == 0 or len(self.codes) == 0:
            return out
        norms = np.sqrt(np.bincount(ids, weights**2, minlength=len(words)))
        place = np.clip(np.searchsorted(self.codes, codes), 0, len(self.codes) - 1)
        hit = np.flatnonzero(self.codes[place] == codes)
        if len(hit) == 0:
            return out
        owner = ids[hit]  # sorted, as subsequences sorts by word
        parts = (weights[hit] / norms[owner])[:, None] * self.weights[place[hit]]
        starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
        out[owner[starts]] = np.add.reduceat(parts, starts, axis=0)
        return out


@dataclass
class Model:
    landmarks: Landmarks
    whitening: np.ndarray  # K_mm^(-1/2), m x m
    w: np.ndarray
    b: float
    a: float = 1.0  # Platt: score = 1 / (1 + exp(-(a * raw + s * share + c)))
    s: float = 0.0
    c: float = 0.0
    token: str = field(default_factory=lambda: uuid.uuid4().hex)  # names this model's cached decisions

    def features(self, words: list[str]) -> np.ndarray:
        return self.landmarks.kernel(words) @ self.whitening

    def decisions(self, words: list[str]) -> np.ndarray:
        """SVM decision of each word: its kernel row times K^(-1/2) w, plus the bias.

        That is linear in the word's normalised subsequence weights, so the
        landmark weights, K^(-1/2) and w fold into one weight per landmark
        subsequence, and a word costs one weighted sum instead of m.
        """
        out = np.full(len(words), self.b)
        ids, codes, weights = subsequences(words)
        marks = self.landmarks
        if len(ids) == 0 or len(marks.codes) == 0 or len(self.w) == 0:
            return out
        folded = marks.weights @ (self.whitening @ self.w)
        norms = np.sqrt(np.bincount(ids, weights**2, minlength=len(words)))
        place = np.clip(np.searchsorted(marks.codes, codes), 0, len(marks.codes) - 1)
        hit = np.flatnonzero(marks.codes[place] == codes)
        owner = ids[hit]
        return out + np.bincount(owner, weights[hit] / norms[owner] * folded[place[hit]], minlength=len(words))

    def raw(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Highest word decision of each text and its share of positive decisions.

        The share adds each word's decision, held to 0..1, over the words and
        PRIOR_WORDS more. A text without words gets the bias and no share.
        """
        # A-Z are single bytes in UTF-8 and never part of another character's bytes.
        per_text = [PATTERN.findall((t or "").encode().translate(ASCII_LOWER).decode()) for t in texts]
        if self.token not in CACHE:
            CACHE.clear()
        cache = CACHE.setdefault(self.token, {})
        new = {w for words in per_text for w in words if w not in cache}
        if len(cache) + len(new) > 2_000_000:
            cache.clear()  # a cache of decisions, not results: it is refilled as needed
            new = {w for words in per_text for w in words}
        # A word of fewer than LENGTH characters has no features: its decision is the bias.
        long = sorted(w for w in new if len(w) >= LENGTH)
        cache.update((w, self.b) for w in new if len(w) < LENGTH)
        for i in range(0, len(long), 4096):
            part = long[i : i + 4096]
            cache.update(zip(part, self.decisions(part).tolist(), strict=True))
        sizes = np.fromiter(map(len, per_text), np.int64, len(per_text))
        found = np.fromiter((cache[w] for words in per_text for w in words), float, int(sizes.sum()))
        highest, total = np.full(len(sizes), self.b), np.zeros(len(sizes))
        full = np.flatnonzero(sizes)
        if len(full):
            starts = (np.cumsum(sizes) - sizes)[full]
            highest[full] = np.maximum.reduceat(found, starts)
            total[full] = np.add.reduceat(np.clip(found, 0.0, 1.0), starts)
        return highest, total / (sizes + PRIOR_WORDS)

    def refit(self, positive: list[str], negative: list[str]) -> None:
        """The SVM anew on these words; decisions cached for the old one are not used again."""
        x = self.features(positive + negative)
        self.w, self.b = train_svm(x, np.r_[np.ones(len(positive)), np.zeros(len(negative))])
        self.token = uuid.uuid4().hex


def nystrom(landmarks: Landmarks) -> np.ndarray:
    """K_mm^(-1/2) from the landmarks' own kernel, small eigenvalues left out."""
    k = landmarks.weights.T @ landmarks.weights
    values, vectors = np.linalg.eigh(k)
    keep = values > 1e-8 * max(values.max(initial=0.0), 1e-300)
    return vectors[:, keep] / np.sqrt(values[keep])


def train_svm(x: np.ndarray, y: np.ndarray, c: float = C, steps: int = 60) -> tuple[np.ndarray, float]:
    """Linear SVM, squared hinge with L2, classes weighted alike; Newton steps with backtracking."""
    sign = np.where(y > 0, 1.0, -1.0)
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y <= 0).sum(), 1))
    theta = np.zeros(x.shape[1] + 1)
    design = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.r_[np.full(x.shape[1], 1 / c), 0.0]  # the bias is free

    def loss(t):
        margin = np.maximum(0.0, 1.0 - sign * (design @ t))
        return 0.5 * (ridge * t * t).sum() + (weight * margin**2).sum(), margin

    value, margin = loss(theta)
    for _ in range(steps):
        grad = ridge * theta - 2 * design.T @ (weight * margin * sign)
        if np.linalg.norm(grad) < 1e-9:
            break
        active = design[margin > 0]
        curve = np.diag(ridge + 1e-10) + 2 * (active * weight[margin > 0][:, None]).T @ active
        way, step = np.linalg.solve(curve, grad), 1.0
        while step > 1e-10:
            new_value, new_margin = loss(theta - step * way)
            if new_value <= value - 1e-4 * step * grad @ way:
                break
            step /= 2
        else:
            break
        theta, value, margin = theta - step * way, new_value, new_margin
    return theta[:-1], float(theta[-1])


def platt(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Sigmoid of the columns of raw, fitted by Newton steps on smoothed targets (Platt 1999)."""
    positives, negatives = (y > 0).sum(), (y <= 0).sum()
    target = np.where(y > 0, (positives + 1) / (positives + 2), 1 / (negatives + 2))
    middle, spread = raw.mean(axis=0), raw.std(axis=0)
    spread = np.where(spread > 1e-12, spread, 1.0)
    design = np.hstack([(raw - middle) / spread, np.ones((len(raw), 1))])
    ridge = np.r_[np.full(raw.shape[1], 1e-2), 1e-9]
    theta = np.zeros(design.shape[1])

    def loss(t):
        z = design @ t
        return (np.logaddexp(0.0, z) - target * z).sum() + 0.5 * (ridge * t * t).sum()

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ theta, -500, 500)))
        grad = design.T @ (p - target) + ridge * theta
        curve = (design * (p * (1 - p) + 1e-12)[:, None]).T @ design + np.diag(ridge)
        way, step = np.linalg.solve(curve, grad), 1.0
        while step > 1e-10 and loss(theta - step * way) > loss(theta):
            step /= 2
        theta = theta - step * way
        if np.abs(step * way).max() < 1e-10:
            break
    factors = theta[:-1] / spread
    return factors, float(theta[-1] - factors @ middle)


def labelled(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Training documents with their label: 1 if any label row of the id says so; held-out ids left out."""
    marks = labels.where(F.col(column).isNotNull()).groupBy("doc_id").agg(F.max(column).alias("label"))
    train = docs.select("doc_id", "text").where(crc_fold(F.col("doc_id"), FOLDS) != HELD_OUT)
    # Ids and labels go to the texts where they measure small, so texts are not shuffled for the join.
    return train.join(broadcast_if_small(store(marks)), "doc_id")


def _words(docs: DataFrame) -> DataFrame:
    """(label, word): each document's distinct words of at least LENGTH characters.

    Shorter words have no subsequence, so no kernel weight: they cannot inform the SVM.
    """
    words = F.array_distinct(F.regexp_extract_all(ascii_lower(F.coalesce("text", F.lit(""))), F.lit(WORD), 0))
    return docs.select("label", F.explode(words).alias("word")).where(F.length("word") >= LENGTH)


def word_contrast(train: DataFrame) -> DataFrame:
    """Per word of two toxic documents or more: documents of each class holding it (t, c), and their G2.

    G2 is the log likelihood ratio of one share of documents in both classes
    against a share in each (Dunning 1993).

    Only words that at least two toxic documents hold can be positive, so only
    they are counted in clean documents: the clean documents' words meet that
    list before any shuffle where it measures small (else by a sort-merge
    join), and the shuffle carries toxic documents' words and matches only.
    """
    toxic = _words(train.where(F.col("label") == 1))
    counted = toxic.groupBy("word").agg(F.count(F.lit(1)).alias("t")).where(F.col("t") >= 2)
    candidates = store(counted)
    clean = _words(train.where(F.col("label") != 1)).join(broadcast_if_small(candidates.select("word")), "word", "left_semi")
    in_clean = clean.groupBy("word").agg(F.count(F.lit(1)).alias("c"))
    counts = candidates.join(in_clean, "word", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    totals = train.agg(
        F.sum((F.col("label") == 1).cast("long")).alias("nt"), F.sum((F.col("label") != 1).cast("long")).alias("nc")
    ).first()
    nt, nc = F.lit(totals["nt"] or 0), F.lit(totals["nc"] or 0)
    t, c = F.col("t"), F.col("c")
    cells = ((t, nt, t + c), (c, nc, t + c), (nt - t, nt, nt + nc - t - c), (nc - c, nc, nt + nc - t - c))
    parts = [F.when(n > 0, n * F.log(n * (nt + nc) / (of * both))).otherwise(0.0) for n, of, both in cells]
    return counts.withColumn("g2", 2 * sum(parts[1:], parts[0])).withColumn("nt", nt).withColumn("nc", nc)


def sampled(train: DataFrame) -> DataFrame:
    """The labelled training rows the fit may see whole: MAX_LABELS of them, by a hash of the id."""
    return train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(MAX_LABELS)


def fit(docs: DataFrame, labels: DataFrame, column: str = "toxic") -> Model:
    """Trains on documents outside the held-out fold; only text and label are inputs."""
    model, sample = fit_words(docs, labels, column)
    calibrate(model, raw_scores(sample, model).select("raw", "share", "label"))
    return model


def calibrate(model: Model, raws: DataFrame) -> None:
    """Platt's sigmoid from (raw, share, label) rows of a bounded sample; unchanged without both labels."""
    found = raws.toPandas()
    if found["label"].nunique() == 2:
        (a, s), model.c = platt(found[["raw", "share"]].to_numpy(float), found["label"].to_numpy())
        model.a, model.s = float(a), float(s)


def fit_words(docs: DataFrame, labels: DataFrame, column: str = "toxic") -> tuple[Model, DataFrame]:
    """The SVM over words, without its sigmoid, and the stored labelled sample it saw."""
    train = labelled(docs, labels, column)
    contrast = word_contrast(train)
    # Positives: significant (G2) and at least RATIO times as common among toxic documents, one clean document added.
    ratio = F.col("t") * F.col("nc") >= F.lit(RATIO) * (F.col("c") + 1) * F.col("nt")
    positive = contrast.where((F.col("g2") >= G2) & ratio).orderBy(F.desc("g2"), "word").limit(POSITIVES)
    pos_words = [r.word for r in positive.select("word").collect()]
    # Negatives, from the sample: its most frequent words, and a hashed
    # sample of the words that no toxic document of the sample holds.
    sample = store(sampled(train))
    words = _words(sample).groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.sum((F.col("label") == 1).cast("long")).alias("toxic")
    ).where(~F.col("word").isin(pos_words) if pos_words else F.lit(True))
    words = store(words)
    common = words.orderBy(F.desc("n"), "word").limit(NEGATIVES // 3)
    clean = words.where(F.col("toxic") == 0).orderBy(F.xxhash64("word"), "word").limit(NEGATIVES - NEGATIVES // 3)
    neg_words = sorted({r.word for r in common.union(clean).select("word").collect()})
    half = LANDMARKS // 2
    marks = pos_words[:half] + neg_words[: LANDMARKS - min(half, len(pos_words))]
    landmarks = Landmarks.of(marks or ["empty"])
    model = Model(landmarks, nystrom(landmarks), np.zeros(0), 0.0)
    if pos_words and neg_words:
        model.refit(pos_words, neg_words)
        pool = store(clean_pool(words, sample))
        for _ in range(ROUNDS):
            neg_words = sorted({*neg_words, *hard_negatives(pool, model, neg_words)})
            model.refit(pos_words, neg_words)
    else:
        model.w = np.zeros(model.whitening.shape[1])
    return model, sample


def clean_pool(words: DataFrame, sample: DataFrame) -> DataFrame:
    """The POOL words most clean documents hold, of those no more common among toxic ones."""
    totals = sample.agg(
        F.sum((F.col("label") == 1).cast("long")).alias("t"), F.sum((F.col("label") != 1).cast("long")).alias("c")
    ).first()
    in_clean = F.col("n") - F.col("toxic")
    kept = words.where(F.col("toxic") * F.lit(totals["c"]) <= in_clean * F.lit(totals["t"]))
    return kept.orderBy(F.desc(in_clean), "word").limit(POOL).select("word", F.col("word").alias("text"))


def hard_negatives(pool: DataFrame, model: Model, known: list[str]) -> list[str]:
    """The HARD words of the pool with the highest decisions, those known left out."""
    found = raw_scores(pool, model).orderBy(F.desc("raw"), "word").limit(HARD + len(known))
    return [w for w in (r.word for r in found.select("word").collect()) if w not in set(known)][:HARD]


def raw_scores(docs: DataFrame, model: Model) -> DataFrame:
    keys = [c for c in docs.columns if c != "text"]
    fields = [T.StructField("raw", T.DoubleType()), T.StructField("share", T.DoubleType())]
    return map_texts(docs, keys, fields, _raw_maker(model))


def _raw_maker(model: Model) -> Callable[[], Callable[[list[str | None]], list]]:
    def make():
        return lambda texts: list(model.raw(texts))

    make.__module__ = __name__
    return make


def toxicity(docs: DataFrame, model: Model, threshold: float = 0.5, raw: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out (crc32 of the id as text mod 5 is 0), score in 0..1 and predicted (score >= threshold).

    Every row is scored on its whole text: null and empty texts have no words
    and score the model's bias; repeated rows score alike; other columns are
    not carried (the text goes through a column of its own name, so clashing
    names do not matter). `raw` gives the rows' raw scores where they are
    computed already.
    """
    if raw is None:
        raw = raw_scores(docs.select("doc_id", "text"), model)
    a, s, c = model.a, model.s, model.c
    score = 1 / (1 + F.exp(-(F.lit(a) * F.col("raw") + F.lit(s) * F.col("share") + F.lit(c))))
    return raw.select(
        "doc_id",
        (crc_fold(F.col("doc_id"), FOLDS) == HELD_OUT).alias("held_out"),
        score.alias("score"),
        (score >= threshold).cast("int").alias("predicted"),
        "raw",
    )


def scores(docs: DataFrame, labels: DataFrame, column: str = "toxic") -> DataFrame:
    """Fit and score, each text scored once.

    The raw scores of all rows are stored; the sigmoid is fitted on those of
    the labelled sample (the same ids the words came from), then applied.
    """
    model, sample = fit_words(docs, labels, column)
    raw = store(raw_scores(docs.select("doc_id", "text"), model))
    picked = sample.select("doc_id", "label").dropDuplicates(["doc_id"])
    # One text's scores per sampled id (its highest, as labels are per id), so repeated ids keep the sample's bound.
    per_id = raw.join(broadcast_if_small(picked), "doc_id").groupBy("doc_id").agg(
        F.max(F.struct("raw", "share")).alias("top"), F.max("label").alias("label")
    )
    calibrate(model, per_id.select("top.*", "label"))
    return toxicity(docs, model, raw=raw)

