"""Document fingerprints by consistent weighted sampling."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortair.llm.common import ship

SAMPLES = 64
TERMS_KEPT = 60_000
TERM_BLOCK = 4096
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers scrambled so that any bit depends on all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def draws(terms: np.ndarray, samples: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each term and sample: r ~ Gamma(2, 1), ln c with c ~ Gamma(2, 1), beta ~ uniform.

    They hang on the term's hash alone; the sum of two exponentials is Gamma(2, 1).
    """
    seeds = np.arange(1, 3 * samples + 1, dtype=np.uint64) * GOLDEN
    bits = mixed(terms[:, None] + seeds)
    unit = np.float32(2.0**-32)
    low = ((bits & np.uint64(0xFFFFFFFF)).astype(np.float32) + np.float32(0.5)) * unit
    high = ((bits >> np.uint64(32)).astype(np.float32) + np.float32(0.5)) * unit
    # The smallest product is far above the least single number.
    r = -np.log(np.minimum(low[:, :samples] * high[:, :samples], np.float32(0.9999999)))
    part = slice(samples, 2 * samples)
    c = -np.log(np.minimum(low[:, part] * high[:, part], np.float32(0.9999999)))
    return r, np.log(c), low[:, 2 * samples :]


class Sampler:
    """Signatures of weighted sets; keeps the draws of the terms it met first."""

    def __init__(self, samples: int = SAMPLES):
        self.samples = samples
        self.slots: dict[bytes, int] = {}
        self.used = 0
        self.r, self.ln_c, self.beta, self.once = (
            np.zeros((TERMS_KEPT + TERM_BLOCK, samples), np.float32) for _ in range(4)
        )
        self.hashes = np.zeros(TERMS_KEPT + TERM_BLOCK, np.uint64)

    def fill(self, words: list[bytes], start: int) -> None:
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        at = slice(start, start + len(words))
        r, ln_c, beta = draws(hashes, self.samples)
        self.r[at], self.ln_c[at], self.beta[at], self.hashes[at] = r, ln_c, beta, hashes
        # ln a of weight 1, whose t is 0.
        self.once[at] = ln_c + r * beta - r

    def rows(self, words: list[bytes]) -> np.ndarray:
        """Table rows of up to TERM_BLOCK words; unknown ones get one of their own or a borrowed one."""
        found = list(map(self.slots.get, words))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            start = self.used if self.used + len(new) <= TERMS_KEPT else TERMS_KEPT
            fresh = [words[i] for i in new]
            self.fill(fresh, start)
            for k, i in enumerate(new):
                found[i] = start + k
            if start == self.used and start < TERMS_KEPT:
                self.slots.update(zip(fresh, range(start, start + len(fresh))))
                self.used += len(fresh)
        return np.array(found, np.intp)

    def signature(self, text: str) -> np.ndarray:
        """One number of 16 bits per sample; -1 for a text without words.

        Terms are the words between ASCII white space, weights their counts w.
        Of each sample the term with the least ln a = ln c - r (t - beta) - r
        wins, t = floor(ln w / r + beta); the number hashes that term and t. Two
        texts agree in a sample with the probability of their generalised
        Jaccard similarity.
        """
        counts = Counter(text.encode("utf-8", "replace").split())
        if not counts:
            return np.full(self.samples, -1, np.int32)
        best = np.full(self.samples, np.inf, np.float32)
        term, step = np.zeros(self.samples, np.uint64), np.zeros(self.samples, np.float32)
        words, weights = list(counts), np.fromiter(counts.values(), np.float32, len(counts))
        columns = np.arange(self.samples)
        for a in range(0, len(words), TERM_BLOCK):
            rows = self.rows(words[a : a + TERM_BLOCK])
            ln_a = self.once[rows]
            many = np.flatnonzero(weights[a : a + TERM_BLOCK] > 1)
            t = None
            if len(many):
                at = rows[many]
                r, beta = self.r[at], self.beta[at]
                t = np.floor(np.log(weights[a + many])[:, None] / r + beta)
                ln_a[many] = self.ln_c[at] - r * (t - beta) - r
            first = ln_a.argmin(0)
            value = ln_a[first, columns]
            win = value < best
            best[win], term[win] = value[win], self.hashes[rows[first[win]]]
            steps = np.zeros(self.samples, np.float32)
            if t is not None:
                place = np.full(len(rows), -1)
                place[many] = np.arange(len(many))
                of = place[first]
                steps[of >= 0] = t[of[of >= 0], columns[of >= 0]]
            step[win] = steps[win]
        return (mixed(term + step.astype(np.int64).astype(np.uint64) * GOLDEN) >> np.uint64(48)).astype(np.int32)


def spelled(signature: np.ndarray) -> str:
    """A signature as hex digits, four per sample; empty without words."""
    return "" if signature[0] < 0 else signature.astype(">u2").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples."""
    return float((a == b).mean())


def edited(text: str, following: str) -> str:
    """The text, its last half replaced by as many characters from the start of another."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def in_order(docs: DataFrame, parts: int) -> DataFrame:
    """Rows dealt by ranges of ids, each range followed by the first row of the next as a guest.

    (target, guest, doc_id, text_hash, text), sorted so that every row's
    successor is the row after it; the last range is followed by the very first
    row. Rows without an id come first, equal ids are ordered by a hash of the
    text. Texts are shuffled once; only range bounds and the ranges' first ids,
    both bounded by `parts`, reach the driver.
    """
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("text_hash", F.xxhash64("text"))
    shares = [i / parts for i in range(1, parts)]
    bounds = sorted({int(b) for b in docs.approxQuantile("doc_id", shares, 0.2 / parts)}) if shares else []
    limits = F.array(*map(F.lit, bounds)).cast("array<long>")
    part = F.size(F.filter(limits, lambda b: b <= F.col("doc_id")))
    part = F.when(F.col("doc_id").isNull(), 0).otherwise(part)
    rows = rows.withColumn("part", part)
    order = F.struct(F.col("doc_id").isNotNull().alias("known"), "doc_id", "text_hash")
    firsts = sorted(rows.groupBy("part").agg(F.min(order).alias("first")).collect(), key=lambda r: r["part"])
    # A first row is the guest of the range before it, the very first one that of the last.
    hosts = [
        (r["first"]["doc_id"], r["first"]["text_hash"], firsts[i - 1]["part"]) for i, r in enumerate(firsts)
    ]
    guests = docs.sparkSession.createDataFrame(hosts, "g_id long, g_hash long, host int")
    joined = rows.join(
        F.broadcast(guests), rows.doc_id.eqNullSafe(guests.g_id) & (rows.text_hash == guests.g_hash), "left"
    )
    home = F.struct(F.col("part").alias("target"), F.lit(False).alias("guest"))
    away = F.struct(F.col("host").alias("target"), F.lit(True).alias("guest"))
    places = F.when(F.col("host").isNull(), F.array(home)).otherwise(F.array(home, away))
    return (
        joined.select(F.explode(places).alias("place"), "doc_id", "text_hash", "text")
        .select("place.target", "place.guest", "doc_id", "text_hash", "text")
        .repartition(parts, "target")
        .sortWithinPartitions("target", "guest", F.asc_nulls_first("doc_id"), "text_hash")
    )


def fingerprints(docs: DataFrame, samples: int = SAMPLES) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next of every row.

    The next document is that with the next larger integer id, after the last
    the first; a table of one row is followed by itself. The edited text takes
    its last half from the next one's start. Null is an empty text; two texts
    without words are alike, one with and one without are not. Repeated rows
    and ids give one row each; other columns are ignored, whatever their names;
    an empty table gives none.
    """
    ship(docs.sparkSession)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    id_type = docs.schema["doc_id"].dataType
    ordered = in_order(docs.withColumn("doc_id", F.col("doc_id").cast("long")), parts)
    schema = T.StructType(
        [
            T.StructField("doc_id", T.LongType()),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )
    names = schema.fieldNames()
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, held = Sampler(samples), None
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(i) for i in (0, 1, 2, 4)]
            for i in range(batch.num_rows):
                target, guest, doc_id, text = (c[i].as_py() for c in columns)
                if guest and (held is None or held[0] != target):
                    continue
                sign = sampler.signature(text)
                if held is not None:
                    _, own_id, own, own_sign = held
                    new = edited(own, text)
                    new_sign = sampler.signature(new)
                    digest = hashlib.sha256(new.encode("utf-8", "replace")).hexdigest()
                    near = likeness(own_sign, new_sign), likeness(own_sign, sign)
                    out.append((own_id, len(own), digest, spelled(own_sign), spelled(new_sign), *near))
                held = None if guest else (target, doc_id, text, sign)
            arrays = [pa.array(list(c), type=k) for c, k in zip(zip(*out), types)] if out else [pa.array([], k) for k in types]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return ordered.mapInArrow(run, schema).withColumn("doc_id", F.col("doc_id").cast(id_type))
