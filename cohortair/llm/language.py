"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from regex import compile as pattern

from cohortair.llm.common import free_name, map_texts, only, ship, slices

ORDER = 3
UNKNOWN = "und"
HAS_LETTER = pattern(r"\p{L}")
GRAMS_KEPT = 400_000


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts as numbers of a byte and the three before it, and each text's first place.

    Letters are lowered. A text begins after three zero bytes, as if it were
    alone; those are cut out again.
    """
    data = [(t or "").lower().encode("utf-8", "replace") for t in texts]
    pad = b"\0" * ORDER
    stream = np.frombuffer(b"".join(pad + x for x in data), np.uint8).astype(np.uint32)
    sizes = np.array([len(x) for x in data], np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]]) if len(data) else np.zeros(0, np.int64)
    if not len(stream):
        return np.zeros(0, np.uint32), starts
    codes = (stream[3:] | stream[2:-1] << 8 | stream[1:-2] << 16 | stream[:-3] << 24) if len(stream) > 3 else stream[:0]
    keep = np.ones(len(codes), bool)
    for k in range(ORDER):
        # Places of the pads in the stream, three less in the codes.
        at = starts + ORDER * np.arange(len(data)) + k - ORDER
        keep[at[at >= 0]] = False
    return codes[keep], starts


class Trees:
    """Byte context trees of all languages, order 3 and less, with frozen counts.

    A byte's code length in a language: in the longest context seen there, the
    byte's share of count + number of different bytes if it was seen; else the
    escape's share (the number of different bytes) and the code length in the
    context one shorter. Without any context, all 256 bytes are alike.
    """

    def __init__(self, languages: list[str], counted: pd.DataFrame):
        self.languages = languages
        self.tables = []
        for language in range(len(languages)):
            own = counted[counted.language == language]
            codes, counts = own.code.to_numpy(np.uint32), own["count"].to_numpy(np.float64)
            tables = []
            for order in range(ORDER + 1):
                mask = np.uint32((1 << 8 * (order + 1)) - 1)
                symbols, where = np.unique(codes & mask, return_inverse=True)
                seen = np.bincount(where, counts, len(symbols))
                contexts, of = np.unique(symbols >> np.uint32(8), return_inverse=True)
                total = np.bincount(of, seen, len(contexts))
                kinds = np.bincount(of, minlength=len(contexts)).astype(np.float64)
                tables.append(
                    (
                        symbols,
                        np.log2(total + kinds)[of] - np.log2(seen),
                        contexts,
                        np.log2(total + kinds) - np.log2(kinds),
                    )
                )
            self.tables.append(tables)
        self.kept = np.zeros(0, np.uint32)
        self.lengths = np.zeros((0, len(languages)))

    def work_out(self, codes: np.ndarray) -> np.ndarray:
        """Code length in bits of each code in each language."""
        out = np.zeros((len(codes), len(self.languages)))
        for column, tables in enumerate(self.tables):
            spent, open_ = np.zeros(len(codes)), np.ones(len(codes), bool)
            for order in range(ORDER, -1, -1):
                symbols, cost, contexts, escape = tables[order]
                if not len(symbols):
                    continue
                wanted = codes & np.uint32((1 << 8 * (order + 1)) - 1)
                at = np.searchsorted(symbols, wanted).clip(max=len(symbols) - 1)
                hit = open_ & (symbols[at] == wanted)
                spent[hit] += cost[at[hit]]
                open_ &= ~hit
                before = wanted >> np.uint32(8)
                at = np.searchsorted(contexts, before).clip(max=len(contexts) - 1)
                left = open_ & (contexts[at] == before)
                spent[left] += escape[at[left]]
            spent[open_] += 8
            out[:, column] = spent
        return out

    def known(self, codes: np.ndarray) -> np.ndarray:
        """The same for sorted distinct codes, kept from batch to batch."""
        at = np.searchsorted(self.kept, codes).clip(max=max(len(self.kept) - 1, 0))
        new = codes if not len(self.kept) else codes[self.kept[at] != codes]
        if len(new):
            if len(self.kept) + len(new) > GRAMS_KEPT:
                self.kept, self.lengths, new = self.kept[:0], self.lengths[:0], codes
            every = np.concatenate([self.kept, new])
            order = np.argsort(every)
            self.lengths = np.concatenate([self.lengths, self.work_out(new)])[order]
            self.kept = every[order]
            at = np.searchsorted(self.kept, codes)
        return self.lengths[at]

    def bits(self, texts: list[str | None]) -> np.ndarray:
        """Exact code length of each whole text in each language."""
        codes, starts = grams(texts)
        out = np.zeros((len(texts), len(self.languages)))
        if len(codes):
            where, distinct = pd.factorize(codes, sort=True)
            lengths = self.known(distinct)
            ends = np.append(starts[1:], len(codes))
            full = starts < ends
            for column in range(len(self.languages)):
                out[full, column] = np.add.reduceat(lengths[where, column], starts[full])
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and its share among all, by code lengths under equal odds."""
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        if not self.languages:
            return names, scores
        bits = self.bits(texts)
        for i, text in enumerate(texts):
            if text and HAS_LETTER.search(text):
                best = int(bits[i].argmin())
                names[i] = self.languages[best]
                scores[i] = float(1 / np.exp2(np.clip(bits[i, best] - bits[i], -1000, 0)).sum())
        return names, scores


def train(docs: DataFrame, per_language: int = 4000) -> Trees:
    """Trees of the languages named in `docs` (text and lang both there).

    A classifier may be fitted on a sample: of a language with more than
    `per_language` documents, those are taken whose hashed id falls below that
    share, about as many. Grams are counted where texts lie and summed by
    Spark; what reaches the driver is bounded by languages and sample.
    """
    ship(docs.sparkSession)
    rows = docs.select("doc_id", "text", "lang").where("text IS NOT NULL AND lang IS NOT NULL")
    # One row per language.
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    languages = sorted(sizes)
    if not languages:
        return Trees([], pd.DataFrame({"language": [], "code": [], "count": []}))
    share = F.lit(0.0)
    number = F.lit(-1)
    for i, name in enumerate(languages):
        share = F.when(F.col("lang") == name, min(1.0, per_language / sizes[name])).otherwise(share)
        number = F.when(F.col("lang") == name, i).otherwise(number)
    hashed = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 20)) / (1 << 20)
    chosen = rows.where(hashed < share).select(number.alias("language"), "text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(__name__)
        for batch in batches:
            owners = batch.column(0).to_numpy()
            texts = batch.column(1).to_pylist()
            for a, b in slices(texts, 4_000_000):
                codes, starts = grams(texts[a:b])
                if not len(codes):
                    continue
                owner = np.repeat(owners[a:b].astype(np.int64), np.diff(np.append(starts, len(codes))))
                where, distinct = pd.factorize(owner << 32 | codes.astype(np.int64))
                counts = np.bincount(where, minlength=len(distinct))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(distinct >> 32), pa.array(distinct & 0xFFFFFFFF), pa.array(counts.astype(np.int64))],
                    names=["language", "code", "n"],
                )

    counted = chosen.mapInArrow(count, "language long, code long, n long")
    counted = counted.groupBy("language", "code").agg(F.sum("n").alias("count"))
    return Trees(languages, counted.toPandas())


def identify(
    docs: DataFrame,
    trees: Trees,
    keys: tuple[str, ...] = ("doc_id",),
    names: tuple[str, str] = ("lang_pred", "score"),
) -> DataFrame:
    """Key columns, lang_pred and score of every row, from its whole text alone.

    A text that is null or has no letter is `und` with score 0, and so is every
    text where no language was learned. Equal code lengths go to the language
    first by name. Repeated rows and ids give one row each; other columns are
    ignored, whatever their names; an empty table gives none.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def work():
        return shared.value.predict

    fields = [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())]
    return map_texts(docs, keys, fields, work, max_chars=2_000_000)


def keep_identified(docs: DataFrame, trees: Trees, least: float = 0.5) -> DataFrame:
    """The rows whose text has a language with at least that share, all columns as they are."""
    names = free_name(docs, "lang_pred"), free_name(docs, "score")
    found = identify(docs, trees, tuple(docs.columns), names)
    return found.where((F.col(names[0]) != UNKNOWN) & (F.col(names[1]) >= least)).drop(*names)
