"""Language-model scores: unigrams, and a hashed maximum-entropy model over context features.

Its features are of two kinds: buckets of tokens, whose tables have a fixed
size, and tokens after tokens as they are, one for each that training texts hold.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortair.llm.common import crc_fold, keeps, only, ship, slices, store

ALPHA = 0.1
END = b""
# Tokens fall into buckets, buckets into classes; frequent tokens have a bucket of their own.
CLASSES, MEMBERS, SHARED = 16, 32, 128
BUCKETS = CLASSES * MEMBERS
BEGIN = BUCKETS
CONTEXTS = BUCKETS + 1
PAIRS, SKIPS = 8192, 8192
# Rows of the class table: bias, last bucket, the one before it, both together.
CLASS_ROWS = 1 + 2 * (BUCKETS + 1) + PAIRS
# Rows of the member table, each for a class: bias, last bucket, the one before it (hashed).
MEMBER_ROWS = CLASSES + (BUCKETS + 1) * CLASSES + SKIPS
# Counts that gradients follow from: of classes in contexts, of buckets after a last and after a skipped one.
CELLS = CONTEXTS * CONTEXTS * CLASSES + 2 * CONTEXTS * BUCKETS
# Training texts are dealt by hash into slices: one tells when to stop, and each other one is a step of a pass.
STEPS, RATE = 8, 0.7
# Passes end when the loss per token falls by less; the second number only ends what would never settle.
LEAST_FALL, MOST_PASSES = 0.002, 50
BATCH = 16384
# Tokens whose places a task holds before it counts them.
PLACES_HELD = 2_000_000
TYPES_KEPT = 300_000
# Codes of frequent tokens are their ranks; those of the others begin here and hold 47 bits of their hash.
RARE, CODE_BYTES = 1 << 47, 6
BEFORE = -1
# Characters of a batch of texts, and training tokens for each part that counts features.
BATCH_CHARS, PART_TOKENS = 2_000_000, 1_000_000
# Runs of tokens that are features of their own, by length, and how many places the shorter run's share stands for.
PRIOR = {2: 8.0}
# Summed counts travel in pieces of so many cells, compressed: most are 0.
PIECE = 150_000
MODELS: dict[str, "Model"] = {}
keeps(__name__, MODELS.clear)


def split(text: str | None) -> list[bytes]:
    """Words with A-Z lowered, and one end."""
    return [*text.encode("utf-8", "replace").lower().split(), END] if text else [END]


def hashed(token: bytes) -> int:
    """The shared bucket of a token; Spark's xxhash64 modulo gives the same."""
    value = xxhash.xxh64_intdigest(token, 42)
    return BUCKETS - SHARED + (value - (1 << 64) if value >> 63 else value) % SHARED


def count_tokens(docs: DataFrame) -> DataFrame:
    """(token, count) of all texts, as a stored table; counted by tasks before the shuffle."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()

        def out() -> pa.RecordBatch:
            arrays = [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())]
            return pa.RecordBatch.from_arrays(arrays, names=["token", "n"])

        for batch in batches:
            for text in batch.column(0).to_pylist():
                counts.update(split(text))
                if len(counts) > TYPES_KEPT:
                    yield out()
                    counts.clear()
        yield out()

    counted = docs.select("text").mapInArrow(run, "token binary, n long")
    return store(counted.groupBy("token").agg(F.sum("n").alias("count")))


class Codes(dict):
    """Code of a token: its rank if it is frequent, else bits of its hash, the lowest of which tell its bucket."""

    def __init__(self, tokens: list[bytes]):
        super().__init__(zip(tokens, range(len(tokens))))

    def __missing__(self, token: bytes) -> int:
        return RARE | xxhash.xxh64_intdigest(token, 42) & (RARE - 1)


@dataclass
class Model:
    """Frequent tokens with their counts, bucket sizes, and the weights of both tables."""

    tokens: list[bytes]
    counts: np.ndarray
    total: int
    types: int
    bucket_total: np.ndarray
    bucket_types: np.ndarray
    classes: np.ndarray = field(default_factory=lambda: np.zeros((CLASS_ROWS, CLASSES), np.float32))
    members: np.ndarray = field(default_factory=lambda: np.zeros((MEMBER_ROWS, MEMBERS), np.float32))
    texts: int = 0

    def prepared(self) -> Model:
        """With what tasks look up: codes, buckets by code, logarithms."""
        self.codes = Codes(self.tokens)
        own = BUCKETS - SHARED
        ranked = [i if i < own else hashed(t) for i, t in enumerate(self.tokens)]
        self.bucket = np.array([*ranked, 0], np.int32)
        # The last place is for the others.
        self.log_count = np.append(np.log10(self.counts + ALPHA), 0.0)
        self.log_bucket = np.log10(self.bucket_total + ALPHA * (self.bucket_types + 1))
        return self

    def tabled(self) -> Model:
        """With the log shares of classes and the logarithms of member sums in every context."""
        self.class_logs = class_logs(self.classes)[0]
        self.member_logs = np.empty((CLASSES, CONTEXTS * CONTEXTS), np.float32)
        for kind in range(CLASSES):
            _, _, a, b, most = member_parts(self.members, kind)
            self.member_logs[kind] = (np.log(a @ b.T) + most).ravel()
        return self

    def start(self) -> None:
        """Biases from the counts, so that training begins at the unigram model."""
        sizes = self.bucket_total.reshape(CLASSES, MEMBERS) + 1.0
        self.classes[0] = np.log(sizes.sum(1) / sizes.sum())
        self.members[:CLASSES] = np.log(sizes / sizes.sum(1, keepdims=True))

    def read(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
        """Codes of all tokens, the first place of each text, and its tokens."""
        tokens = [split(t) for t in texts]
        found: list[int] = []
        for each in tokens:
            found += map(self.codes.__getitem__, each)
        sizes = np.array([len(t) for t in tokens], np.int64)
        return np.array(found, np.int64), np.concatenate([[0], np.cumsum(sizes)[:-1]]), tokens

    def features(self, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
        """Of each token its bucket, and those of the two tokens before it."""
        return features(self.bucket, codes, starts)


def features(bucket: np.ndarray, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each token its bucket, given those of frequent codes and one more place, and those of the two tokens before it."""
    rare = BUCKETS - SHARED + (codes & (SHARED - 1)).astype(np.int32)
    target = np.where(codes < RARE, bucket[np.minimum(codes, len(bucket) - 1)], rare)
    last, skip = np.empty_like(target), np.empty_like(target)
    last[1:], skip[2:] = target[:-1], target[:-2]
    last[starts] = skip[starts] = BEGIN
    after = starts + 1
    skip[after[after < len(target)]] = BEGIN
    return target, last, skip


def class_rows(last: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, ...]:
    pair = (last.astype(np.int64) * 40_503 + skip.astype(np.int64) * 2_654_435_761 >> 7) % PAIRS
    return 1 + last, 2 + BUCKETS + skip, 3 + 2 * BUCKETS + pair.astype(np.int32)


def member_rows(kind: np.ndarray, last: np.ndarray, skip: np.ndarray) -> tuple[np.ndarray, ...]:
    far = (skip.astype(np.int64) * 65_599 + kind.astype(np.int64) * 2_654_435_761 >> 5) % SKIPS
    near = CLASSES + last * CLASSES + kind
    return kind, near, (CLASSES + (BUCKETS + 1) * CLASSES + far).astype(np.int32)


def log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def forward(model: Model, target: np.ndarray, last: np.ndarray, skip: np.ndarray) -> tuple:
    """Log shares of all classes, and of all members of the target's class, with the rows used."""
    kind = target // MEMBERS
    a, b = class_rows(last, skip), member_rows(kind, last, skip)
    classes = log_softmax(sum(model.classes[r] for r in a) + model.classes[0])
    members = log_softmax(sum(model.members[r] for r in b))
    return kind, target % MEMBERS, a, b, classes, members


def descend(weights: np.ndarray, seen: np.ndarray, often: np.ndarray, at: np.ndarray, total: np.ndarray, counts: np.ndarray):
    """One Adagrad step on rows with gradients summed over a slice.

    `seen` keeps squared gradients and `often` counts, which stand for the
    noise of a sum: without them a gradient near 0 would move a row as far as
    a large one. A slice twice as large gives the same step.
    """
    often[at] += counts
    seen[at] += (total * total).mean(1)
    weights[at] -= RATE * total / np.sqrt(seen[at] + often[at])[:, None]


def summed(rows: np.ndarray, grads: np.ndarray, size: int) -> tuple[np.ndarray, ...]:
    """Touched rows of a table of that size, their summed gradients and counts; `grads` has a line per column."""
    counts = np.bincount(rows, minlength=size)
    at = np.flatnonzero(counts)
    total = np.stack([np.bincount(rows, line, size)[at] for line in grads], 1)
    return at, total.astype(np.float32), counts[at]


def gradients(model: Model, batches: Iterator[list[str | None]], needed: bool) -> tuple:
    """Sums over texts at fixed weights: gradients of both tables, how often each row was touched, loss, tokens."""
    sums = np.zeros(model.classes.shape), np.zeros(model.members.shape)
    often = np.zeros(CLASS_ROWS, np.int64), np.zeros(MEMBER_ROWS, np.int64)
    loss, tokens = 0.0, 0
    for texts in batches:
        codes, starts, _ = model.read(texts)
        target, last, skip = model.features(codes, starts)
        for i in range(0, len(target), BATCH):
            part = slice(i, i + BATCH)
            kind, member, a, b, classes, members = forward(model, target[part], last[part], skip[part])
            each = np.arange(len(kind))
            loss -= float((classes[each, kind].astype(np.float64) + members[each, member]).sum())
            tokens += len(kind)
            if not needed:
                continue
            off, off_member = np.exp(classes), np.exp(members)
            off[each, kind] -= 1
            off_member[each, member] -= 1
            sums[0][0] += off.sum(0)
            often[0][0] += len(kind)
            lines, member_lines = np.ascontiguousarray(off.T), np.ascontiguousarray(off_member.T)
            for number, used, held in ((0, a, lines), (1, b, member_lines)):
                for rows in used:
                    at, total, counts = summed(rows, held, len(often[number]))
                    sums[number][at] += total
                    often[number][at] += counts
    return sums, often, loss, tokens


def class_logs(classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log shares of the classes in every context (last, skip), and the contexts' rows for both together."""
    last, skip = np.divmod(np.arange(CONTEXTS * CONTEXTS), CONTEXTS)
    rows = class_rows(last, skip)
    return log_softmax(sum(classes[r] for r in rows) + classes[0]), rows[2]


def member_parts(members: np.ndarray, kind: int) -> tuple[np.ndarray, ...]:
    """Of a class the rows by last and by skipped bucket, and their weights as powers of e, each row's largest and the rest.

    The powers of a context are products of the two, so that their sums in all
    contexts are one matrix product.
    """
    every = np.arange(CONTEXTS)
    _, near, far = member_rows(np.full(CONTEXTS, kind), every, every)
    a, b = (members[near] + members[kind]).astype(np.float64), members[far].astype(np.float64)
    most_a, most_b = a.max(1, keepdims=True), b.max(1, keepdims=True)
    return near, far, np.exp(a - most_a), np.exp(b - most_b), most_a + most_b.T


def tally(target: np.ndarray, last: np.ndarray, skip: np.ndarray) -> list[np.ndarray]:
    """How often each class stands in each context, and each bucket after a last and after a skipped one.

    Gradients and loss depend on the tokens by these counts alone.
    """
    last, skip = last.astype(np.int64), skip.astype(np.int64)
    cell = (last * CONTEXTS + skip) * CLASSES + target // MEMBERS
    pairs = CONTEXTS * BUCKETS
    return [
        np.bincount(cell, minlength=CONTEXTS * CONTEXTS * CLASSES),
        np.bincount(last * BUCKETS + target, minlength=pairs),
        np.bincount(skip * BUCKETS + target, minlength=pairs),
    ]


def counted_gradients(classes: np.ndarray, members: np.ndarray, counts: list[np.ndarray]) -> tuple:
    """What `gradients` sums up, worked out from the counts of all tokens, context by context."""
    sums = np.zeros(classes.shape), np.zeros(members.shape)
    often = np.zeros(CLASS_ROWS, np.int64), np.zeros(MEMBER_ROWS, np.int64)
    cells = counts[0].reshape(-1, CLASSES)
    near_counts, far_counts = (c.reshape(CONTEXTS, CLASSES, MEMBERS) for c in counts[1:])
    logs, pair = class_logs(classes)
    logs, met = logs.astype(np.float64), cells.sum(1)
    loss, tokens = -float((cells * logs).sum()), int(met.sum())
    off = np.exp(logs) * met[:, None] - cells
    around, square = off.reshape(CONTEXTS, CONTEXTS, CLASSES), met.reshape(CONTEXTS, CONTEXTS)
    sums[0][0], often[0][0] = off.sum(0), tokens
    for rows, axis in ((slice(1, 1 + CONTEXTS), 1), (slice(1 + CONTEXTS, 1 + 2 * CONTEXTS), 0)):
        sums[0][rows], often[0][rows] = around.sum(axis), square.sum(axis)
    sums[0][:] += np.stack([np.bincount(pair, line, CLASS_ROWS) for line in off.T], 1)
    often[0][:] += np.bincount(pair, met, CLASS_ROWS).astype(np.int64)
    cube = counts[0].reshape(CONTEXTS, CONTEXTS, CLASSES)
    for kind in range(CLASSES):
        n = cube[:, :, kind]
        near, far, a, b, most = member_parts(members, kind)
        whole = a @ b.T
        after, before = near_counts[:, kind], far_counts[:, kind]
        loss += float((n * (np.log(whole) + most)).sum())
        loss -= float((after * (members[near] + members[kind])).sum() + (before * members[far]).sum())
        share = n / whole
        off_near, off_far = a * (share @ b) - after, b * (share.T @ a) - before
        sums[1][kind], often[1][kind] = off_near.sum(0), n.sum()
        sums[1][near], often[1][near] = off_near, n.sum(1)
        np.add.at(sums[1], far, off_far)
        np.add.at(often[1], far, n.sum(0))
    return sums, often, loss, tokens


def places(docs: DataFrame, model: Model, parts: int = 1, folds: int = 0) -> DataFrame:
    """All texts in batches, as a stored table: codes of tokens, where texts begin, and their rare tokens.

    Texts are read once; passes and scores read these. Texts are dealt by hash
    into `parts`; with `folds`, those that aren't learned from get none (-1).
    """
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    dealt = F.pmod(F.xxhash64("doc_id", "text"), F.lit(parts)) if parts > 1 else F.lit(0)
    if folds:
        dealt = F.when(crc_fold(F.col("doc_id"), folds) == 0, -1).otherwise(dealt)
    schema = T.StructType([
        T.StructField("batch", T.LongType()),
        T.StructField("ids", T.ArrayType(docs.schema["doc_id"].dataType)),
        T.StructField("rows", T.ArrayType(T.LongType())),
        T.StructField("parts", T.ArrayType(T.IntegerType())),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("codes", T.BinaryType()),
        T.StructField("rare", T.ArrayType(T.StructType([
            T.StructField("row", T.LongType()), T.StructField("token", T.BinaryType()), T.StructField("n", T.LongType())
        ]))),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(__name__)
        own = shared.value.prepared()

        def one(column: pa.Array) -> pa.Array:
            return pa.ListArray.from_arrays([0, len(column)], column)

        for batch in batches:
            for piece in range(0, batch.num_rows, 2000):
                held = batch.slice(piece, 2000)
                texts = held.column(3).to_pylist()
                for a, b in slices(texts, BATCH_CHARS):
                    codes, starts, tokens = own.read(texts[a:b])
                    ids, rows, part = (held.column(i).slice(a, b - a) for i in range(3))
                    each = rows.to_pylist()
                    rare = [(r, t, n) for r, x in zip(each, rare_tokens(codes, starts, tokens)) for t, n in x]
                    row, token, n = zip(*rare) if rare else ((), (), ())
                    lists = pa.StructArray.from_arrays(
                        [pa.array(row, pa.int64()), pa.array(token, pa.binary()), pa.array(n, pa.int64())], ["row", "token", "n"]
                    )
                    # The first bytes of all codes, then the second ones, and so on: most of the last are 0.
                    planes = codes.view(np.uint8).reshape(-1, 8)[:, :CODE_BYTES].T
                    arrays = [pa.array(each[:1], pa.int64()), one(ids), one(rows), one(part), one(pa.array(starts))]
                    arrays += [pa.array([packed(planes)], pa.binary()), one(lists)]
                    yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    row = F.monotonically_increasing_id().alias("row")
    return store(docs.select("doc_id", row, dealt.cast("int").alias("part"), "text").mapInArrow(run, schema))


def packed(values: np.ndarray) -> bytes:
    """Numbers compressed, after the length of their bytes."""
    raw = np.ascontiguousarray(values).tobytes()
    return len(raw).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def loaded(value: pa.BinaryScalar, kind: type) -> np.ndarray:
    """The numbers that `packed` compressed."""
    raw = value.as_buffer()
    size = int.from_bytes(raw[:8], "little")
    return np.frombuffer(pa.decompress(raw[8:], size, codec="zstd"), kind)


def rare_tokens(codes: np.ndarray, starts: np.ndarray, tokens: list[list[bytes]]) -> list[list[tuple[bytes, int]]]:
    """Of each text its tokens that aren't among the frequent ones, with their numbers."""
    common, ends = codes < RARE, np.append(starts[1:], len(codes))
    return [
        list(Counter(each[i] for i in np.flatnonzero(~common[a:b])).items())
        for a, b, each in zip(starts.tolist(), ends.tolist(), tokens)
    ]


def unpacked(batch: pa.RecordBatch, i: int) -> tuple[np.ndarray, ...]:
    """Of a stored batch the codes, where texts begin, and each text's part."""
    value, starts, parts = (batch.column(batch.schema.get_field_index(n))[i] for n in ("codes", "starts", "parts"))
    planes = loaded(value, np.uint8).reshape(CODE_BYTES, -1)
    codes = np.zeros((planes.shape[1], 8), np.uint8)
    codes[:, :CODE_BYTES] = planes.T
    return codes.view(np.int64).ravel(), starts.values.to_numpy(), parts.values.to_numpy()


def summed_places(placed: DataFrame, model: Model) -> DataFrame:
    """(part, piece, counts): `tally` of all stored places of each part, as a stored table of a fixed size.

    Tasks count and Spark adds up, so that how the texts are split into tasks changes nothing.
    """
    bucket = replace(model).prepared().bucket

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of its own name, so that what the step before took goes back to the system.
        only(f"{__name__} counts")
        sums: dict[int, np.ndarray] = {}
        held: dict[int, list[np.ndarray]] = {}
        size = counted = 0

        def count() -> None:
            for part, found in held.items():
                at = 0
                if part not in sums:
                    sums[part] = np.zeros(CELLS, np.uint32)
                for counts in tally(*np.concatenate(found, 1)):
                    np.add(sums[part][at : at + len(counts)], counts, out=sums[part][at : at + len(counts)], casting="unsafe")
                    at += len(counts)
            held.clear()

        def out() -> Iterator[pa.RecordBatch]:
            for part, cells in sums.items():
                for piece in range(0, len(cells), PIECE):
                    value = cells[piece : piece + PIECE]
                    if value.any():
                        arrays = [pa.array([part], pa.int32()), pa.array([piece], pa.int32()), pa.array([4], pa.int32())]
                        arrays.append(pa.array([packed(value)], pa.binary()))
                        yield pa.RecordBatch.from_arrays(arrays, names=["part", "piece", "width", "counts"])
            sums.clear()

        for batch in batches:
            for i in range(batch.num_rows):
                codes, starts, parts = unpacked(batch, i)
                three = np.stack(features(bucket, codes, starts)).astype(np.int16)
                of = np.repeat(parts, np.diff(np.append(starts, len(codes))))
                for part in np.unique(parts[parts >= 0]).tolist():
                    held.setdefault(part, []).append(three[:, of == part])
                size += len(codes)
                if size > PLACES_HELD:
                    count()
                    size, counted = 0, counted + size
                if counted > 1 << 31:
                    # Before 32 bits could pass.
                    yield from out()
                    counted = 0
        count()
        yield from out()

    def add(table: pa.Table) -> pa.Table:
        total = sum(loaded(x, np.uint32).astype(np.int64) for x in table["counts"])
        width = 4 if total.max() < 1 << 32 else 8
        value = packed(total.astype(np.uint32 if width == 4 else np.int64))
        own = table.slice(0, 1).set_column(2, "width", pa.array([width], pa.int32()))
        return own.set_column(3, "counts", pa.array([value], pa.binary()))

    schema = "part int, piece int, width int, counts binary"
    few = placed.select("starts", "parts", "codes").coalesce(placed.sparkSession.sparkContext.defaultParallelism)
    # A task's counts have a fixed size: no more tasks than run at once.
    return store(few.mapInArrow(run, schema).groupBy("part", "piece").applyInArrow(add, schema))


def assembled(batches: Iterator[pa.RecordBatch]) -> dict[int, np.ndarray]:
    """Of each part the summed counts in one."""
    found: dict[int, np.ndarray] = {}
    for batch in batches:
        for part, piece, width, value in zip(*(batch.column(i).to_pylist() for i in range(3)), batch.column(3)):
            cells = found.setdefault(part, np.zeros(CELLS, np.uint32))
            if width == 8 and cells.itemsize == 4:
                found[part] = cells = cells.astype(np.int64)
            own = loaded(value, np.uint32 if width == 4 else np.int64)
            cells[piece : piece + len(own)] = own
    return found


def part_gradients(classes: np.ndarray, members: np.ndarray, cells: np.ndarray | None, needed: bool = True) -> tuple[list[tuple], float, int]:
    """Per table touched rows, gradients and counts, then loss and tokens, of a part's counts."""
    if cells is None:
        return [], 0.0, 0
    cube, pairs = CONTEXTS * CONTEXTS * CLASSES, CONTEXTS * BUCKETS
    counts = np.split(cells.astype(np.int64), [cube, cube + pairs])
    sums, often, loss, tokens = counted_gradients(classes, members, counts)
    at = [np.flatnonzero(o) for o in often]
    return [(a, s[a], o[a]) for a, s, o in zip(at, sums, often)] if needed else [], loss, tokens


def summed_gradients(docs: DataFrame, model: Model, needed: bool = True) -> tuple[list[tuple], float, int]:
    """The same over all texts."""
    found = summed_places(places(docs, model), model).toArrow()
    return part_gradients(model.classes, model.members, assembled(found.to_batches()).get(0), needed)


def steps(model: Model, counts: dict[int, np.ndarray]) -> list[float]:
    """Passes of global steps until the loss of the slice left out stops falling; that loss before and after each.

    The slice left out is the last step, so that every text is learned from.
    """
    tables = model.classes, model.members
    seen = [np.zeros(len(t)) for t in tables]
    often = [np.zeros(len(t)) for t in tables]

    def step(k: int) -> None:
        found, _, _ = part_gradients(*tables, counts.get(k))
        for i, (at, total, touched) in enumerate(found):
            descend(tables[i], seen[i], often[i], at, total, touched)

    def left_out() -> float:
        _, loss, tokens = part_gradients(*tables, counts.get(STEPS), needed=False)
        return loss / max(tokens, 1)

    losses = [left_out()]
    for _ in range(MOST_PASSES):
        for k in range(STEPS):
            step(k)
        losses.append(left_out())
        if losses[-1] > losses[-2] - LEAST_FALL:
            break
    step(STEPS)
    return losses


def fit(placed: DataFrame, model: Model) -> list[float]:
    """Trains the weights of buckets on stored places; the losses of the slice left out.

    Gradients depend on the texts by summed counts alone, whose number is fixed,
    and so do steps: one task does them all, whatever the size of the input.
    """
    # What a task needs, without the tokens.
    shared = placed.sparkSession.sparkContext.broadcast(replace(model, tokens=[], counts=model.counts[:0]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(f"{__name__} steps")
        own = replace(shared.value, classes=shared.value.classes.copy(), members=shared.value.members.copy())
        losses = steps(own, assembled(batches))
        arrays = [pa.array([x.astype(np.float32).tobytes()], pa.binary()) for x in (own.classes, own.members)]
        yield pa.RecordBatch.from_arrays([*arrays, pa.array([losses])], names=["classes", "members", "losses"])

    counts = summed_places(placed, model)
    made = counts.coalesce(1).mapInArrow(run, "classes binary, members binary, losses array<double>").collect()
    if not made:
        return []
    for name in ("classes", "members"):
        table = getattr(model, name)
        setattr(model, name, np.frombuffer(made[0][name], np.float32).reshape(table.shape).copy())
    return made[0]["losses"]


def frequent(counts: DataFrame, most: int) -> int:
    """A count that at most `most` tokens reach, from a histogram by logarithm."""
    bins = counts.groupBy(F.floor(F.log2("count") * 8).alias("bin")).count().orderBy(F.desc("bin")).collect()
    held, least = 0, None
    for row in bins:
        held += row["count"]
        if held > most:
            break
        least = row["bin"]
    return math.ceil(2 ** (least / 8) - 1e-9) if least is not None else 1 << 62


def vocabulary(counts: DataFrame, most_frequent: int = 150_000) -> Model:
    """The model before training, given the stored token counts of training texts.

    Up to `most_frequent` tokens, those above one count, go to every task with
    their counts; the rest is looked up by a join.
    """
    least = frequent(counts, most_frequent)
    top = counts.where(F.col("count") >= least).toPandas()
    top = top.sort_values(["count", "token"], ascending=[False, True])
    tokens = [bytes(t) for t in top.token]
    own = tokens[: BUCKETS - SHARED]
    # The tokens with a bucket of their own; their number is fixed.
    spark = counts.sparkSession
    named = spark.createDataFrame(list(zip(map(bytearray, own), range(len(own)))), "token binary, own int")
    shared = F.pmod(F.xxhash64(F.col("token")), F.lit(SHARED)) + (BUCKETS - SHARED)
    sizes = (
        counts.join(F.broadcast(named), "token", "left")
        .groupBy(F.coalesce("own", shared).cast("int").alias("bucket"))
        .agg(
            F.sum("count").alias("total"),
            F.count(F.lit(1)).alias("types"),
            F.sum(F.when(F.octet_length("token") == 0, F.col("count"))).alias("texts"),
        )
        .collect()
    )
    bucket_total, bucket_types = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for row in sizes:
        bucket_total[row["bucket"]], bucket_types[row["bucket"]] = row["total"], row["types"]
    total, types = int(bucket_total.sum()), int(bucket_types.sum())
    # A text has one end, the empty token.
    texts = sum(row["texts"] or 0 for row in sizes)
    model = Model(tokens, top["count"].to_numpy(np.int64), total, types, bucket_total, bucket_types, texts=texts)
    model.start()
    return model


def train(docs: DataFrame, counts: DataFrame, most_frequent: int = 150_000) -> Model:
    """The model of training texts, given their stored token counts.

    The weights are trained on every text, by steps on gradients that follow
    from counts that Spark sums over all of a slice.
    """
    model = vocabulary(counts, most_frequent)
    fit(places(docs, model, STEPS + 1), model)
    return model


def shares(model: Model, codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each token its bucket, and the natural logarithm of the bucket's share in its context."""
    target, last, skip = model.features(codes, starts)
    kind, member = np.divmod(target, MEMBERS)
    context = last.astype(np.int64) * CONTEXTS + skip
    found = model.class_logs[context, kind].astype(np.float64) - model.member_logs[kind, context]
    for rows in member_rows(kind, last, skip):
        found += model.members[rows, member]
    return target, found


def score_texts(model: Model, texts: list[str | None]) -> list:
    """Per text by buckets: tokens, known frequent ones, sums of logarithms, and the tokens left to look up."""
    codes, starts, tokens = model.read(texts)
    target, inside = shares(model, codes, starts)
    return [
        *common_sums(model, codes, starts),
        np.add.reduceat(inside / math.log(10) - model.log_bucket[target], starts),
        rare_tokens(codes, starts, tokens),
    ]


def common_sums(model: Model, codes: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
    """Per text its tokens, the frequent ones among them, and the sum of the logarithms of their counts."""
    return [
        np.diff(np.append(starts, len(codes))),
        np.add.reduceat((codes < RARE).astype(np.int64), starts),
        np.add.reduceat(model.log_count[np.minimum(codes, len(model.tokens))], starts),
    ]


def mixed(value: np.ndarray) -> np.ndarray:
    """64 well mixed bits of each 64-bit number, equal ones alike (splitmix64)."""
    value = value + np.uint64(0x9E3779B97F4A7C15)
    value = (value ^ value >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ value >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return value ^ value >> np.uint64(31)


def feature_keys(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Of each rare token a key, and of each run of tokens that is a feature, by its last place, one."""
    key = mixed(codes.astype(np.uint64))
    rare, found, before = key[codes >= RARE], [], codes
    for length in PRIOR:
        # The token one place further back; before a text stands its own sign.
        before = np.concatenate([[BEFORE], before[:-1]]).astype(np.int64)
        before[starts] = BEFORE
        key = mixed(key ^ mixed(before.astype(np.uint64) + np.uint64(length)) * np.uint64(length))
        found.append(key)
    return rare, found


def parted(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where each part begins among sorted keys, and their end; a part is a range of the keys' upper half."""
    of = (keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    return np.searchsorted(of, np.arange(parts + 1))


def feature_counts(placed: DataFrame, parts: int) -> DataFrame:
    """(batch, found): how often training texts hold the features of a batch, in the order of their keys.

    Features are dealt by key into `parts`, whose number follows the training
    tokens, so each holds about as many, and are told apart by the key's lower
    half there. Each batch sends a feature once, with its number in training
    texts, so that frequent ones crowd no part.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(f"{__name__} features")
        for batch in batches:
            for i in range(batch.num_rows):
                codes, starts, part = unpacked(batch, i)
                keys, where = wanted(codes, starts)
                learned = np.repeat(part >= 0, np.diff(np.append(starts, len(codes))))
                learned = np.concatenate([learned[codes >= RARE], *[learned] * len(PRIOR)])
                n = np.bincount(where, learned, len(keys)).astype(np.uint32)
                low, ends = (keys & np.uint64(0xFFFFFFFF)).astype(np.uint32), parted(keys, parts)
                met = np.flatnonzero(np.diff(ends))
                arrays = [
                    pa.array(met.astype(np.int32)),
                    pa.array([batch.column(0)[i].as_py()] * len(met), pa.int64()),
                    pa.array([low[ends[k] : ends[k + 1]].tobytes() for k in met], pa.binary()),
                    pa.array([packed(n[ends[k] : ends[k + 1]]) for k in met], pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "batch", "low", "n"])

    def count(table: pa.Table) -> pa.Table:
        low, n = [np.frombuffer(x.as_buffer(), np.uint32) for x in table["low"]], [loaded(x, np.uint32) for x in table["n"]]
        sizes = np.cumsum([len(x) for x in low])[:-1]
        keys, where = np.unique(np.concatenate(low), return_inverse=True)
        totals = np.bincount(where, np.concatenate(n), len(keys)).astype(np.uint32)
        found = pa.array([packed(x) for x in np.split(totals[where], sizes)], pa.binary())
        return pa.table({"part": table["part"], "batch": table["batch"], "found": found})

    sent = placed.select("batch", "starts", "parts", "codes").mapInArrow(run, "part int, batch long, low binary, n binary")
    counted = sent.groupBy("part").applyInArrow(count, "part int, batch long, found binary")
    parts_found = F.array_sort(F.collect_list(F.struct("part", "found")))
    return counted.groupBy("batch").agg(F.transform(parts_found, lambda x: x["found"]).alias("found"))


def wanted(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys of a batch, sorted, once each, and where each rare token's and each place's stand among them."""
    rare, runs = feature_keys(codes, starts)
    return np.unique(np.concatenate([rare, *runs]), return_inverse=True)


def token_logs(model: Model, codes: np.ndarray, starts: np.ndarray, found: np.ndarray) -> np.ndarray:
    """The log10 share of each token after those before it, given the numbers of its features in key order.

    A run's share is that of its count among all places of what stands before
    it, with the shorter run's share added as so many places. That is the
    maximum-entropy model nearest to the shorter runs' that gives the features
    their (smoothed) shares: features of one context exclude each other, so their
    weights follow from the counts in one step and shares add up to 1.
    """
    target, inside = shares(model, codes, starts)
    _, where = wanted(codes, starts)
    rare = codes >= RARE
    count = np.append(model.counts, 0)[np.minimum(codes, len(model.tokens))].astype(np.float64)
    each = found[where].astype(np.float64)
    count[rare], at = each[: rare.sum()], rare.sum()
    share = np.exp(inside) * (count + ALPHA) / 10 ** model.log_bucket[target]
    for prior in PRIOR.values():
        context = np.concatenate([[0], count[:-1]])
        context[starts] = model.texts
        count = each[at : at + len(codes)]
        at += len(codes)
        share = (count + prior * share) / (context + prior)
    return np.log10(share)


def kept_model(name: str, shared: Broadcast) -> Model:
    """The model with its tables, made once in a Python worker."""
    only(__name__)
    if name not in MODELS:
        MODELS.clear()
        MODELS[name] = shared.value.prepared().tabled()
    return MODELS[name]


def lm_scores(docs: DataFrame, folds: int = 10) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    Learns from rows whose crc32(id) modulo `folds` isn't 0. Tokens are words
    and one end, so a null or empty text is one token. The base score is that
    of unigrams with 0.1 added to each count. The model's: the log10 share of
    each token's class given the context (bucket of the last token, of the one
    before it, of both), of its bucket in the class, and of the token in its
    bucket by the same smoothed counts; all add up to 1. Repeated rows and ids
    give one row each; other columns are ignored, whatever their names; an
    empty table gives none, and without training rows all tokens are unknown.
    """
    held_out = crc_fold(F.col("doc_id"), folds) == 0
    counts = count_tokens(docs.select("doc_id", "text").where(~held_out))
    model = vocabulary(counts)
    # Row numbers hold once they are stored.
    placed = places(docs, model, STEPS + 1, folds)
    fit(placed, model)
    shared, name = docs.sparkSession.sparkContext.broadcast(model), uuid.uuid4().hex
    fields = [("n_tokens", pa.int64()), ("common", pa.int64()), ("log_common", pa.float64()), ("score", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = kept_model(name, shared)
        for batch in batches:
            for i in range(batch.num_rows):
                codes, starts, _ = unpacked(batch, i)
                ids, rows, found = (batch.column(batch.schema.get_field_index(n))[i].values for n in ("ids", "rows", "found"))
                logs = token_logs(own, codes, starts, np.concatenate([loaded(x, np.uint32) for x in found]))
                sums = [*common_sums(own, codes, starts), np.add.reduceat(logs, starts)]
                arrays = [ids, rows, *(pa.array(x, kind) for x, (_, kind) in zip(sums, fields))]
                yield pa.RecordBatch.from_arrays(arrays, names=["doc_id", "row", *(n for n, _ in fields)])

    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("row", T.LongType())])
    for field, kind in fields:
        schema.add(field, T.LongType() if kind == pa.int64() else T.DoubleType())
    features = feature_counts(placed, model.total // PART_TOKENS + 1)
    joined = placed.select("batch", "ids", "rows", "starts", "parts", "codes").join(features.hint("shuffle_hash"), "batch")
    scored = joined.mapInArrow(run, schema)
    looked_up = (
        placed.select(F.explode("rare").alias("r"))
        .select("r.row", "r.token", "r.n")
        .join(counts, "token", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("n") * F.log10(F.coalesce("count", F.lit(0)) + ALPHA)).alias("log_rare"),
            F.sum(F.when(F.col("count") > 0, F.col("n")).otherwise(0)).alias("known"),
        )
    )
    logs = F.col("log_common") + F.coalesce("log_rare", F.lit(0.0))
    return scored.join(looked_up, "row", "left").select(
        "doc_id",
        (crc_fold(F.col("doc_id"), folds) == 0).alias("held_out"),
        "n_tokens",
        (F.col("common") + F.coalesce("known", F.lit(0))).alias("n_known"),
        F.lit(model.total).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * math.log10(model.total + ALPHA * (model.types + 1))).alias("base_score"),
        "score",
    )
