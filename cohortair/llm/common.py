"""What the operators of this subpackage share: stored tables, row keys, Arrow maps over texts."""

from __future__ import annotations

import ctypes
import gc
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator, Sequence
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from cohortair.sources.tables import shared_folder

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
SHIPPED: dict[str, str] = {}
KEPT: dict[str, Callable[[], None]] = {}
KEPT_FOR: dict[str, str] = {}


def store(df: DataFrame, *by: str) -> DataFrame:
    """The rows as a table in the cluster's shared folder, in files of their own for each value of `by`.

    Cuts lineage: what follows reads files that outlive a lost executor.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}.parquet"
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Hands this package to the executors, once per application.

    Tasks of the Arrow maps import it; where it is installed there already,
    this changes nothing.
    """
    context = spark.sparkContext
    if SHIPPED.get("application") != context.applicationId:
        here = Path(__file__).resolve().parent.parent
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/{here.name}", "zip", here.parent, here.name)
        context.addPyFile(archive)
        SHIPPED["application"] = context.applicationId


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and nothing else (`lower` would also change other letters)."""
    # Where all characters are one byte long, `lower` changes A-Z alone, and much faster.
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def crc_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo folds; null ids count as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def keeps(owner: str, forget: Callable[[], None]) -> None:
    """Names what empties an operator's tables in a Python worker."""
    KEPT[owner] = forget


def only(owner: str) -> None:
    """Empties what other operators keep in this Python worker, which may outlive their stages.

    Where another operator worked before, what it took goes back to the
    system: the allocators would keep it, beside what this one takes.
    """
    for name, forget in KEPT.items():
        if name != owner:
            forget()
    if KEPT_FOR.get("owner") != owner:
        KEPT_FOR["owner"] = owner
        gc.collect()
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


def free_name(df: DataFrame, base: str) -> str:
    """A column name that the table doesn't have yet."""
    taken = {c.lower() for c in df.columns}
    while base in taken:
        base += "_"
    return base


def slices(texts: Sequence[str | None], max_chars: int) -> Iterator[tuple[int, int]]:
    """Bounds of runs of texts that hold up to max_chars, one text at least."""
    start, held = 0, 0
    for i, text in enumerate(texts):
        size = len(text) if text else 0
        if i > start and held + size > max_chars:
            yield start, i
            start, held = i, 0
        held += size
    if start < len(texts):
        yield start, len(texts)


def map_texts(
    df: DataFrame,
    keys: Sequence[str],
    fields: Sequence[T.StructField],
    function: Callable[[], Callable[[list[str | None]], Sequence]],
    max_chars: int = 8_000_000,
    text: str = "text",
) -> DataFrame:
    """One result row per row: the key columns as they are and what a function gives.

    `function` is called once per task and returns the one that turns a list of
    texts into one list or array per field. It gets whole texts, as many at a
    time as make up max_chars, so that memory does not depend on the batch.
    Keys, which may be all columns, pass through as Arrow columns, so null ids
    keep their type.
    """
    ship(df.sparkSession)
    narrow = df.select(*keys) if text in keys else df.select(*keys, text)
    where = narrow.columns.index(text)
    schema = T.StructType([*(narrow.schema[k] for k in keys), *fields])
    names = [f.name for f in schema.fields]
    types = [to_arrow_type(f.dataType) for f in fields]

    owner = function.__module__

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        only(owner)
        work = function()
        for batch in batches:
            for piece in range(0, batch.num_rows, 2000):
                part = batch.slice(piece, 2000)
                texts = part.column(where).to_pylist()
                for a, b in slices(texts, max_chars):
                    found = work(texts[a:b])
                    columns = [part.column(i).slice(a, b - a) for i in range(len(keys))]
                    columns += [
                        x if isinstance(x, pa.Array) else pa.array(x, type=kind)
                        for x, kind in zip(found, types, strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=names)

    return narrow.mapInArrow(run, schema)
