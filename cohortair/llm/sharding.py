"""Shards of bounded size by extendible hashing of document ids."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortair.llm.common import store
from cohortair.operators.joins import broadcast_if_small

BITS = 60
SLACK = 5


def _bits(value: Column) -> Column:
    """60 hash bits as text of 0 and 1."""
    return F.lpad(F.conv(F.substring(F.md5(value.cast("binary")), 1, BITS // 4), 16, 2), BITS, "0")


def hash_bits(docs: DataFrame, depth: int) -> Column:
    """Bits of the id, then those of the text; depth tells how many are needed."""
    bits = _bits(F.coalesce(docs["doc_id"].cast("string"), F.lit("")))
    if depth > BITS:
        bits = F.concat(bits, _bits(F.coalesce(docs["text"], F.lit(""))))
    return bits


def directory(docs: DataFrame, limit: int) -> list[tuple[int, DataFrame]]:
    """The hash directory: (depth, entries) by rounds.

    Entries (leaf, shard, shard_bytes, shard_rows) lead from the first `depth`
    bits to the shard: the shortest prefix whose rows fit the limit or are one
    row. Bytes are summed once per leaf, and leaves are summed up per prefix,
    so only the first round reads all texts' lengths; a further round splits
    only leaves that are still too large. Three numbers a round reach the driver.
    """
    sized = F.octet_length(F.coalesce("text", F.lit(""))).cast("long")
    total = docs.agg(F.sum(sized)).first()[0] or 0
    depth = min(2 * BITS, max(0, math.ceil(math.log2(max(1.0, total / limit)))) + SLACK)
    low, rounds, pending = 0, [], docs
    while True:
        leaves = store(
            pending.select(F.substring(hash_bits(pending, depth), 1, depth).alias("leaf"), sized.alias("bytes"))
            .groupBy("leaf")
            .agg(F.sum("bytes").alias("bytes"), F.count(F.lit(1)).alias("rows"))
        )
        levels = leaves.select(
            "leaf", "bytes", "rows", F.explode(F.sequence(F.lit(low), F.lit(depth))).alias("deep")
        ).select("*", F.expr("substring(leaf, 1, deep)").alias("shard"))
        last = F.lit(depth == 2 * BITS) & (F.col("deep") == depth)
        fit = (
            levels.groupBy("deep", "shard")
            .agg(F.sum("bytes").alias("shard_bytes"), F.sum("rows").alias("shard_rows"))
            .where((F.col("shard_bytes") <= limit) | (F.col("shard_rows") == 1) | last)
        )
        entries = store(
            levels.select("leaf", "deep", "shard")
            .join(fit, ["deep", "shard"])
            .groupBy("leaf")
            .agg(F.min(F.struct("deep", "shard", "shard_bytes", "shard_rows")).alias("first"))
            .select("leaf", "first.shard", "first.shard_bytes", "first.shard_rows")
        )
        rounds.append((depth, entries))
        rest = leaves.join(entries, "leaf", "left_anti").select("leaf")
        if rest.isEmpty():
            return rounds
        leaf = F.substring(hash_bits(docs, depth), 1, depth)
        pending = docs.select("doc_id", "text").join(broadcast_if_small(rest), leaf == rest.leaf, "left_semi")
        low, depth = depth + 1, min(2 * BITS, depth + SLACK)


def shards(docs: DataFrame, limit: int) -> DataFrame:
    """doc_id, shard, shard_bits, shard_bytes, shard_rows of every row.

    The shard is the hash prefix, as text of 0 and 1, that holds the row; bytes
    are those of texts in UTF-8, null is an empty text. Every shard fits the
    limit but those of a single longer text and of rows that repeat both id
    and text, which no hash tells apart. Rows with one id (or none) are split
    by their texts. Other columns are ignored; an empty table gives no rows.
    """
    rounds = directory(docs, limit)
    rows = docs.select("doc_id", "text")
    keys = rows.select("doc_id", *(
        F.substring(hash_bits(rows, depth), 1, depth).alias(f"leaf_{i}") for i, (depth, _) in enumerate(rounds)
    ))
    for i, (_, entries) in enumerate(rounds):
        found = entries.select(
            F.col("leaf").alias(f"leaf_{i}"), F.struct("shard", "shard_bytes", "shard_rows").alias(f"found_{i}")
        )
        keys = keys.join(broadcast_if_small(found), f"leaf_{i}", "left")
    keys = keys.select("doc_id", F.coalesce(*(F.col(f"found_{i}") for i in range(len(rounds)))).alias("found"))
    return keys.select(
        "doc_id",
        "found.shard",
        F.length("found.shard").alias("shard_bits"),
        "found.shard_bytes",
        "found.shard_rows",
    )
