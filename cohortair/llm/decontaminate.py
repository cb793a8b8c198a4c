"""Benchmark decontamination: word windows of the benchmark found in documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortair.llm.common import ascii_lower, free_name
from cohortair.operators.joins import BROADCAST_BYTES, broadcast_if_small

# Words are runs of digits, lower-case letters and whatever is not ASCII.
# Each character is named alone: Java tests those by one table, ranges one by one.
WORD = "[^" + "".join(f"\\x{c:02X}" for c in (*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80))) + "]+"
# The same in a text whose A-Z are not lowered yet, and what stands between words.
OTHERS = (*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80))
ANY_WORD = "[^" + "".join(f"\\x{c:02X}" for c in OTHERS) + "]+"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words(text: Column) -> Column:
    """Words of a text with A-Z lowered; null has none."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def windows(items: DataFrame, length: int) -> DataFrame:
    """(window, size, key, items): the distinct word windows of benchmark items.

    A shorter item is one window, an item without words none. `items` holds the
    ids as text of all items with the window; items without an id mark words
    but are not named.
    """
    n = F.size("words")
    starts = F.sequence(F.lit(0), F.greatest(n - length, F.lit(0)))
    each = (
        items.select(F.col("item_id").cast("string").alias("item"), words(F.col("text")).alias("words"))
        .where(n > 0)
        .select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i + 1, length))).alias("window"))
    )
    return (
        each.groupBy("window")
        .agg(F.collect_set("item").alias("items"))
        .select("window", F.size("window").alias("size"), F.xxhash64("window").alias("key"), "items")
    )


def small(found: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether the windows, measured now, can be sent to every executor."""
    width = F.octet_length(F.array_join("window", " ")) + 16 * F.col("size")
    width = width + F.octet_length(F.array_join("items", " ")) + 16 * F.size("items") + 64
    return (found.agg(F.sum(width.cast("long"))).first()[0] or 0) <= max_bytes


def hits(docs: DataFrame, items: DataFrame, length: int = 10, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """(doc_id, text_hash, spans, items) of texts that hold a window of the benchmark.

    Every start of every document meets the hash set of windows and is checked
    word by word. `spans` are the merged runs of hit words (first, and the one
    after the last), `items` the ids with occurring windows. Hits of a text come
    from one task, so they are gathered before the shuffle. Sizes of windows
    reach the driver, `length` numbers at most; windows over `max_bytes` are
    joined by shuffling starts instead.
    """
    found = windows(items, length)
    sizes = sorted(r[0] for r in found.select("size").distinct().collect())
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("words"))
    starts = (
        texts.select("*", F.explode(F.array(*map(F.lit, sizes)).cast("array<int>")).alias("size"))
        .where(F.size("words") >= F.col("size"))
        .select("*", F.explode(F.sequence(F.lit(0), F.size("words") - F.col("size"))).alias("start"))
        .select("doc_id", "text_hash", "start", F.expr("slice(words, start + 1, size)").alias("seen"))
        .withColumn("key", F.xxhash64("seen"))
    )
    met = starts.join(
        broadcast_if_small(found, small=small(found, max_bytes)),
        (starts.key == found.key) & (starts.seen == found.window),
    )
    spans = F.aggregate(
        F.array_sort(F.collect_set(F.struct("start", (F.col("start") + F.col("size")).alias("end")))),
        F.expr("cast(array() as array<struct<start:int,end:int>>)"),
        lambda done, x: F.when(
            (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] >= x["start"]),
            F.concat(
                F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))),
                F.array(
                    F.struct(
                        F.try_element_at(done, F.lit(-1))["start"].alias("start"),
                        F.greatest(F.try_element_at(done, F.lit(-1))["end"], x["end"]).alias("end"),
                    )
                ),
            ),
        ).otherwise(F.concat(done, F.array(x))),
    )
    return met.groupBy("doc_id", "text_hash").agg(
        spans.alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )


def contamination(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated of every row.

    Null and blank texts have no words; an empty benchmark hits nothing.
    Repeated rows and ids give one row each, rows with one id and other texts
    their own results. Other columns are ignored, whatever their names.
    """
    found = hits(docs, items, length)
    each = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(ANY_WORD)).cast("long").alias("n_words"),
    )
    same = each.doc_id.eqNullSafe(found.doc_id) & (each.text_hash == found.text_hash)
    hit = F.expr("aggregate(spans, 0L, (n, s) -> n + s.end - s.start)")
    none = F.array().cast("array<string>")
    return each.join(found, same, "left").select(
        each.doc_id,
        "n_words",
        F.coalesce(hit, F.lit(0).cast("long")).alias("n_hit"),
        F.size(F.coalesce("items", none)).cast("long").alias("n_items"),
        F.sha2(F.array_join(F.coalesce("items", none), ",").cast("binary"), 256).alias("items_sha256"),
        F.coalesce(hit > 0, F.lit(False)).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """The rows without any hit word, all columns as they are."""
    hashed = free_name(docs, "text_hash")
    rows = docs.withColumn(hashed, F.xxhash64("text"))
    found = broadcast_if_small(hits(docs, items, length).select("doc_id", "text_hash"))
    same = rows.doc_id.eqNullSafe(found.doc_id) & (rows[hashed] == found.text_hash)
    return rows.join(found, same, "left_anti").drop(hashed)


def remove_spans(docs: DataFrame, items: DataFrame, length: int = 10) -> DataFrame:
    """All rows, hit words cut out of their texts; what stands between words stays."""
    hashed = free_name(docs, "text_hash")
    rows = docs.withColumn(hashed, F.xxhash64("text"))
    found = hits(docs, items, length).select(F.col("doc_id").alias("hit_id"), "text_hash", "spans")
    found = found.select(F.struct("*").alias("hit"))
    found = broadcast_if_small(found, small=False)
    joined = rows.join(found, rows.doc_id.eqNullSafe(F.col("hit.hit_id")) & (rows[hashed] == F.col("hit.text_hash")), "left")
    # Words and what lies between them take turns.
    pieces = F.regexp_extract_all("text", F.lit(f"{ANY_WORD}|{BETWEEN}"), F.lit(0))
    first = F.when(F.col("text").rlike(f"^{BETWEEN}"), 1).otherwise(0)

    def stays(piece, i):
        word = F.floor((i - first) / 2).cast("int")
        return ((i - first) % 2 != 0) | ~F.exists("hit.spans", lambda s: (word >= s["start"]) & (word < s["end"]))

    cut = F.when(F.col("hit").isNull(), F.col("text")).otherwise(F.array_join(F.filter(pieces, stays), ""))
    return joined.withColumn("text", cut).select(*docs.columns)
