"""Phrase collocation mining over count streams.

Every word position of a piece starts up to three phrases (1, 2, 3 words);
their counts per language form one stream of (lang, phrase, f), counted
level by level so that only phrases whose parts are frequent are counted. Left, right
and extension counts come from equality joins of that stream with itself,
keyed on the ids of the candidate's two parts one word shorter: where these
don't measure small, Spark plans sort-merge joins (both sides sorted on the key
and read in lockstep), the external layout that needs no table of all phrases
in memory. Only phrases seen at least `least` times can be a candidate or one of
its parts (a part occurs at least as often as the whole), so the joins run on
the frequent stream alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortair.llm.common import ascii_lower, store
from cohortair.operators.joins import broadcast_if_small, fits_broadcast

# Fixed values of the contract: piece bounds and word characters.
PIECE = "[.,;:!?\\x0A\\x0B\\x0C\\x0D]"
WORD = "[^\\x20\\x09]+"
LONGEST, LEAST, TOP, SPREAD = 3, 10, 2000, 256
# Rows that name phrases are wider than those that look them up.
NAMED_BYTES = 16 * 1024 * 1024
EXACT = "decimal(38,0)"


def words_of(piece: Column) -> Column:
    """The words of a piece: runs of characters other than space and tab."""
    return F.array_remove(F.split(piece, "[\\x20\\x09]+"), "")


def phrases(words: Column, longest: int = LONGEST) -> Column:
    """All phrases of 1 to `longest` consecutive words of one piece, space-joined.

    Phrases of k words are those of k - 1 words zipped with the words k - 1
    places on, each array cut to the number of places where k words fit.
    """
    found, last = [words], words
    for k in range(2, longest + 1):
        fits = F.greatest(F.size(words) - (k - 1), F.lit(0))
        last = F.zip_with(F.slice(last, 1, fits), F.slice(words, k, fits), lambda a, b: F.concat_ws(" ", a, b))
        found.append(last)
    return F.concat(*found)


def counts(docs: DataFrame, longest: int = LONGEST) -> DataFrame:
    """(lang, phrase, words, f): every phrase's count per language; null lang is `und`.

    Counted by one grouping, combined in each task before the shuffle, so a
    frequent phrase or a language with a third of all rows is summed where it
    lies and shuffled as one row per task.
    """
    lang = F.coalesce(F.col("lang"), F.lit("und")).alias("lang")
    pieces = docs.select(lang, F.explode(F.split(ascii_lower(F.coalesce("text", F.lit(""))), PIECE)).alias("piece"))
    found = pieces.select("lang", F.explode(phrases(words_of(F.col("piece")), longest)).alias("phrase"))
    return found.groupBy("lang", "phrase").agg(F.count(F.lit(1)).alias("f")).withColumn(
        "words", F.size(F.split("phrase", " "))
    )


def frequent_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST) -> tuple[DataFrame, DataFrame]:
    """lang, phrase, words, f and parts of every phrase seen at least `least` times, and (lang, n) word totals.

    Level by level: words are counted, then phrases of k words only where
    both their phrases of k - 1 words (first and last) were frequent, since a
    phrase occurs no more often than its parts. The parts are looked up by a
    join before the shuffle, a broadcast where the frequent set of the
    level before measures small; so only phrases that can be frequent are
    shuffled, and each is counted over all its occurrences, exactly.

    A phrase has an id among those of its length. It is counted by the ids of
    its parts, `head` and `tail` (null for words), and named once counted.
    `firsts` and `lasts` are the counts of its first and of its last 1, 2, ...
    words, up to one word less than the phrase.
    """
    lang = F.coalesce(F.col("lang"), F.lit("und")).alias("lang")
    # In the outer form, as Spark makes each array twice for the other one, to filter by its size.
    text = F.replace(ascii_lower(F.coalesce("text", F.lit(""))), F.lit("\t"), F.lit(" "))
    pieces = docs.select(lang, F.explode_outer(F.split(text, PIECE)).alias("piece")).where(F.col("piece") != "")
    # Split once, at a plain space, as a regex is compiled for every piece, and stored for all levels.
    lines = store(pieces.select("lang", F.array_remove(F.split("piece", " "), "").alias("w")))
    # All words are stored, so that the totals need no other pass.
    words = store(
        lines.select("lang", F.explode("w").alias("phrase")).groupBy("lang", "phrase")
        .agg(F.count(F.lit(1)).alias("f")).withColumn("id", F.monotonically_increasing_id())
    )
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    none = F.lit(None).cast("long")
    bare = F.array().cast("array<long>")
    level = words.where(F.col("f") >= least).select(
        "lang", "phrase", "f", "id", none.alias("head"), none.alias("tail"), bare.alias("firsts"), bare.alias("lasts")
    )
    found = [level.withColumn("words", F.lit(1))]
    for k in range(2, longest + 1):
        each = [F.col("w0"), *(F.get("w", F.col("i") + j) for j in range(1, k))]
        grams = lines.where(F.size("w") >= k).select("lang", "w", F.posexplode("w").alias("i", "w0"))
        grams = grams.where(F.col("i") <= F.size("w") - k)
        ends = {"first": each[:-1], "last": each[1:]}
        grams = grams.select(
            "lang", *((F.concat_ws(" ", *e) if k > 2 else e[0]).alias(n) for n, e in ends.items())
        )
        parts = level.select("lang", "phrase", "id")
        if fits_broadcast(parts.select("lang", "phrase")):
            parts = F.broadcast(parts)
        counted = (
            grams.join(parts.toDF("lang", "first", "head"), ["lang", "first"])
            .join(parts.toDF("lang", "last", "tail"), ["lang", "last"])
            .groupBy("head", "tail").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") >= least)
        )
        heads = level.select(
            "lang", F.col("phrase").alias("first"), F.col("id").alias("head"),
            F.concat("firsts", F.array("f")).alias("firsts"),
        )
        tails = level.select(
            F.substring_index("phrase", " ", -1).alias("last"), F.col("id").alias("tail"),
            F.concat("lasts", F.array("f")).alias("lasts"),
        )
        named = counted.join(broadcast_if_small(heads, NAMED_BYTES), "head").join(
            broadcast_if_small(tails, NAMED_BYTES), "tail"
        )
        level = store(
            named.select(
                "lang", F.concat_ws(" ", "first", "last").alias("phrase"), "f",
                F.monotonically_increasing_id().alias("id"), "head", "tail", "firsts", "lasts",
            )
        )
        found.append(level.withColumn("words", F.lit(k)))
    frequent = found[0]
    for more in found[1:]:
        frequent = frequent.unionByName(more)
    return frequent, totals


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, longest: int = LONGEST, spread: int = SPREAD
) -> DataFrame:
    """The `top` phrases of 2 to `longest` words of each language by association score.

    a = f(phrase) >= least; each cut after k words gives l = f(first part),
    r = f(rest) and score floor(1e6 a^2 / (l r)), exact in decimals (the
    score is at most 1e6, as l, r >= a); the lowest cut counts, ties to the
    smallest k. A candidate lying contiguously inside a longer candidate with
    2 f(longer) >= a is dropped. Order: score desc, a desc, phrase asc (UTF-8
    bytes). Returns lang, rank (from 1), phrase, a, l, r, n (all word
    occurrences of the language), score, k. Null or empty texts add no words;
    a language without candidates has no rows; repeated rows count each time;
    other columns of `docs` are not carried.

    The top list is taken in two steps: the best `top` of each of `spread`
    slices of a language (by a hash of the phrase), then the best `top` of
    those, so no task sorts all candidates of a language.
    """
    frequent, totals = frequent_counts(docs.select("lang", "text"), least, longest)
    candidates = frequent.where(F.col("words") >= 2).withColumnRenamed("f", "a")

    # Every cut's score; cuts that the phrase is too short for are null and are passed over.
    cuts = []
    for k in range(1, max(longest, 2)):
        left, right = F.get("firsts", F.lit(k - 1)), F.get("lasts", F.col("words") - (k + 1))
        score = F.expr(f"cast(a as {EXACT}) * cast(a as {EXACT}) * 1000000 div (cast(l as {EXACT}) * cast(r as {EXACT}))")
        candidates = candidates.withColumns({"l": left, "r": right})
        candidates = candidates.withColumn(
            f"_cut{k}",
            F.when(F.col("words") > k, F.struct(score.alias("score"), F.lit(k).alias("k"), F.col("l"), F.col("r"))),
        )
        cuts.append(f"_cut{k}")
    best = candidates.withColumn("b", F.array_min(F.array(*cuts)))

    # Extensions: each longer candidate names its two sub-phrases one word shorter.
    inside = F.array(
        F.struct(F.col("head").alias("id"), F.element_at("firsts", -1).alias("inner")),
        F.struct(F.col("tail").alias("id"), F.element_at("lasts", -1).alias("inner")),
    )
    covered = (
        candidates.where(F.col("words") >= 3).select((F.col("words") - 1).alias("words"), "a", F.inline(inside))
        .where(F.lit(100) * F.col("a") >= F.lit(50) * F.col("inner"))
    )
    kept = best.join(covered.select("words", "id"), ["words", "id"], "left_anti")

    ranked = kept.select(
        "lang", "phrase", "a", "b.l", "b.r", "b.k", F.col("b.score").cast("long").alias("score")
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    slice_of = F.pmod(F.xxhash64("phrase"), F.lit(spread))
    first = ranked.withColumn("_n", F.row_number().over(Window.partitionBy("lang", slice_of).orderBy(*order)))
    short = first.where(F.col("_n") <= top).drop("_n")
    final = short.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return final.where(F.col("rank") <= top).join(totals, "lang").select(
        "lang",
        F.col("rank").cast("long").alias("rank"),
        "phrase",
        F.col("a").cast("long").alias("a"),
        F.col("l").cast("long").alias("l"),
        F.col("r").cast("long").alias("r"),
        F.col("n").cast("long").alias("n"),
        "score",
        F.col("k").cast("long").alias("k"),
    )
