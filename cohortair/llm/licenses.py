"""License scans: phrases, and an exact set-similarity join with notice templates."""

from __future__ import annotations

import math
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortair.llm.common import ascii_lower, store
from cohortair.llm.decontaminate import WORD


class Notice(NamedTuple):
    label: str
    text: str


# Phrases that give a label wherever they stand.
PHRASES = (
    Notice("gpl", "gnu general public license"),
    Notice("apache", "apache license"),
    Notice("cc-by", "cc by"),
    Notice("mit", "mit license"),
)
# Opening words of well-known notices, by label.
TEMPLATES = (
    Notice("gpl", "this work is licensed under the gnu general public license version 3"),
    Notice("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    Notice("apache", "licensed under the apache license version 2 0"),
    Notice("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    Notice("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    Notice("cc-by-nc", "licensed under cc by nc 4 0"),
    Notice("mit", "released under the mit license"),
    Notice("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Notice("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    Notice("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    Notice("all-rights-reserved", "all rights reserved"),
)
CONTAINMENT = 0.8


def _strings(values: Sequence[str]) -> Column:
    return F.array(*map(F.lit, values)).cast("array<string>")


def _places(phrase: Notice, words: Column) -> Column:
    """Starts of a phrase among the words of a text."""
    parts = phrase.text.split(" ")
    last = F.size(words) - len(parts)
    starts = F.filter(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: (i <= last) & (F.slice(words, i + 1, len(parts)) == _strings(parts)),
    )
    # Few texts hold a phrase at all; a search of the joined words tells which.
    there = F.contains(F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")), F.lit(f" {phrase.text} "))
    return F.when(there, starts).otherwise(F.array().cast("array<int>"))


def scanned(docs: DataFrame, phrases: Sequence[Notice], tokens: Sequence[str], longest: int) -> DataFrame:
    """One stored row per row: n_words, starts of each phrase, blocks and stretches.

    A block is a line, reduced to the distinct words that any template has:
    others can't count towards a template. Lines without such words are left out.
    A stretch is the same of 2 * longest words of the text, whatever its line
    breaks, with their places; one begins at every longest-th word, so that each
    run of up to `longest` words lies in one.
    """
    lines = F.split(ascii_lower(F.coalesce("text", F.lit(""))), "\n")
    worded = docs.select(
        "doc_id", F.transform(lines, lambda x: F.regexp_extract_all(x, F.lit(WORD), F.lit(0))).alias("lines")
    )
    worded = worded.select("doc_id", "lines", F.flatten("lines").alias("words"))
    blocks = F.filter(
        F.transform("lines", lambda x: F.array_distinct(F.filter(x, lambda w: w.isin(list(tokens))))),
        lambda x: F.size(x) > 0,
    )
    # Words that no template has are empty, so that each word is looked up once.
    marked = F.transform("words", lambda w: F.when(w.isin(list(tokens)), w).otherwise(""))
    worded = worded.withColumn("marked", marked)
    stretches = F.filter(
        F.transform(
            F.sequence(F.lit(0), F.floor((F.size("marked") - 1) / longest).cast("int")),
            lambda k: F.filter(
                F.transform(
                    F.slice("marked", k * longest + 1, 2 * longest),
                    lambda w, i: F.struct(i.alias("place"), w.alias("word")),
                ),
                lambda x: x["word"] != "",
            ),
        ),
        lambda x: F.size(x) > 0,
    )
    empty = F.array().cast("array<array<struct<place:int,word:string>>>")
    return store(
        worded.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            F.size("words").cast("long").alias("n_words"),
            *(_places(p, F.col("words")).alias(f"at_{i}") for i, p in enumerate(phrases)),
            blocks.alias("blocks"),
            F.when(F.size("marked") > 0, stretches).otherwise(empty).alias("stretches"),
        )
    )


def matches(rows: DataFrame, templates: Sequence[Notice], containment: float) -> DataFrame:
    """(row, label, score) of every line, and every run of words as long as a
    template, that holds enough of the template's words.

    Tokens stand in order of their frequency over all lines, rare ones first.
    A line with the needed overlap shares a token with the prefix of the
    template (length filter: it has that many tokens; positional filter: what
    follows the shared token can still add up). Pairs that pass are counted in
    full, so the result is exact. A run is looked for in the stretches that
    pass: its words are among theirs. The score is that of the run of a stretch
    that holds most.
    """
    spark = rows.sparkSession
    known = sorted({w for t in templates for w in t.text.split(" ")})
    counted = rows.select(F.explode(F.flatten("blocks")).alias("token")).groupBy("token").count()
    # One number per template word.
    often = {r["token"]: r["count"] for r in counted.collect()}
    order = sorted(known, key=lambda w: (often.get(w, 0), w))
    place = {w: i for i, w in enumerate(order)}
    prefixes, needs = [], []
    for template in templates:
        parts = template.text.split(" ")
        tokens = sorted(set(parts), key=place.__getitem__)
        need = max(1, math.ceil(containment * len(tokens) - 1e-9))
        needs.append(need)
        for i, token in enumerate(tokens[: len(tokens) - need + 1]):
            prefixes.append((token, template.label, i, len(tokens), need, tokens, len(parts)))
    if not prefixes:
        return spark.createDataFrame([], "row long, label string, score double")
    index = spark.createDataFrame(
        prefixes, "token string, label string, t_at int, t_size int, need int, tokens array<string>, length int"
    )
    least = min(needs)

    def met(found: DataFrame, *keep: str) -> DataFrame:
        """Pairs of a template and a set of words that pass the filters, with their overlap."""
        sized = (
            found.select("row", *keep, F.array_intersect(_strings(order), F.col("found")).alias("block"))
            .withColumn("size", F.size("block"))
            .where(F.col("size") >= least)
            .select("*", F.posexplode(F.slice("block", F.lit(1), F.col("size") - (least - 1))).alias("at", "token"))
        )
        # The index has a row per prefix token of a template: its size is that of a parameter.
        near = sized.join(F.broadcast(index), "token").where(
            (F.col("size") >= F.col("need"))
            & (F.col("at") <= F.col("size") - F.col("need"))
            & (F.least(F.col("size") - F.col("at"), F.col("t_size") - F.col("t_at")) >= F.col("need"))
        )
        return near.withColumn("overlap", F.size(F.array_intersect("block", "tokens"))).where("overlap >= need")

    def scores(pairs: DataFrame) -> DataFrame:
        return pairs.select("row", "label", (F.col("overlap") / F.col("t_size")).cast("double").alias("score"))

    lines = met(rows.select("row", F.explode("blocks").alias("found")))
    stretches = rows.select("row", F.explode("stretches").alias("stretch"))
    words = F.array_distinct(F.transform("stretch", lambda x: x["word"]))
    held = F.filter("stretch", lambda x: F.array_contains("tokens", x["word"]))

    def within(first: Column) -> Column:
        """Distinct template words of the run that begins at a word of the template."""
        run = F.filter(
            "held",
            lambda x: (x["place"] >= first["place"]) & (x["place"] < first["place"] + F.col("length")),
        )
        return F.size(F.array_distinct(F.transform(run, lambda x: x["word"])))

    # A run that holds enough can begin at the first of its template words.
    runs = (
        met(stretches.withColumn("found", words), "stretch")
        .withColumn("held", held)
        .withColumn("overlap", F.array_max(F.transform("held", within)))
        .where("overlap >= need")
    )
    return scores(lines).unionByName(scores(runs))


def license_scan(
    docs: DataFrame,
    phrases: Sequence[Notice] = PHRASES,
    templates: Sequence[Notice] = TEMPLATES,
    containment: float = CONTAINMENT,
) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score of every row.

    Base places are those where a phrase's words stand one after another;
    labels add those of templates of whose distinct words a line, or a run of
    as many words as the template has, holds the share `containment`. Runs go on
    over line breaks, so a wrapped notice is found. The score is 1 where a phrase
    stands, else the highest such share, else 0. Null is an empty text, which has no words or labels.
    Repeated rows and ids give one row each; other columns are ignored,
    whatever their names; an empty table gives none.
    """
    tokens = sorted({w for t in templates for w in t.text.split(" ")})
    longest = max((len(t.text.split(" ")) for t in templates), default=1)
    rows = scanned(docs, phrases, tokens, longest)
    found = (
        matches(rows, templates, containment)
        .groupBy("row")
        .agg(F.collect_set("label").alias("more"), F.max("score").alias("best"))
    )
    at = [F.col(f"at_{i}") for i in range(len(phrases))]
    starts = F.concat(*at)
    none = F.array().cast("array<string>")
    base = F.array_sort(
        F.array_distinct(
            F.concat(*(F.when(F.size(a) > 0, _strings([p.label])).otherwise(none) for a, p in zip(at, phrases)))
        )
    )
    every = F.array_sort(F.array_union(base, F.coalesce("more", none)))
    return rows.join(found, "row", "left").select(
        "doc_id",
        "n_words",
        F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"),
        F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(base, ",").alias("base_labels"),
        F.array_join(every, ",").alias("labels"),
        F.when(F.size(starts) > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
