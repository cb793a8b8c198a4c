"""Small tables for the tests of the training-data operators."""

import os
import random

import duckdb

FOLDER = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "key string, bits string, words string, row string, score string, start string, leaf string, text_hash string"
)
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one"),
    (5, "Two words"),
    (None, "no id here at all but some words"),
    (None, None),
    (6, "Licensed under the Apache License, Version 2.0.\nand more gnu general public license words"),
    (7, "cc by cc by mit license\nAll rights reserved"),
    (8, "ÉTÉ été Straße 中文字 😀😀 it's we'll don't <|endoftext|> x\x00y ▁▁ a  b"),
    (9, "same text twice in the table, word for word"),
    (9, "same text twice in the table, word for word"),
    (9, "same id with another text of its own"),
    (10, "same text twice in the table, word for word"),
    (11, "z" * 3000),
    (12, " ".join(f"long{i % 900}" for i in range(4000))),
    (13, "!!! ??? ... ###"),
    (14, "RELEASED under the MIT license by nobody"),
]


def docs(spark, pairs=ODD):
    """Documents with columns whose names operators might use themselves."""
    rows = [(i, t, "en" if t else None, "s", 0, *["x"] * 8) for i, t in pairs]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def items(spark, pairs):
    return spark.createDataFrame(pairs, "item_id long, text string")


def corpus(limit=None):
    """(doc_id, text, lang) of the smallest bundled table."""
    file = os.path.join(FOLDER, "documents.parquet")
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{file}' ORDER BY doc_id").fetchall()[:limit]


def babble(seed, count, letters="  \n\t'srtmdvlae'éTH12!.,-中 　😀\x00"):
    pick = random.Random(seed)
    return ["".join(pick.choice(letters) for _ in range(pick.randint(0, 40))) for _ in range(count)]


def found(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=lambda r: tuple(map(str, r)))
