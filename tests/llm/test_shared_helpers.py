import os

from pyspark.sql import functions as F

from cohortair.llm import collocations, common, decontaminate


def resident():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


def test_memory_of_the_operator_before_goes_back(monkeypatch):
    monkeypatch.setattr(common, "KEPT", {})
    table = {}
    common.keeps("before", table.clear)
    common.only("before")
    start = resident()
    table.update((i, bytes(4000)) for i in range(30_000))
    pinned = bytes(4000)  # lies above the table, so that the heap doesn't shrink by itself
    held = resident() - start
    common.only("after")
    assert not table and pinned is not None
    assert resident() - start < 0.3 * held


def test_only_letters_of_ascii_are_lowered(spark):
    texts = ["", "ABC xyz", "ÀÉ Straße ABC", "İIK K", "日本 ABC", None, "Z\x00@[`{A"]
    rows = spark.createDataFrame([(t,) for t in texts], "text string").select("text", common.ascii_lower(F.col("text")).alias("made"))
    upper = {ord(a): b for a, b in zip(common.UPPER, common.LOWER)}
    assert all(r.made == (None if r.text is None else r.text.translate(upper)) for r in rows.collect())
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "lower(" in plan


def test_word_classes_name_each_character_alone(spark):
    # Ranges in a class are tested one by one for every character.
    assert "-" not in decontaminate.WORD + decontaminate.ANY_WORD + collocations.PIECE
    text = "".join(map(chr, range(0x250))) + " é中文😀Az09"
    row = spark.createDataFrame([(text,)], "text string").select(
        decontaminate.words(F.col("text")).alias("words"),
        F.regexp_count("text", F.lit(decontaminate.ANY_WORD)).alias("n"),
    ).first()
    kept = [c if c.isdigit() and c < "\x80" or "a" <= c.lower() <= "z" or c >= "\x80" else " " for c in text]
    lowered = "".join(c.lower() if c < "\x80" else c for c in kept)
    assert row.words == [w for w in lowered.split(" ") if w] and row.n == len(row.words)


def test_counts_of_phrases_of_all_lengths(spark):
    docs = spark.createDataFrame([("en", "A b c. a b C a b c\va b")] * 10, "lang string, text string")
    frequent, totals = collocations.frequent_counts(docs, least=10)
    assert {(r.phrase, r.f) for r in frequent.collect()} == {
        ("a", 40), ("b", 40), ("c", 30), ("a b", 40), ("b c", 30), ("c a", 10), ("a b c", 30), ("b c a", 10), ("c a b", 10)
    }
    assert totals.first().n == 110
