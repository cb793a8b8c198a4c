import duckdb
import pytest
from llm_samples import FOLDER, ODD, docs, found, items

from cohortair.llm import decontaminate, licenses, sharding, sql

BENCH = [
    (1, "one two three four five six seven eight nine ten eleven twelve"),
    (2, "short item"),
    (2, "short item"),
    (10, "SHORT item"),
    (3, ""),
    (4, None),
    (None, "nobody owns this"),
    (5, "two three four five six seven eight nine ten eleven"),
]
TEXTS = [
    *ODD,
    (20, "x one Two three four, five six seven eight nine ten eleven twelve y short-item"),
    (21, "nobody owns this short item short item"),
    (22, "one two three four five six seven eight nine"),
    (23, "short short item item"),
]


def oracle(text, **tables):
    con = duckdb.connect()
    for name, rows in tables.items():
        kind = "doc_id BIGINT" if name == "documents" else "item_id BIGINT"
        con.execute(f"CREATE TABLE {name} ({kind}, text VARCHAR)")
        if rows:
            con.executemany(f"INSERT INTO {name} VALUES (?, ?)", rows)
    made = con.sql(text)
    return made.columns, sorted(made.fetchall(), key=lambda r: tuple(map(str, r)))


@pytest.mark.parametrize("length", [1, 3, 10])
def test_decontamination_equals_all_windows(spark, length):
    columns, expected = oracle(sql.contamination(length), documents=TEXTS, benchmark=BENCH)
    table, bench = docs(spark, TEXTS), items(spark, BENCH)
    assert found(decontaminate.contamination(table, bench, length), *columns) == expected
    clean = decontaminate.remove_documents(table, bench, length)
    assert clean.columns == table.columns
    assert clean.count() == sum(not r[columns.index("contaminated")] for r in expected)


def test_windows_too_large_to_send_are_joined_by_shuffling(spark):
    table, bench = docs(spark, TEXTS), items(spark, BENCH)
    names = ("doc_id", "spans", "items")
    assert found(decontaminate.hits(table, bench, 10, 0), *names) == found(decontaminate.hits(table, bench, 10), *names)


def test_spans_are_cut_out(spark):
    table = docs(spark, [(1, "A short item, and more"), (2, "clean"), (3, None), (4, "-short item")])
    made = decontaminate.remove_spans(table, items(spark, BENCH), 10)
    assert made.columns == table.columns
    assert found(made, "doc_id", "text") == [(1, "A  , and more"), (2, "clean"), (3, None), (4, "- ")]


def test_decontamination_without_rows(spark):
    none, bench = docs(spark).limit(0), items(spark, BENCH)
    assert decontaminate.contamination(none, bench).count() == 0
    made = decontaminate.contamination(docs(spark), items(spark, []))
    assert made.count() == len(ODD) and made.where("contaminated").count() == 0


@pytest.mark.parametrize("containment", [0.5, 0.8, 1.0])
def test_licenses_equal_all_templates_on_all_lines(spark, containment):
    columns, expected = oracle(sql.licenses(containment), documents=TEXTS)
    made = licenses.license_scan(docs(spark, TEXTS), containment=containment)
    assert found(made, *columns) == expected
    assert licenses.license_scan(docs(spark).limit(0)).count() == 0


@pytest.mark.parametrize("limit", [100, 4000, 60000, 10**7])
def test_shards_equal_all_prefixes(spark, limit):
    # Rows that share an id are told apart by bits that the text has not got here.
    rows = [(i, t) for i, t in TEXTS if i != 9 and i is not None] + [(100 + i, "a" * (i * 37 % 900)) for i in range(80)]
    columns, expected = oracle(sql.shards(limit), documents=rows)
    assert found(sharding.shards(docs(spark, rows), limit), *columns) == expected


def test_rows_with_one_id_are_split_by_text(spark):
    rows = [(7, f"text {i}" * 9) for i in range(40)] + [(8, "again " * 40)] * 5 + [(None, f"{i} none") for i in range(30)]
    made = sharding.shards(docs(spark, rows), 300).collect()
    assert len(made) == len(rows)
    assert all(r.shard_bytes <= 300 or r.doc_id == 8 for r in made)
    again = [r for r in made if r.doc_id == 8]
    assert {(r.shard_bytes, r.shard_rows, r.shard_bits) for r in again} == {(1200, 5, 120)}
    assert sharding.shards(docs(spark).limit(0), 10).count() == 0


def test_shards_of_bundled_table(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{FOLDER}/documents.parquet'")
    made = con.sql(sql.shards(50_000))
    expected = sorted(made.fetchall(), key=lambda r: tuple(map(str, r)))
    assert found(sharding.shards(spark.read.parquet(f"{FOLDER}/documents.parquet"), 50_000), *made.columns) == expected
