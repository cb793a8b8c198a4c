"""Compare queries with their DuckDB text: python tests/check_oracles.py FOLDER [NAME...]"""

from __future__ import annotations

import math
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_points  # noqa: E402


def plain(value):
    if value is None or (isinstance(value, float) and math.isnan(value)):
        return None
    if isinstance(value, float):
        return value + 0.0
    if hasattr(value, "isoformat"):
        return value.isoformat()
    return value


def rows_of(table):
    names = sorted(table.column_names)
    columns = [[plain(v) for v in table.column(n).to_pylist()] for n in names]
    return names, Counter(zip(*columns))


def compare(df, con, text):
    """Whether rows are equal, our table, and what differs."""
    ours = df.toArrow()
    theirs = con.sql(text).to_arrow_table()
    our_names, our_rows = rows_of(ours)
    their_names, their_rows = rows_of(theirs)
    same = our_names == their_names and our_rows == their_rows
    notes = []
    if our_names != their_names:
        notes.append(f"columns {set(our_names) ^ set(their_names)}")
    for n in set(our_names) & set(their_names):
        pair = (str(ours.schema.field(n).type), str(theirs.schema.field(n).type))
        if pair[0] != pair[1]:
            notes.append(f"type of {n} {pair}")
    if our_names == their_names and not same:
        for label, more in (("ours", our_rows - their_rows), ("text", their_rows - our_rows)):
            notes.append(f"only {label} {sum(more.values())} {list(more)[:3]}")
    return same, ours, notes


def connect(folder):
    con = duckdb.connect()
    for file in sorted(os.listdir(folder)):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{folder}/{file}'")
    return con


def main():
    folder, wanted = sys.argv[1], sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(folder)
    bad = 0
    for name, text in entry_points.oracle_sql().items():
        if wanted and name not in wanted:
            continue
        start = time.time()
        try:
            df = entry_points.queries()[name](spark, folder)
            same, ours, notes = compare(df, con, text)
        except Exception as error:  # noqa: BLE001
            bad += 1
            print(f"ERROR {name}: {str(error)[:700]}")
            continue
        bad += not same
        print(f"{'ok  ' if same else 'DIFF'} {name} rows={ours.num_rows} {time.time() - start:.2f}s")
        for note in notes:
            print("  ", note)
    print("differences:", bad)


if __name__ == "__main__":
    main()
