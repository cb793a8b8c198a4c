"""Each query against its DuckDB text, and what its plan may hold."""

import os
import re
from concurrent.futures import ThreadPoolExecutor

import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry_points
from workload import sql
from workload.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")
LIBRARY = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "cohortair")


@pytest.fixture(scope="module")
def outcomes(spark):
    """All queries, a few at a time: most of their time is planning."""
    con = connect(FOLDER)

    def run(name):
        df = QUERIES[name](spark, FOLDER)
        found = compare(df, con.cursor(), sql.oracle(name))
        return *found, df._jdf.queryExecution().executedPlan().toString()

    with ThreadPoolExecutor(6) as pool:
        yield {name: pool.submit(run, name) for name in QUERIES}


def test_every_query_has_a_text():
    assert set(QUERIES) == set(sql.ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(QUERIES) <= set(entry_points.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_text_and_plan_stays_distributed(outcomes, name):
    same, ours, notes, plan = outcomes[name].result()
    assert same and not notes
    assert ours.num_rows > 0
    assert not re.search("Cartesian|NestedLoop|Python|Pandas|CollectLimit", plan)
    # The one window without groups runs over row counts per leading digits.
    alone = re.search(r"windowspecdefinition\([^,]* (ASC|DESC)", plan)
    assert bool(alone) == name.startswith("unmatched_zips")


def test_library_collects_only_sizes():
    # The training-data operators, which may be absent, have tests of their own.
    for folder, _, files in os.walk(LIBRARY):
        if os.path.basename(folder) == "llm":
            continue
        for file in files:
            if file.endswith(".py"):
                with open(os.path.join(folder, file)) as source:
                    text = source.read()
                assert not re.search(r"toPandas|localCheckpoint|crossJoin|\.rdd", text), file
                # The names of the rule sheet's conditions become columns.
                assert len(re.findall(r"\.collect\(", text)) == (1 if file == "conditions.py" else 0)
                # Sizes: of a side to broadcast, and of the rows that opened calendars make.
                assert len(re.findall(r"\.first\(\)", text)) == (1 if file in ("joins.py", "timeseries.py") else 0)


def test_entry_runs(spark):
    assert entry_points.entry(spark).count() > 0
