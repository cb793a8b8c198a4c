import duckdb
import pytest

from cohortair.llm import collocations, sql

SCHEMA = "doc_id long, text string, lang string, source string"
ROWS = [
    (1, "New York is big. new york, NEW YORK city; New York City!", "en", "a"),
    (2, "new york city\tnew york city\nnew york", "en", "a"),
    (3, "the cat sat. the cat sat. the dog sat", None, "b"),
    (4, None, "en", "c"),
    (5, "", "de", "c"),
    (6, "the cat sat. the cat sat. the dog sat", None, "b"),
    (None, "ab ab ab ab ab ab", "fr", None),
    (7, "Ärger  Ärger Ärger. ärger ärger", "de", "x"),
]


def oracle(rows, least, top):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?)", rows)
    made = con.sql(sql.collocations(least, top))
    return sorted(made.fetchall())


@pytest.mark.parametrize("least,top", [(2, 2000), (2, 3), (3, 1), (1, 5)])
def test_collocations_equal_brute_force(spark, least, top):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = collocations.collocations(docs, least=least, top=top, spread=3)
    cols = ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "k"]
    assert sorted(tuple(r) for r in got.select(*cols).collect()) == oracle(ROWS, least, top)


def test_words_and_pieces(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    found = {(r.lang, r.phrase): r.f for r in collocations.counts(docs).collect()}
    assert found[("en", "new york")] == 7 and found[("en", "new york city")] == 4  # a tab joins words
    assert found[("und", "the cat sat")] == 4 and ("und", "sat the") not in found  # pieces end at dots
    assert found[("de", "Ärger Ärger")] == 2 and found[("de", "ärger ärger")] == 1  # only A-Z are lowered
    assert found[("fr", "ab ab ab")] == 4


def test_drops_phrases_inside_longer_ones_and_breaks_ties(spark):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    got = {r.phrase: r for r in collocations.collocations(docs, least=2, spread=2).collect()}
    # "cat sat" (a=4) lies inside "the cat sat" (4): 100 * 4 >= 50 * 4, dropped
    assert "the cat sat" in got and "cat sat" not in got and "the cat" not in got
    assert got["ab ab ab"].k == 1  # both cuts score alike: the smaller k


def test_empty_and_clashing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert collocations.collocations(empty).collect() == []
    clash = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "'x' AS phrase", "1 AS f", "2 AS words")
    assert collocations.collocations(clash, least=2).count() == collocations.collocations(spark.createDataFrame(ROWS, SCHEMA), least=2).count()


def test_score_is_exact_beyond_64_bits():
    # 1e6 * a^2 overflows 64 bits for a near 1e7; both paths use decimals or huge integers
    a, l, r = 9_000_000_001, 9_000_000_007, 9_000_000_011
    con = duckdb.connect()
    got = con.sql(f"SELECT (CAST({a} AS HUGEINT) * {a} * 1000000) // (CAST({l} AS HUGEINT) * {r})").fetchall()[0][0]
    assert got == (a * a * 1_000_000) // (l * r)


def test_texts_are_split_once_and_parts_counted_by_id(spark, monkeypatch):
    docs = spark.createDataFrame(ROWS + [(8, " \t. x\ty  z\v\t", "en", "d")] * 2, SCHEMA)
    plans = []

    def noted(df):
        plans.append(df._jdf.queryExecution().optimizedPlan().toString())
        return store(df)

    store = collocations.store
    monkeypatch.setattr(collocations, "store", noted)
    frequent, totals = collocations.frequent_counts(docs, least=2)
    # A filter by the size of the array would split every text and piece a second time.
    assert plans[0].count("split(") == 2 and not any("split(" in plan for plan in plans[1:])
    counted = {(r.lang, r.phrase): r.f for r in collocations.counts(docs).collect()}
    found = frequent.collect()
    assert {(r.lang, r.phrase): r.f for r in found} == {k: f for k, f in counted.items() if f >= 2}
    for r in found:
        words = r.phrase.split(" ")
        assert len(words) == r.words
        assert r.firsts == [counted[r.lang, " ".join(words[:k])] for k in range(1, r.words)]
        assert r.lasts == [counted[r.lang, " ".join(words[-k:])] for k in range(1, r.words)]
    assert {r.lang: r.n for r in totals.collect()} == {
        lang: sum(f for (at, p), f in counted.items() if at == lang and " " not in p) for lang in {k[0] for k in counted}
    }
