import corpus_pipeline
import duckdb
import pytest
from llm_samples import FOLDER

import __spark_entry__ as entry_points
from cohortair.llm import language, quality, queries, sentence_pieces, simhash, sql
from cohortair.llm.decontaminate import contamination

SMALL = "/root/testdata/sf0.01"


def test_stages_and_their_columns(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "language_id", "near_duplicates", "decontamination", "sentence_pieces"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, FOLDER).columns == docs.columns
        assert stage(spark, docs.limit(0), FOLDER).count() == 0


def test_pipeline_equals_its_steps_by_hand(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    model = quality.train(docs, labels)
    good = {r.doc_id for r in quality.score(docs, model, ("doc_id",)).where("score >= 0.3").collect()}
    now = docs.where(docs.doc_id.isin(list(good)))
    named = language.identify(now, queries.learned_trees(now))
    fit = {r.doc_id for r in named.where("lang_pred <> 'und' AND score >= 0.5").collect()}
    now = docs.where(docs.doc_id.isin(list(fit)))
    first = {r.doc_id for r in simhash.near_duplicates(now, 3, 3).where("doc_id = component_id").collect()}
    now = docs.where(docs.doc_id.isin(list(first)))
    clean = {r.doc_id for r in contamination(now, bench, 10).where("NOT contaminated").collect()}
    expected = sentence_pieces.digests(docs.where(docs.doc_id.isin(list(clean))), queries.tokenizer(queries.PIECES))
    made = corpus_pipeline.run(spark, SMALL)
    assert len(clean) < len(first) < len(good) < docs.count()
    assert sorted(map(tuple, made.collect())) == sorted(map(tuple, expected.collect()))


def test_every_operator_is_registered():
    names = entry_points.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in names) == 1


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_queries_equal_their_texts(spark, name):
    con = duckdb.connect()
    for table in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    made = con.sql(entry_points.oracle_sql()[name])
    ours = entry_points.queries()[name](spark, FOLDER).select(*made.columns)
    key = lambda r: tuple(map(str, r))
    assert sorted((tuple(r) for r in ours.collect()), key=key) == sorted(made.fetchall(), key=key)


@pytest.mark.parametrize("name", ["op2_decontamination", "op3_licenses", "op5_sharding"])
def test_native_plans_hold_no_python(spark, name):
    plan = entry_points.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
