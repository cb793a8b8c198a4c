import numpy as np
import pytest
from llm_samples import FOLDER

from cohortair.llm import language_model


def test_partitions_do_not_change_the_model(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    counts = language_model.count_tokens(table)
    one, many = (language_model.train(table.repartition(n), counts) for n in (1, 16))
    assert np.allclose(one.classes, many.classes, atol=1e-3)
    assert np.allclose(one.members, many.members, atol=1e-3)
    assert np.abs(one.classes[1:]).max() > 0.5


def test_sums_are_those_of_all_texts(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    model = language_model.train(table, language_model.count_tokens(table))
    texts = [r.text for r in table.collect()]
    sums, often, loss, tokens = language_model.gradients(model.prepared(), iter([texts]), True)
    made, spark_loss, spark_tokens = language_model.summed_gradients(table.repartition(7), model)
    assert spark_tokens == tokens and spark_loss == pytest.approx(loss)
    for (at, total, counts), own, touched in zip(made, sums, often):
        assert len(at) == (touched > 0).sum() and (touched[at] == counts).all()
        assert np.allclose(own[at], total, atol=1e-3)


def test_passes_go_on_while_the_loss_falls(spark):
    table = spark.createDataFrame([(i, "a b c d e f g h " * 9) for i in range(200)], "doc_id long, text string")
    counts = language_model.count_tokens(table)
    model = language_model.train(table, counts)
    before = language_model.train(table.limit(0), counts)
    losses = [language_model.summed_gradients(table, m, needed=False)[1] for m in (before, model)]
    assert losses[1] < 0.1 * losses[0]


def test_texts_are_read_once_however_many_passes(spark, monkeypatch):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    counts = language_model.count_tokens(table)
    read = []
    places = language_model.places
    monkeypatch.setattr(language_model, "places", lambda docs, *more: read.append(docs) or places(docs, *more))
    monkeypatch.setattr(language_model, "PLACES_HELD", 1000)
    model = language_model.train(table, counts).prepared().tabled()
    assert read == [table]
    # Scores are the shares of the plain forward pass.
    codes, starts, _ = model.read(["w1 w8 the of", None, "the the é"])
    target, last, skip = model.features(codes, starts)
    kind, member, _, _, classes, members = language_model.forward(model, target, last, skip)
    each = np.arange(len(kind))
    plain = classes[each, kind].astype(float) + members[each, member]
    made = language_model.score_texts(model, ["w1 w8 the of", None, "the the é"])[3]
    expected = np.add.reduceat(plain / np.log(10) - model.log_bucket[target], starts)
    assert np.allclose(made, expected, atol=1e-4)
