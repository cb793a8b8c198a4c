import collections
import math

import numpy as np
import pytest

from cohortair.llm import language_model
from cohortair.llm.common import crc_fold


def chains(spark, words, texts):
    """Texts of words whose successors are determined, far more words than buckets."""
    pick = np.random.default_rng(8)
    follow = pick.permutation(words)
    made = []
    for k in range(texts):
        at, each = int(pick.integers(words)), []
        for _ in range(50):
            each.append(f"w{at}")
            at = int(follow[at])
        made.append((k, " ".join(each)))
    return spark.createDataFrame(made, "doc_id long, text string")


def test_what_is_learned_grows_with_the_words(spark, monkeypatch):
    # Without training of the buckets, which takes many passes here.
    monkeypatch.setattr(language_model, "fit", lambda *given: [])
    table = chains(spark, 3000, 700)
    held = language_model.lm_scores(table).where("held_out")
    made = held.agg({"score": "sum", "base_score": "sum", "n_tokens": "sum"}).first()
    assert made["sum(score)"] > made["sum(base_score)"] + 1.0 * made["sum(n_tokens)"]


def test_scores_are_those_of_a_plain_loop(spark, monkeypatch):
    monkeypatch.setattr(language_model, "fit", lambda *given: [])
    # Some tokens are rare ones, in several batches and parts.
    vocabulary = language_model.vocabulary
    monkeypatch.setattr(language_model, "vocabulary", lambda counts, most=20: vocabulary(counts, most))
    monkeypatch.setattr(language_model, "BATCH_CHARS", 2000)
    monkeypatch.setattr(language_model, "PART_TOKENS", 500)
    table = chains(spark, 60, 40).union(spark.createDataFrame([(70, None), (71, ""), (72, "w1 new w2 the the"), (72, "w1")], "doc_id long, text string"))
    made = language_model.lm_scores(table).collect()
    learned = table.where(crc_fold(table.doc_id, 10) != 0)
    model = language_model.vocabulary(language_model.count_tokens(learned)).prepared().tabled()
    assert 0 < len(model.tokens) <= 20
    one, two = collections.Counter(), collections.Counter()
    for row in learned.collect():
        tokens = language_model.split(row.text)
        one.update([None, *tokens])
        two.update(zip([None, *tokens], tokens))
    expected = []
    for row in table.collect():
        codes, starts, (tokens,) = model.read([row.text])
        target, inside = language_model.shares(model, codes, starts)
        total = 0.0
        for t, before, bucket, log in zip(tokens, [None, *tokens], target, inside):
            share = math.exp(log) * (one[t] + 0.1) / (model.bucket_total[bucket] + 0.1 * (model.bucket_types[bucket] + 1))
            total += math.log10((two[before, t] + language_model.PRIOR[2] * share) / (one[before] + language_model.PRIOR[2]))
        expected.append((row.doc_id, total))
    found = sorted((r.doc_id, r.score) for r in made)
    assert [i for i, _ in found] == [i for i, _ in sorted(expected)]
    assert [x for _, x in found] == pytest.approx([x for _, x in sorted(expected)], abs=1e-2)
