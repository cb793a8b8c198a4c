import itertools

import numpy as np
from pyspark.sql import functions as F

from cohortair.llm import toxicity

SCHEMA = "doc_id long, text string, lang string, source string"


def brute_features(word):
    found = {}
    for i, j, k in itertools.combinations(range(len(word)), 3):
        if k - i + 1 <= toxicity.MAX_SPAN:
            key = (word[i], word[j], word[k])
            found[key] = found.get(key, 0.0) + toxicity.DECAY ** (k - i + 1)
    return found


def brute_kernel(u, v):
    fu, fv = brute_features(u), brute_features(v)
    dot = sum(w * fv.get(f, 0.0) for f, w in fu.items())
    nu, nv = np.sqrt(sum(w * w for w in fu.values())), np.sqrt(sum(w * w for w in fv.values()))
    return dot / (nu * nv) if nu and nv else 0.0


def test_kernel_equals_plain_loop_and_tolerates_inserted_characters():
    marks = ["idiot", "clown", "ab", "ééé-ü"]
    words = ["idiot", "idioot", "i.d.i.o.t", "id", "", "clowwn", "table", "ééé-ü"]
    got = toxicity.Landmarks.of(marks).kernel(words)
    for a, w in enumerate(words):
        for b, m in enumerate(marks):
            assert abs(got[a, b] - brute_kernel(w, m)) < 1e-12
    assert got[1, 0] > 0.5 and got[2, 0] > 0.1 and got[6, 0] == 0.0


def tiny_corpus(spark):
    rows, labels = [], []
    for i in range(400):
        toxic = i % 4 == 0
        insult = (["idiot" if i % 8 == 0 else "moron"] if toxic else [])
        rows.append((i, " ".join(["plain", "words", *insult, "here", f"w{i % 37}", "table."]), "en", "s"))
        labels.append((i, 1 - toxic, int(toxic)))
    rows += [(1000, None, "en", "s"), (1001, "", "en", "s"), (1002, "You IDIOOT", "en", "s"), (1003, "plain table", "en", "s"),
             (1003, "plain table", "en", "s"), (None, "a moron", None, None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_scores_every_row_and_finds_variants(spark):
    docs, labels = tiny_corpus(spark)
    got = {r.doc_id: r for r in toxicity.scores(docs.withColumn("raw", docs.doc_id), labels).collect()}
    assert len(toxicity.scores(docs, labels).collect()) == docs.count()
    assert got[1000].score == got[1001].score  # null and empty: the bias
    assert got[None].predicted == 1 and got[1003].predicted == 0 and got[1002].score > got[1003].score
    assert all(0 <= r.score <= 1 for r in got.values())
    assert isinstance(got[0].held_out, bool)
    held = [r for k, r in got.items() if k is not None and k < 400 and r.held_out]
    assert sum((r.predicted == 1) == (r.doc_id % 4 == 0) for r in held) / len(held) >= 0.95


def test_empty_tables(spark):
    docs, labels = tiny_corpus(spark)
    assert toxicity.scores(docs.limit(0), labels).collect() == []
    out = toxicity.scores(docs, labels.limit(0)).collect()  # nothing to learn from: one score for all
    assert len({r.score for r in out}) == 1


def test_folded_decisions_equal_the_nystrom_features():
    marks = ["idiot", "clown", "table", "plain", "ab"]
    lm = toxicity.Landmarks.of(marks)
    whitening = toxicity.nystrom(lm)
    w = np.random.default_rng(1).normal(size=whitening.shape[1])
    model = toxicity.Model(lm, whitening, w, 0.25)
    words = ["idiot", "idioot", "i.d.i.o.t", "id", "", "tables", "ééé"]
    assert np.allclose(model.decisions(words), model.features(words) @ w + 0.25, atol=1e-12)


def test_insult_stems_outrank_look_alikes_of_clean_texts(spark):
    """Insults are stems with many endings; clean texts are full of words that share parts of them."""
    rng = np.random.default_rng(5)
    parts = ["ba", "ren", "lo", "wei", "sti", "ke", "mu", "vor", "tal", "nis"]
    rows, labels = [], []
    for i in range(600):
        words = ["".join(rng.choice(parts, rng.integers(2, 5))) for _ in range(rng.integers(20, 200))]
        toxic = i % 8 == 0
        words = [w for w in words if not w.startswith("lowei")]
        if toxic:
            for _ in range(6):
                words[rng.integers(len(words))] = "lowei" + "".join(rng.choice(parts, 1))
        rows.append((i, " ".join(words), "en", "s"))
        labels.append((i, 1, int(toxic)))
    docs = spark.createDataFrame(rows, SCHEMA)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    held = [r for r in toxicity.scores(docs, marks).collect() if r.held_out]
    toxic = np.array([r.score for r in held if r.doc_id % 8 == 0])
    clean = np.array([r.score for r in held if r.doc_id % 8])
    assert len(toxic) >= 8
    assert (toxic[:, None] > clean[None]).mean() + (toxic[:, None] == clean[None]).mean() / 2 >= 0.95
    assert (toxic >= 0.5).mean() >= 0.7 and (clean >= 0.5).mean() <= 0.05


def test_contrast_ranks_an_insult_before_chance_words(spark):
    """An insult no clean document holds comes before a word of both classes, whatever its odds ratio's error."""
    rows = [(i, ("idiot " if 8 <= i < 40 else "") + ("reeux " if i < 8 or 100 <= i < 103 else "") + "plain") for i in range(1000)]
    train = spark.createDataFrame(rows, "doc_id long, text string").withColumn("label", (F.col("doc_id") < 100).cast("int"))
    found = {r.word: r.g2 for r in toxicity.word_contrast(train).collect()}
    assert found["idiot"] > found["reeux"] > found["plain"]
    plain = 2 * (32 * np.log(1000 * 32 / (32 * 100)) + 68 * np.log(68 * 1000 / (968 * 100)) + 900 * np.log(900 * 1000 / (968 * 900)))
    assert abs(found["idiot"] - plain) < 1e-9
