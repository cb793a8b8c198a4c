import collections
import math
import zlib

import numpy as np
import pytest
from llm_samples import FOLDER, corpus, docs, found

from cohortair.llm import language, language_model, quality, queries


def fold(doc_id, n):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % n


def plain_bits(counts, text):
    """Code length by looking contexts up one by one."""
    data, bits = b"\0\0\0" + text.lower().encode(), 0.0
    for i in range(3, len(data)):
        for order in (3, 2, 1, 0):
            after = counts.get(data[i - order : i])
            if not after:
                continue
            total = sum(after.values()) + len(after)
            if data[i] in after:
                bits -= math.log2(after[data[i]] / total)
                break
            bits -= math.log2(len(after) / total)
        else:
            bits += 8
    return bits


def contexts(texts):
    counts = collections.defaultdict(collections.Counter)
    for text in texts:
        data = b"\0\0\0" + text.lower().encode()
        for i in range(3, len(data)):
            for order in range(4):
                counts[data[i - order : i]][data[i]] += 1
    return counts


def test_code_lengths_are_exact(spark):
    rows = [(i, t, l) for i, t, l in corpus() if t]
    table = spark.createDataFrame([*rows, (900, None, "en"), (901, "x", None)], "doc_id long, text string, lang string")
    trees = language.train(table)
    assert trees.languages == sorted({r[2] for r in rows})
    probes = ["Hello wörld 中文", "", "a", rows[3][1][:300], "\x00\x00 zero"]
    made = trees.bits(probes)
    for k, name in enumerate(trees.languages):
        counts = contexts(t for _, t, l in rows if l == name)
        assert np.allclose(made[:, k], [plain_bits(counts, p) for p in probes], rtol=1e-9)


def test_languages_of_held_out_texts(spark):
    made = queries.QUERIES["op8_language"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    both = made.join(truth, "doc_id").where("held_out").select("lang_pred", "lang", "score").collect()
    assert len(both) > 200
    assert sum(r.lang_pred == r.lang for r in both) >= 0.98 * len(both)
    assert all(0 <= r.score <= 1 for r in both)


def test_odd_texts_have_no_language(spark):
    trees = language.train(spark.createDataFrame(corpus(60), "doc_id long, text string, lang string"))
    table = docs(spark)
    made = found(language.identify(table, trees), "doc_id", "lang_pred", "score")
    assert len(made) == table.count()
    assert {r[0] for r in made if r[1] == "und"} == {None, 1, 2, 3, 13}
    assert all(r[2] == 0 for r in made if r[1] == "und")
    kept = language.keep_identified(table, trees)
    assert kept.columns == table.columns and kept.where("text IS NULL").count() == 0
    nothing = language.train(docs(spark).limit(0))
    assert {r.lang_pred for r in language.identify(table, nothing).collect()} == {"und"}
    assert language.identify(table.limit(0), trees).count() == 0


def test_sample_of_a_large_language_is_bounded(spark):
    many = [(i, f"aaa bbb {i}", "xx") for i in range(2000)] + [(9000, "ccc", "yy")]
    table = spark.createDataFrame(many, "doc_id long, text string, lang string")
    some, all_ = language.train(table, per_language=100), language.train(table)
    assert some.languages == all_.languages == ["xx", "yy"]
    # Fewer contexts of the large language, all of the small one.
    sizes = [[len(t[3][0]) for t in trees.tables] for trees in (some, all_)]
    assert 0 < sizes[0][0] < sizes[1][0] and sizes[0][1] == sizes[1][1] > 0


@pytest.fixture(scope="module")
def quality_rows(spark):
    folder = "/root/testdata/sf0.01"
    made = queries.QUERIES["op7_quality"](spark, folder)
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    return made.join(labels, "doc_id").collect(), made.count()


def test_quality_of_held_out_texts(quality_rows):
    rows, total = quality_rows
    held = [r for r in rows if r.held_out]
    assert total == 1000 and len(held) > 50
    assert all(r.held_out == (fold(r.doc_id, 5) == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in held) >= 0.97 * len(held)
    good = [r for r in held if r.quality == 1]
    assert sum(r.predicted for r in good) >= 0.98 * len(good)
    # Calibrated: the mean score is near the share of label 1.
    assert abs(np.mean([r.score for r in held]) - np.mean([r.quality for r in held])) < 0.05


def test_quality_of_odd_rows(spark):
    table = docs(spark)
    labels = spark.createDataFrame([(4, 1), (4, 0), (12, 0), (5, None), (77, 1), (8, 1), (None, 1)], "doc_id long, quality int")
    made = quality.quality_scores(table, labels)
    assert made.count() == table.count()
    same = {r.score for r in made.where("doc_id IN (1, 2, 3)").collect()}
    assert len(same) == 1
    one = quality.quality_scores(table, labels.where("quality = 1"))
    assert {r.score for r in one.collect()} == {1.0}
    none = quality.quality_scores(table, labels.limit(0))
    assert {r.score for r in none.collect()} == {0.5}
    assert quality.quality_scores(table.limit(0), labels).count() == 0
    kept = quality.keep_good(table, labels.where("quality = 1"))
    assert kept.columns == table.columns and kept.count() == table.count()


def test_pooling_in_blocks(monkeypatch):
    texts = ["a b c d e f g a b", None, "x x x x", "q " * 50]
    reader, vectors = quality.Reader(), quality.index_vectors(3)
    words, shapes, starts = reader.read(texts)
    whole = quality.pooled(words, shapes, starts, vectors)
    sums = np.zeros((quality.ROWS, quality.SIZE))
    quality.context_sums(words, shapes, vectors, sums)
    monkeypatch.setattr(quality, "BLOCK", 7)
    assert np.allclose(quality.pooled(words, shapes, starts, vectors), whole)
    again = np.zeros_like(sums)
    quality.context_sums(words, shapes, vectors, again)
    assert np.allclose(sums, again)
    one = quality.pooled(*reader.read([texts[0]]), vectors)
    assert np.allclose(one[0], whole[0]) and not whole[1].any()


def expected_base(pairs, folds=10):
    tokens = {}
    for k, (i, t) in enumerate(pairs):
        lowered = (t or "").encode().lower().split()
        tokens[k] = (i, [*lowered, None])
    counts = collections.Counter()
    for i, each in tokens.values():
        if fold(i, folds):
            counts.update(each)
    total, types = sum(counts.values()), len(counts)
    return total, [
        (
            i,
            fold(i, folds) == 0,
            len(each),
            sum(counts[t] > 0 for t in each),
            sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (types + 1))) for t in each),
        )
        for i, each in tokens.values()
    ]


def test_base_scores_of_bundled_and_odd_rows(spark):
    for table in (docs(spark), spark.read.parquet(f"{FOLDER}/documents.parquet")):
        pairs = [(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()]
        total, expected = expected_base(pairs)
        made = language_model.lm_scores(table)
        rows = found(made, "doc_id", "held_out", "n_tokens", "n_known", "base_score")
        assert {r.train_tokens for r in made.collect()} == {total}
        for a, b in zip(rows, sorted(expected, key=lambda r: tuple(map(str, r)))):
            assert a[:4] == b[:4] and math.isclose(a[4], b[4], rel_tol=1e-9, abs_tol=1e-9)
    assert language_model.lm_scores(docs(spark).limit(0)).count() == 0


def test_rare_tokens_are_looked_up_alike(spark, monkeypatch):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    counts = language_model.count_tokens(table)
    few = language_model.train(table, counts, most_frequent=50)
    assert 0 < len(few.tokens) <= 50
    all_counts = dict((bytes(r.token), r["count"]) for r in counts.collect())
    assert few.total == sum(all_counts.values()) and few.types == len(all_counts)
    assert min(all_counts[t] for t in few.tokens) > max(c for t, c in all_counts.items() if t not in set(few.tokens))


def test_model_is_a_distribution_and_learns(spark):
    pick = np.random.default_rng(4)
    follow = {i: (i * 7 + 3) % 40 for i in range(40)}
    texts, at = [], 0
    for k in range(300):
        words = []
        for _ in range(60):
            at = follow[at] if pick.random() < 0.8 else int(pick.integers(40))
            words.append(f"w{at}")
        texts.append((k, " ".join(words)))
    table = spark.createDataFrame(texts, "doc_id long, text string")
    made = language_model.lm_scores(table).where("held_out").agg({"score": "sum", "base_score": "sum", "n_tokens": "sum"}).first()
    # The next word mostly follows from the last one, which unigrams can't see.
    assert made["sum(score)"] > made["sum(base_score)"] + 0.1 * made["sum(n_tokens)"]
    counts = language_model.count_tokens(table)
    model = language_model.train(table, counts).prepared()
    codes, starts, _ = model.read(["w1 w8"])
    target, last, skip = model.features(codes, starts)
    shares = []
    for bucket in range(language_model.BUCKETS):
        now = target.copy()
        now[1] = bucket
        kind, member, _, _, classes, members = language_model.forward(model, now[1:2], last[1:2], skip[1:2])
        shares.append(math.exp(classes[0, kind[0]] + members[0, member[0]]))
    assert abs(sum(shares) - 1) < 1e-4
