import collections
import hashlib
import random

import numpy as np
from llm_samples import FOLDER, docs, found

from cohortair.llm import weighted_sampling
from cohortair.llm.weighted_sampling import Sampler, edited, fingerprints, likeness


def jaccard(a, b):
    a, b = collections.Counter(a.split()), collections.Counter(b.split())
    words = a.keys() | b.keys()
    return sum(min(a[w], b[w]) for w in words) / sum(max(a[w], b[w]) for w in words)


def test_collisions_estimate_generalised_jaccard():
    sampler, pick = Sampler(4096), random.Random(6)
    for _ in range(8):
        a = " ".join(pick.choices([f"w{i}" for i in range(25)], k=80))
        b = " ".join(pick.choices([f"w{i}" for i in range(pick.randint(0, 15), 40)], k=90))
        assert abs(likeness(sampler.signature(a), sampler.signature(b)) - jaccard(a, b)) < 0.035


def test_signatures_hang_on_the_words_alone(monkeypatch):
    text = " ".join(f"t{i % 300}" for i in range(1000))
    first = Sampler().signature(text)
    shuffled = text.split()
    random.Random(1).shuffle(shuffled)
    monkeypatch.setattr(weighted_sampling, "TERMS_KEPT", 40)
    monkeypatch.setattr(weighted_sampling, "TERM_BLOCK", 64)
    small = Sampler()
    small.signature("other words that fill the table")
    assert (small.signature(" ".join(shuffled)) == first).all()
    assert (small.signature(text + " ") == first).all()


def expected(rows):
    sampler = Sampler()
    for k, (i, t) in enumerate(rows):
        text, following = t or "", rows[(k + 1) % len(rows)][1] or ""
        half = len(text) // 2
        new = text[: len(text) - half] + following[:half]
        own, other, next_ = (sampler.signature(x) for x in (text, new, following))
        yield i, len(text), hashlib.sha256(new.encode()).hexdigest(), likeness(own, other), likeness(own, next_)


def test_every_document_meets_the_next(spark):
    table = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in table.select("doc_id", "text").collect())
    names = ("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next")
    assert found(fingerprints(table), *names) == sorted(expected(rows), key=lambda r: tuple(map(str, r)))


def test_odd_rows(spark):
    table = docs(spark)
    made = fingerprints(table).collect()
    assert len(made) == table.count()
    alike = collections.defaultdict(set)
    texts = {r.doc_id: r.text for r in table.collect()}
    for r in made:
        if r.doc_id is not None and r.doc_id != 9:
            assert r.n_chars == len(texts[r.doc_id] or "")
            alike[texts[r.doc_id] or ""].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(v) == 1 for v in alike.values())
    one = fingerprints(docs(spark, [(5, "alone in here")])).first()
    # Followed by itself: 13 characters, of which 6 are replaced.
    assert edited("alone in here", "alone in here") == "alone ialone "
    assert one.near_next == 1 and one.edited_sha256 == hashlib.sha256(b"alone ialone ").hexdigest()
    assert fingerprints(table.limit(0)).count() == 0
    assert np.array_equal(Sampler().signature(" \n"), Sampler().signature(""))
