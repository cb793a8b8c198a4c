import hashlib
import struct

import pytest
import sentencepiece
from llm_samples import babble, corpus, docs, found
from tokenizers import Tokenizer

from cohortair.llm import sentence_pieces, token_counts
from cohortair.llm.queries import BYTES, PIECES, tokenizer

TEXTS = [*babble(1, 1500), *babble(2, 300, "abcdefghij"), *(t for _, t, _ in corpus(40)), "", "<|endoftext|>" * 3]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=tokenizer(PIECES))


@pytest.fixture(scope="module")
def pieces():
    return sentence_pieces.Pieces(tokenizer(PIECES))


def test_ids_and_texts_are_those_of_the_library(library, pieces):
    for text in TEXTS:
        ids = library.encode(text)
        packed = pieces.encode(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == ids
        assert pieces.decode(packed) == library.decode(ids)


def test_any_ids_decode_as_the_library_does(library, pieces):
    for start in range(0, 31000, 97):
        ids = [start, start % 300, 3 + start % 256, (start * 7) % 32000, 1 + start % 5]
        assert pieces.decode(struct.pack("<5I", *ids)) == library.decode(ids)


def test_tokens_joined_at_random_keep_the_order_of_merges(library, pieces):
    names = sorted(pieces.ids)
    for i in range(0, 20000, 13):
        text = names[i] + names[i * 31 % len(names)] + names[i * 17 % len(names)]
        packed = pieces.encode(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == library.encode(text)


def test_caches_that_overflow_change_nothing(monkeypatch, library):
    monkeypatch.setattr(sentence_pieces, "SEGMENTS_KEPT", 5)
    monkeypatch.setattr("cohortair.llm.bpe.PAIRS_KEPT", 5)
    monkeypatch.setattr("cohortair.llm.bpe.MOVES_KEPT", 5)
    small = sentence_pieces.Pieces(tokenizer(PIECES))
    for text in TEXTS[:300]:
        packed = small.encode(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == library.encode(text)


def test_a_word_is_worked_out_once_whatever_mark_follows(library, pieces, monkeypatch):
    worked = []
    encoded = pieces.vocabulary.encoded
    monkeypatch.setattr(pieces.vocabulary, "encoded", lambda text: worked.append(text) or encoded(text))
    for text in ("a quizzicaly", "a quizzicaly.", "a quizzicaly, a quizzicaly!\nquizzicaly", 'a▁"quizzicaly."', "é.é 中,中\n\na-b.c _.a 1.a"):
        packed = pieces.encode(text)
        assert list(struct.unpack(f"<{len(packed) // 4}I", packed)) == library.encode(text)
    assert worked.count(" quizzicaly") == 1
    assert " quizzicaly." not in worked and "quizzicaly" in worked


def test_digests_and_arrays_of_odd_rows(spark, library):
    table = docs(spark)
    expected = []
    for r in table.select("doc_id", "text").collect():
        ids = library.encode(r.text or "", add_bos=True, add_eos=True)
        text = library.decode(ids)
        hashes = hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)), hashlib.sha256(text.encode())
        expected.append((r.doc_id, len(ids), *(h.hexdigest() for h in hashes)))
    made = sentence_pieces.digests(table, tokenizer(PIECES))
    assert found(made, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(
        expected, key=lambda r: tuple(map(str, r))
    )
    whole = sentence_pieces.encode_decode(table, tokenizer(PIECES)).where("doc_id = 8").first()
    assert whole.ids == library.encode(dict(table.select("doc_id", "text").collect())[8], add_bos=True, add_eos=True)
    assert sentence_pieces.digests(table.limit(0), tokenizer(PIECES)).count() == 0


def test_counts_are_those_of_the_library(spark):
    path = tokenizer(BYTES)
    library = Tokenizer.from_file(path)
    counter = token_counts.Counter(path)
    expected = [len(e.ids) for e in library.encode_batch(TEXTS, add_special_tokens=False)]
    assert counter(TEXTS) == expected
    assert [counter([t])[0] for t in TEXTS[:200]] == expected[:200]
    table = docs(spark)
    made = token_counts.token_counts(table, path, 5)
    rows = [
        (r.doc_id, len((r.text or "").encode()), n, n > 5)
        for r in table.select("doc_id", "text").collect()
        for n in [len(library.encode(r.text or "", add_special_tokens=False).ids)]
    ]
    assert found(made, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(rows, key=lambda r: tuple(map(str, r)))
    assert token_counts.token_counts(table.limit(0), path).count() == 0


def test_chunks_compose_to_one_run(monkeypatch):
    text = "we'll'd x  \n y're 12ab''s  " * 40
    whole = token_counts.pieces([text])
    for size, lead in ((17, 3), (32, 16), (4096, 16)):
        monkeypatch.setattr(token_counts, "CHUNK", size)
        monkeypatch.setattr(token_counts, "LEAD", lead)
        assert token_counts.pieces([text]) == whole


def test_small_tables_of_states_change_nothing(monkeypatch):
    path = tokenizer(BYTES)
    expected = token_counts.Counter(path)(TEXTS[:400])
    monkeypatch.setattr(token_counts, "WORDS_KEPT", 10)
    monkeypatch.setattr(token_counts, "STATES_KEPT", 30)
    assert token_counts.Counter(path)(TEXTS[:400]) == expected
