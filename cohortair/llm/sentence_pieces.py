"""SentencePiece BPE encoding by a prefix table, and decoding."""

from __future__ import annotations

import hashlib
from functools import cache
from operator import itemgetter
from re import compile as pattern
from struct import pack

import numpy as np
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortair.llm.bpe import Vocabulary
from cohortair.llm.common import keeps, map_texts

SPACE = "▁"
SEGMENT = pattern(" *[^ ]+| +")
# The same, parted where letters and marks meet; BORDER finds such places.
LETTERS, MARKS = "[A-Za-zÀ-ɏ]", r"[.,;:!?\n]"
FINER = pattern(f" *{LETTERS}++(?={MARKS})|{MARKS}++(?={LETTERS})| *[^ ]+| +")
BORDER = pattern(f"{LETTERS}{MARKS}|{MARKS}{LETTERS}")
# Segments of each of two generations: those of the older one stay if they are met again.
SEGMENTS_KEPT = 200_000
LONGEST_KEPT = 48
NOT_UTF8 = "�"


class Pieces:
    """A BPE model's vocabulary and its own encoder and decoder.

    The library only reads the model file. Models must leave text as it is
    (no normalisation rules, no user-defined pieces) and fall back to bytes.
    """

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.vocab_size()
        names = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) for i in range(size)]
        raw = [model.is_byte(i) for i in range(size)]
        self.ids = {t: i for i, t in enumerate(names) if not (special[i] or raw[i] or model.is_unused(i))}
        self.byte_ids = {int(names[i][3:5], 16): i for i in range(size) if raw[i]}
        ranks = {t.replace(SPACE, " "): -model.get_score(i) for t, i in self.ids.items() if len(t) > 1}
        self.vocabulary = Vocabulary(ranks, self.packed)
        # Segments can be encoded alone if no token holds a space after something else.
        self.apart = all(" " not in t.lstrip(" ") for t in ranks)
        # No merge crosses a place that no token holds inside.
        self.segments = (SEGMENT if any(map(BORDER.search, ranks)) else FINER).findall
        self.begin, self.end = model.bos_id(), model.eos_id()
        self.texts = [
            "" if model.is_control(i) else model.id_to_piece(i).replace(SPACE, " ") for i in range(size)
        ]
        if model.unk_id() >= 0:
            self.texts[model.unk_id()] = " ⁇ "
        self.byte_of = {i: b for b, i in self.byte_ids.items()}
        self.real = set(self.ids.values())
        self.is_byte = np.array(raw)
        self.known = Segments(self.vocabulary)

    def packed(self, token: str) -> bytes:
        """Ids of a token as little-endian 32-bit integers: its own, or those of its bytes."""
        known = self.ids.get(token.replace(" ", SPACE))
        ids = [known] if known is not None else [self.byte_ids[b] for b in token.encode("utf-8", "replace")]
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, text: str) -> bytes:
        """Ids of a text, without begin and end, as little-endian 32-bit integers."""
        if not text:
            return b""
        # Both signs mean the same; with spaces most strings take a byte a letter.
        text = " " + text.replace(SPACE, " ")
        if not self.apart:
            return b"".join(reversed(self.vocabulary.encoded(text)))
        return b"".join(map(self.known.__getitem__, self.segments(text)))

    def decode(self, ids: bytes) -> str:
        """The text of packed ids; begin, end and the space put before a text vanish."""
        numbers = np.frombuffer(ids, "<u4")
        plain = not self.is_byte[numbers].any()
        numbers = numbers.tolist()
        if plain:
            out = "".join(itemgetter(*numbers)(self.texts)) if numbers else ""
        else:
            parts, held = [], bytearray()
            for i in numbers:
                byte = self.byte_of.get(i)
                if byte is not None:
                    held.append(byte)
                    continue
                if held:
                    parts.append(_text(bytes(held)))
                    held.clear()
                parts.append(self.texts[i])
            out = "".join(parts) + _text(bytes(held))
        first = next((i for i in numbers if self.texts[i] or i in self.byte_of), None)
        dummy = first is not None and first not in self.byte_of and self.texts[first].startswith(" ")
        return out[1:] if dummy and first in self.real else out


class Segments(dict):
    """Packed ids of segments met before; others are worked out when they are looked up."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, bytes] = {}

    def __missing__(self, segment: str) -> bytes:
        found = self.older.get(segment)
        if found is None:
            found = b"".join(reversed(self.vocabulary.encoded(segment)))
        if len(segment) <= LONGEST_KEPT:
            if len(self) > SEGMENTS_KEPT:
                self.older = dict(self)
                self.clear()
            self[segment] = found
        return found


def _text(data: bytes) -> str:
    """UTF-8 bytes as text; each byte that fits nowhere becomes a replacement character."""
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, at = [], 0
        while at < len(data):
            for size in (1, 2, 3, 4):
                try:
                    out.append(data[at : at + size].decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append(NOT_UTF8)
                size = 1
            at += size
        return "".join(out)


@cache
def load(path: str) -> Pieces:
    return Pieces(path)


keeps(__name__, load.cache_clear)


def encode_decode(docs: DataFrame, path: str, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Key columns, ids (array of integers) and decoded of every row.

    `path` is a SentencePiece BPE model that executors can open. Ids begin and
    end with the model's ids for that. Null is an empty text. Repeated rows and
    ids give one row each; other columns are ignored, whatever their names; an
    empty table gives none.
    """

    def work():
        pieces = load(path)
        ends = np.array([pieces.begin, pieces.end], "<u4")

        def run(texts):
            ids = [ends[:1].tobytes() + pieces.encode(t or "") + ends[1:].tobytes() for t in texts]
            return [[np.frombuffer(x, "<i4") for x in ids], [pieces.decode(x) for x in ids]]

        return run

    fields = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    return map_texts(docs, keys, fields, work, max_chars=1_000_000)


def digests(docs: DataFrame, path: str, keys: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row, as `encode_decode` gives them.

    The hashes are taken where the ids are made, so that ids needn't leave the
    task: of the ids as little-endian 32-bit integers, and of the decoded text.
    """

    def work():
        pieces = load(path)
        ends = np.array([pieces.begin, pieces.end], "<u4")
        begin, end = ends[:1].tobytes(), ends[1:].tobytes()

        def run(texts):
            counts, of_ids, of_texts = [], [], []
            for text in texts:
                ids = begin + pieces.encode(text or "") + end
                counts.append(len(ids) // 4)
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_texts.append(hashlib.sha256(pieces.decode(ids).encode("utf-8", "replace")).hexdigest())
            return [counts, of_ids, of_texts]

        return run

    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
    return map_texts(docs, keys, fields, work, max_chars=1_000_000)
