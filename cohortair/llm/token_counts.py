"""Token counts of byte-level BPE by finite-state transducers."""

from __future__ import annotations

import json
import sys
from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from regex import compile as pattern

from cohortair.llm.bpe import Vocabulary
from cohortair.llm.common import keeps, map_texts

# The splitting pattern of byte-level BPE knows these endings.
ENDINGS_1 = "stmd"
ENDINGS_2 = ("re", "ve", "ll")
START, LETTERS, DIGITS, OTHERS, SPACE, BLANK, SPACES, BLANKS, QUOTE, DONE = range(10)
FIRST_OF = {"r": 10, "v": 11, "l": 12}
STATES = 13
# Classes of characters; the letters of endings are classes of their own.
OTHER, LETTER, DIGIT, GAP, WHITE, APOSTROPHE = range(6)
ALPHABET = 6 + len("stmdrvle") + 1
RESET = ALPHABET - 1
CHUNK = 256
# After so many symbols from every state, nearly all chunks are in one state.
LEAD = 16
WORDS_KEPT = 1_000_000
STATES_KEPT = 400_000


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Transducer of the splitting pattern: next states, and marks of each transition.

    Mark 1: a piece starts at this character. Mark 2: one starts at the
    character before, which only this one decides (the last of several blanks
    belongs to what follows; so does r after an apostrophe unless e comes).
    """
    step = np.zeros((STATES, ALPHABET), np.uint8)
    mark = np.zeros((STATES, ALPHABET), np.uint8)
    letter = {c: 6 + i for i, c in enumerate("stmdrvle")}
    run_of = {OTHER: OTHERS, LETTER: LETTERS, DIGIT: DIGITS, GAP: SPACE, WHITE: BLANK, APOSTROPHE: QUOTE}
    run_of |= {c: LETTERS for c in letter.values()}
    for state in range(STATES):
        for sign in range(ALPHABET - 1):
            run, blank = run_of[sign], sign in (GAP, WHITE)
            to, marks = run, 1
            if state in (LETTERS, DIGITS, OTHERS):
                joins = run == state or (state == OTHERS and sign == APOSTROPHE)
                to, marks = (state, 0) if joins else (run, 1)
            elif state in (SPACE, BLANK, SPACES, BLANKS) and blank:
                to, marks = (SPACES if sign == GAP else BLANKS), 0
            elif state in (SPACE, SPACES):
                # The blank before joins the run; an apostrophe is then no ending.
                to, marks = (OTHERS if sign == APOSTROPHE else run), (0 if state == SPACE else 2)
            elif state == BLANKS:
                marks = 3
            elif state == QUOTE:
                name = next((c for c, k in letter.items() if k == sign), "")
                if name and name in ENDINGS_1:
                    to, marks = DONE, 0
                elif name in FIRST_OF:
                    to, marks = FIRST_OF[name], 0
                elif run in (OTHERS, QUOTE):
                    to, marks = OTHERS, 0
            elif state in FIRST_OF.values():
                first = next(c for c, k in FIRST_OF.items() if k == state)
                if any(sign == letter[x[1]] for x in ENDINGS_2 if x[0] == first):
                    to, marks = DONE, 0
                elif run == LETTERS:
                    to, marks = LETTERS, 2
                else:
                    marks = 3
            step[state, sign], mark[state, sign] = to, marks
        # A document ends: an ending left open was an apostrophe and a letter.
        step[state, RESET] = START
        mark[state, RESET] = 3 if state in FIRST_OF.values() else 1
    return step, mark


STEP, MARK = splitter()


@cache
def classes() -> np.ndarray:
    """Class of every code point."""
    table = np.zeros(sys.maxunicode + 2, np.uint8)
    points = "".join(map(chr, [*range(0xD800), *range(0xE000, sys.maxunicode + 1)]))
    for kind, found in ((LETTER, r"\p{L}"), (DIGIT, r"\p{N}"), (WHITE, r"\s")):
        hits = "".join(pattern(found + "+").findall(points))
        table[np.frombuffer(hits.encode("utf-32-le"), np.uint32)] = kind
    table[ord(" ")], table[ord("'")] = GAP, APOSTROPHE
    for i, c in enumerate("stmdrvle"):
        table[ord(c)] = 6 + i
    table[-1] = RESET
    return table


def scan(signs: np.ndarray) -> np.ndarray:
    """Marks of a stream of classes, by composing the state maps of its chunks.

    Every chunk is run from all states at once, all chunks in step; where they
    have met in one state, the rest is run from that one alone. The maps are
    composed by a prefix scan of doubling strides, which tells each chunk's
    true first state; a second run from there yields the marks.
    """
    chunks = -(-len(signs) // CHUNK)
    grid = np.full(chunks * CHUNK, RESET, np.uint8)
    grid[: len(signs)] = signs
    grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T).astype(np.intp)
    # States are kept multiplied by the size of the alphabet: a row of the table each.
    step = (STEP.astype(np.intp) * ALPHABET).ravel()
    maps = np.repeat(np.arange(STATES)[:, None] * ALPHABET, chunks, 1)
    for row in grid[:LEAD]:
        maps = step.take(maps + row)
    met = (maps == maps[0]).all(0)
    one, many = maps[0, met], maps[:, ~met]
    for row in grid[LEAD:]:
        one = step.take(one + row[met])
        many = step.take(many + row[~met])
    maps[:, met], maps[:, ~met] = one, many
    maps //= ALPHABET
    stride = 1
    while stride < chunks:
        # Chunk i's map becomes the map of all up to 2 * stride chunks that end with i.
        later = np.take_along_axis(maps[:, stride:], maps[:, :-stride], 0)
        maps = np.concatenate([maps[:, :stride], later], 1)
        stride *= 2
    state = np.full(chunks, START * ALPHABET, np.intp)
    state[1:] = maps[START, :-1] * ALPHABET
    marks, mark = np.empty(grid.shape, np.uint8), MARK.ravel()
    for i, row in enumerate(grid):
        at = state + row
        marks[i], state = mark.take(at), step.take(at)
    return marks.T.ravel()[: len(signs)]


def pieces(texts: list[str]) -> list[list[str]]:
    """The pieces that the splitting pattern cuts each text into."""
    stream = "\x00".join(texts) + "\x00"
    points = np.frombuffer(stream.encode("utf-32-le"), np.uint32)
    signs = classes()[points]
    ends = np.cumsum([len(t) + 1 for t in texts]) - 1
    signs[ends] = RESET
    marks = scan(signs)
    starts = (marks & 1).astype(bool)
    starts[:-1] |= (marks[1:] & 2).astype(bool)
    at = np.flatnonzero(starts)
    bounds = np.searchsorted(at, ends)
    at, out, first = at.tolist(), [], 0
    for last in bounds.tolist():
        cuts = at[first : last + 1]
        out.append([stream[a:b] for a, b in zip(cuts, cuts[1:])])
        first = last + 1
    return out


def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Transducer:
    """Deterministic transducer over bytes whose transitions carry token counts.

    A state stands for all prefixes that act alike: the tokens that match at
    its end, the last token of the encoding of the prefix and of those as many
    bytes shorter as a token may still reach back, and how many tokens fewer
    those have. States are compiled when first met; a transition adds the
    change of the count, so a piece's count is the sum along its path.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.clear()

    def clear(self):
        self.ids = {(b"", ((b"", 0),)): 0}
        self.states = [(b"", ((b"", 0),))]
        self.steps: dict[int, tuple[int, int]] = {}
        self.words: dict[str, int] = {}

    def compiled(self, state: int, byte: int) -> tuple[int, int]:
        """The transition of a state by a byte: next state and change of the count."""
        node, past = self.states[state]
        tail, sizes = self.vocabulary.reach(node, bytes((byte,)))
        for size in sizes:
            token = tail[len(tail) - size :]
            last, fewer = past[size - 1]
            if not last or self.vocabulary.pair(last, token):
                break
        change = fewer + 1
        # Later tokens start at most len(tail) bytes back.
        kept = ((token, 0), *[(t, n - change) for t, n in past[: len(tail)]])
        made = (tail, kept)
        to = self.ids.get(made)
        if to is None:
            to = self.ids[made] = len(self.states)
            self.states.append(made)
        return to, change

    def count(self, word: str) -> int:
        """Tokens of one piece, from its path through the transducer."""
        found = self.words.get(word)
        if found is None:
            if len(self.words) > WORDS_KEPT:
                self.words = {}
            if len(self.states) > STATES_KEPT:
                self.clear()
            steps, state, found = self.steps, 0, 0
            for byte in word.encode("utf-8", "replace"):
                key = state << 8 | byte
                step = steps.get(key)
                if step is None:
                    step = steps[key] = self.compiled(state, byte)
                state, change = step
                found += change
            self.words[word] = found
        return found


@cache
def load(path: str) -> tuple[Transducer, tuple[str, ...]]:
    """The transducer of a byte-level vocabulary file, and its added tokens."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    letters = byte_letters()
    spell = lambda token: bytes(letters[c] for c in token)
    ranks = {}
    for rank, merge in enumerate(spec["model"]["merges"]):
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        ranks.setdefault(spell(left + right), rank)
    added = tuple(t["content"] for t in spec.get("added_tokens", ()))
    return Transducer(Vocabulary(ranks)), added


keeps(__name__, load.cache_clear)


class Counter:
    """Counts tokens of whole texts as the library does without special tokens around them."""

    def __init__(self, path: str):
        self.transducer, added = load(path)
        longest = sorted(added, key=len, reverse=True)
        self.added = pattern("|".join(map(_escaped, longest))) if longest else None

    def __call__(self, texts: list[str | None]) -> list[int]:
        runs, owner, counts = [], [], [0] * len(texts)
        for i, text in enumerate(texts):
            if not text:
                continue
            text = text.encode("utf-8", "replace").decode() if not text.isprintable() else text
            parts = self.added.split(text) if self.added else [text]
            counts[i] = len(parts) - 1
            runs += parts
            owner += [i] * len(parts)
        if runs:
            count, known = self.transducer.count, self.transducer.words
            for i, words in zip(owner, pieces(runs)):
                try:
                    counts[i] += sum(map(known.__getitem__, words))
                except KeyError:
                    counts[i] += sum(map(count, words))
                    known = self.transducer.words
        return counts


def _escaped(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() else c for c in text)


def token_counts(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row.

    `path` is a byte-level BPE vocabulary file that executors can open. Added
    tokens inside a text count as one token each. Null is an empty text: no
    bytes, no tokens. Repeated rows and ids give one row each; other columns
    are ignored, whatever their names; an empty table gives none.
    """

    def work():
        counter = Counter(path)
        return lambda texts: [[len(t.encode("utf-8", "replace")) if t else 0 for t in texts], counter(texts)]

    fields = [T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType())]
    counts = map_texts(docs, ["doc_id"], fields, work, max_chars=500_000)
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
