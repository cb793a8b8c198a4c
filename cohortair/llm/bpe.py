"""Byte pair encoding: merges, matches and the test of neighbouring tokens."""

from __future__ import annotations

from collections.abc import Callable

# What a task keeps at most of what it has worked out; the rest is worked out again.
MOVES_KEPT = 200_000
PAIRS_KEPT = 400_000
LAST = float("inf")


class Vocabulary:
    """Merges of a BPE vocabulary and the pair test of its encodings.

    `ranks` tells in which order tokens form, lower first; single symbols,
    bytes or characters, need none. `value` is what `encoded` gives for a token.
    """

    def __init__(self, ranks: dict, value: Callable = lambda token: token):
        self.ranks = ranks
        self.value = value
        self.parts: dict = {}
        self.edges: dict = {}
        self.fits: dict = {}
        # Every prefix of a token is a node of the automaton.
        self.nodes = {t[:i] for t in ranks for i in range(len(t) + 1)}
        self.moves: dict = {}
        self.forget()

    def merge(self, text, until: int = 1) -> list:
        """Encoding by its definition: the lowest merge first, the leftmost of equal ones."""
        parts = [text[i : i + 1] for i in range(len(text))]
        ranks = self.ranks
        while len(parts) > until:
            found = [(ranks.get(a + b), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            found = [x for x in found if x[0] is not None]
            if not found:
                break
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return parts

    def edge(self, token, right: bool) -> list[tuple]:
        """What stands at a token's right or left edge while it is built, from the symbol up.

        Each with the rank at which it is merged into the next one: that of the
        merge, or of the latest merge that its other part needs.
        """
        known = self.edges.get((token, right))
        if known is None:
            known, at, rank = [], token, LAST
            while True:
                known.append((at, rank))
                if len(at) < 2:
                    break
                parts, rank = self.built(at)
                at = parts[right]
            known.reverse()
            if len(self.edges) > PAIRS_KEPT:
                self.edges.clear()
            self.edges[token, right] = known
        return known

    def built(self, token) -> tuple:
        """The two parts that a token is made of, and the rank at which it is there."""
        known = self.parts.get(token)
        if known is None:
            left, right = self.merge(token, 2)
            ranks = [self.built(x)[1] for x in (left, right) if len(x) > 1]
            known = self.parts[token] = ((left, right), max([self.ranks[token], *ranks]))
        return known

    def pair(self, left, right) -> bool:
        """Whether the two tokens stay as they are where they meet.

        They do if no merge across the border comes first while they are
        built: what stands at the border is followed from symbols to tokens.
        """
        known = self.fits.get((left, right))
        if known is None:
            known = self.meet(left, right)
            if len(self.fits) > PAIRS_KEPT:
                self.fits.clear()
            self.fits[left, right] = known
        return known

    def meet(self, left, right) -> bool:
        """The pair test itself, nothing kept but edges."""
        ranks = self.ranks
        a = self.edges.get((left, True)) or self.edge(left, True)
        b = self.edges.get((right, False)) or self.edge(right, False)
        i = j = 0
        while True:
            (u, up), (v, down) = a[i], b[j]
            across = ranks.get(u + v)
            if across is not None and across < up and across <= down:
                return False
            if up is LAST and down is LAST:
                return True
            if up <= down:
                i += 1
            else:
                j += 1

    def reach(self, node, symbol) -> tuple:
        """The automaton's next node, and the sizes of tokens that match at its end.

        A node is the longest end of what was read that begins a token. Single
        symbols always match, whether tokens have them or not.
        """
        found = self.moves.get((node, symbol))
        if found is None:
            if len(self.moves) > MOVES_KEPT:
                self.moves.clear()
            found = self.moves[node, symbol] = self.move(node, symbol)
        return found

    def move(self, node, symbol) -> tuple:
        """The same, worked out."""
        tail = node + symbol
        while len(tail) > 1 and tail not in self.nodes:
            tail = tail[1:]
        ranks = self.ranks
        sizes = tuple(k for k in range(len(tail), 1, -1) if tail[len(tail) - k :] in ranks)
        return tail, (*sizes, 1)

    def forget(self) -> None:
        """Empties what `encoded` keeps; numbers dealt before no longer hold."""
        self.tokens: list = []
        self.values: list = []
        self.backs: list = []
        self.numbered: dict = {}
        # Moves point at states and states at moves: taken apart, they go at once.
        for state in getattr(self, "states", {}).values():
            state.clear()
        self.states: dict = {}
        self.held = 0

    def numbers(self, token) -> tuple:
        """A token's size (negative), its number, and by the number before it whether the two stay as they are."""
        found = self.numbered.get(token)
        if found is None:
            # No token stands before the first one.
            found = self.numbered[token] = (-len(token), len(self.tokens), {-1: True})
            self.tokens.append(token)
            self.values.append(self.value(token))
            self.backs.append(-len(token))
        return found

    def state(self, node) -> dict:
        """By symbol the moves known from a node, each the next state and the tokens that match; the node itself at None."""
        found = self.states.get(node)
        if found is None:
            found = self.states[node] = {None: node}
        return found

    def step(self, state: dict, symbol) -> tuple:
        """A move that the state doesn't know yet."""
        node = state[None]
        tail, sizes = self.move(node, symbol)
        read = node + symbol
        found = state[symbol] = self.state(tail), tuple(self.numbers(read[len(read) - k :]) for k in sizes)
        self.held += 1
        return found

    def encoded(self, text) -> list:
        """What `value` gives for each token of the encoding, from the last one to the first.

        The last token of the encoding of each prefix is worked out in turn;
        there is exactly one. Of the tokens that match at the end of a prefix,
        it is the one that is the whole prefix or stays as it is next to the
        last token of the prefix before it.
        """
        if self.held > PAIRS_KEPT:
            self.forget()
        state, last, tokens = self.state(text[:0]), [-1], self.tokens
        for symbol in text:
            move = state.get(symbol)
            if move is None:
                move = self.step(state, symbol)
            state, matches = move
            for back, number, fits in matches:
                before = last[back]
                fit = fits.get(before)
                if fit is None:
                    fit = fits[before] = self.meet(tokens[before], tokens[number])
                    self.held += 1
                if fit:
                    break
            last.append(number)
        found, backs, values, at = [], self.backs, self.values, -1
        end = -len(last)
        while at > end:
            number = last[at]
            found.append(values[number])
            at += backs[number]
        return found
