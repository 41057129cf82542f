"""A suffix automaton over many word sequences in arrays, with first occurrences.

The automaton's states are the nodes of the tree of all reversed prefixes:
sequences that end at the same places are one state, a state's suffix link is
its parent there, its length its depth. So it is built from the sorted
reversed prefixes (by prefix doubling) and how much neighbours share, without a
step a word, and sequences are streamed through it together, one word of each
at a time.

States carry the place at which their words occur first, so a sequence's
matching statistics tell, for every window of a given length, whether it
occurs somewhere earlier. Places are integers in corpus order. Work and
memory grow with words times the longest sequence's length at most; here
sequences are passages of a few windows.
"""

from __future__ import annotations

import numpy as np

_NOWHERE = np.iinfo(np.int64).max


def _reversed_ranks(letters: np.ndarray, offset: np.ndarray) -> list[np.ndarray]:
    """Level j: each word's rank by the 2^j words up to it, read backwards
    (fewer at a sequence's start); the last level reads all of them."""
    ranks = [np.unique(letters, return_inverse=True)[1] + 1]
    reach = 1
    while reach <= offset.max():
        before = np.zeros_like(ranks[-1])
        inside = np.flatnonzero(offset >= reach)
        before[inside] = ranks[-1][inside - reach]
        ranks.append(np.unique(ranks[-1] * (ranks[-1].max() + 1) + before, return_inverse=True)[1] + 1)
        reach *= 2
    return ranks


def _shared(ranks: list[np.ndarray], offset: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """How many words each of the sorted reversed prefixes shares with the one
    before it; -1 for the first, and once more behind the last."""
    a, b = ends[:-1].copy(), ends[1:].copy()
    left_a, left_b = offset[a] + 1, offset[b] + 1
    shared = np.zeros(len(a), dtype=np.int64)
    for j in range(len(ranks) - 1, -1, -1):
        equal = np.flatnonzero((left_a >= 1 << j) & (left_b >= 1 << j))
        equal = equal[ranks[j][a[equal]] == ranks[j][b[equal]]]
        shared[equal] += 1 << j
        for x in (a, b, left_a, left_b):
            x[equal] -= 1 << j
    return np.concatenate([[-1], shared, [-1]])


class SuffixAutomaton:
    """``letters``: all sequences' words as integers from 0, one sequence after
    the other; ``first``: where each begins, and the end; ``places``: every
    word's place in the corpus. State 0 is the empty one."""

    def __init__(self, letters: np.ndarray, first: np.ndarray, places: np.ndarray) -> None:
        self.letters, self.first, self.places = letters, first, places
        self.alphabet = int(letters.max(initial=0)) + 1
        offset = np.arange(len(letters)) - np.repeat(first[:-1], np.diff(first))
        if not len(letters):
            self.link, self.length, self.earliest = np.zeros(1, np.int64), np.zeros(1, np.int64), np.array([_NOWHERE])
            self._keys = self._targets = np.zeros(0, np.int64)
            return
        ranks = _reversed_ranks(letters, offset)
        _, ends, prefix = np.unique(ranks[-1], return_index=True, return_inverse=True)
        self._grow(_shared(ranks, offset, ends), offset[ends] + 1)
        state = prefix + 1  # the state of each word's whole prefix
        self.earliest = np.full(len(self.length), _NOWHERE)
        np.minimum.at(self.earliest, state, places)
        self._carry()
        self._connect(state, offset)

    def _grow(self, shared: np.ndarray, depth: np.ndarray) -> None:
        """States, lengths and links: a state for every reversed prefix (from
        1 on, in order) and for every stretch of them that shares more than its neighbours."""
        m = len(depth)
        # the stretch around each entry of ``shared`` and each prefix that shares as many words or more
        begin, stop = np.zeros(m + 1, np.int64), np.zeros(m, np.int64)
        index = np.arange(m + 1)
        for d in np.unique(np.concatenate([depth, shared[1:m]])):
            less = shared < d
            here = np.flatnonzero(shared[1:m] == d) + 1
            begin[here] = np.maximum.accumulate(np.where(less, index, 0))[here - 1]
            own = np.flatnonzero(depth == d)
            stop[own] = np.minimum.accumulate(np.where(less, index, m)[::-1])[::-1][own + 1]
        at = np.flatnonzero(shared[1:m] > 0) + 1
        # a stretch whose first prefix is as long as what is shared is that prefix's own state
        own = depth[begin[at]] == shared[at]
        key = begin[at] * (depth.max() + 1) + shared[at]
        inner, one, which = np.unique(key[~own], return_index=True, return_inverse=True)
        node = np.zeros(m + 1, np.int64)  # of each entry of ``shared``; 0: nothing shared
        node[at[own]] = begin[at[own]] + 1
        node[at[~own]] = m + 1 + which
        some = at[~own][one]
        inner_begin = begin[some]
        inner_stop = self._stops(shared, some)
        self.length = np.concatenate([[0], depth, shared[some]])
        lo, hi = np.concatenate([np.arange(m), inner_begin]), np.concatenate([stop, inner_stop])
        self.link = np.concatenate([[-1], node[np.where(shared[lo] >= shared[hi], lo, hi)]])

    @staticmethod
    def _stops(shared: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The next entry after each of ``at`` that is smaller than it."""
        out = np.zeros(len(at), np.int64)
        index = np.arange(len(shared))
        for d in np.unique(shared[at]):
            own = np.flatnonzero(shared[at] == d)
            after = np.minimum.accumulate(np.where(shared < d, index, len(shared) - 1)[::-1])[::-1]
            out[own] = after[at[own]]
        return out

    def _carry(self) -> None:
        """First occurrences from longer words to their suffixes."""
        order = np.argsort(-self.length, kind="stable")[:-1]  # all but state 0
        cuts = np.flatnonzero(np.diff(self.length[order])) + 1
        for states in np.split(order, cuts):
            np.minimum.at(self.earliest, self.link[states], self.earliest[states])

    def _connect(self, state: np.ndarray, offset: np.ndarray) -> None:
        """Transitions: a state's words and one more word end in another state.
        Prefixes know theirs; links carry them to shorter words."""
        follows = np.flatnonzero(offset > 0)
        starts = np.flatnonzero(offset == 0)
        key = np.concatenate([state[follows - 1] * self.alphabet + self.letters[follows], self.letters[starts]])
        to = np.concatenate([state[follows], state[starts]])
        keys, targets = [], []
        while len(key):
            key, one = np.unique(key, return_index=True)
            to = to[one]
            source = key // self.alphabet
            # the shortest state that holds the source's words and the letter
            short = np.flatnonzero(self.length[self.link[to]] > self.length[source])
            while len(short):
                to[short] = self.link[to[short]]
                short = short[self.length[self.link[to[short]]] > self.length[source[short]]]
            keys.append(key)
            targets.append(to)
            up = np.flatnonzero(source)
            key, to = self.link[source[up]] * self.alphabet + key[up] % self.alphabet, to[up]
        self._keys, one = np.unique(np.concatenate(keys), return_index=True)
        self._targets = np.concatenate(targets)[one]

    def _step(self, state: np.ndarray, letter: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the letters lead, and whether they lead anywhere."""
        if not len(self._keys):
            return state, np.zeros(len(state), dtype=bool)
        key = np.where(letter < self.alphabet, state * self.alphabet + letter, -1)
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return self._targets[at], self._keys[at] == key

    def earlier(self, letters: np.ndarray, first: np.ndarray, places: np.ndarray, window: int) -> np.ndarray:
        """Indices of the words in ``letters`` (sequences as in the
        constructor) at which a ``window`` ends that the automaton knows at an
        earlier place than the word's."""
        sizes = np.diff(first)
        state, matched = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        found = np.zeros(len(letters), dtype=bool)
        for i in range(int(sizes.max(initial=0))):
            live = np.flatnonzero(sizes > i)
            at = first[live] + i
            waiting, letter = live, letters[at]
            while len(waiting):
                to, leads = self._step(state[waiting], letter)
                hit, miss = waiting[leads], waiting[~leads]
                state[hit] = to[leads]
                matched[hit] += 1
                # no way on: shorter words; from the empty state there are none
                again = state[miss] > 0
                matched[miss[~again]] = 0
                waiting, letter = miss[again], letter[~leads][again]
                state[waiting] = self.link[state[waiting]]
                matched[waiting] = self.length[state[waiting]]
            # the matching statistic beyond the window says nothing more: stay at the window's own state
            long = live[matched[live] >= window]
            climb = long[self.length[self.link[state[long]]] >= window]
            while len(climb):
                state[climb] = self.link[state[climb]]
                climb = climb[self.length[self.link[state[climb]]] >= window]
            matched[long] = np.minimum(matched[long], self.length[state[long]])
            ends = first[long] + i
            found[ends] = self.earliest[state[long]] < places[ends]
        return np.flatnonzero(found)
