"""Generalised suffix automaton over word ids, packed into numpy arrays."""

from __future__ import annotations

import numpy as np


class Automaton:
    """Built from word sequences; ``step`` follows the longest suffix of the words seen that occurs in any of them."""

    FIELDS = ("length", "link", "keys", "to")

    def __init__(self, length: np.ndarray, link: np.ndarray, keys: np.ndarray, to: np.ndarray, words: int):
        self.length, self.link, self.keys, self.to, self.words = length, link, keys, to, words
        self._seen: dict[int, int] = {}  # transitions looked up so far

    @classmethod
    def build(cls, sequences: list[list[int]], words: int) -> Automaton:
        length, link, edges = [0], [-1], [{}]

        def extend(last: int, w: int) -> int:
            q = edges[last].get(w)
            if q is not None and length[q] == length[last] + 1:
                return q  # an earlier sequence has this prefix already
            cur = None
            if q is None:
                cur = len(length)
                length.append(length[last] + 1)
                link.append(0)
                edges.append({})
            p = last
            while p != -1 and w not in edges[p]:
                edges[p][w] = cur
                p = link[p]
            if p == -1:
                return cur
            q = edges[p][w]
            if length[q] != length[p] + 1:
                split = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                edges.append(dict(edges[q]))
                link[q] = split
                while p != -1 and edges[p].get(w) == q:
                    edges[p][w] = split
                    p = link[p]
                q = split
            if cur is None:
                return q
            link[cur] = q
            return cur

        for s in sequences:
            last = 0
            for w in s:
                last = extend(last, w)
        keys = np.array([s * words + w for s, e in enumerate(edges) for w in e], np.int64)
        to = np.array([t for e in edges for t in e.values()], np.int32)
        order = np.argsort(keys)
        return cls(np.array(length, np.int32), np.array(link, np.int32), keys[order], to[order], words)

    def next(self, state: int, word: int) -> int:
        """The state after ``word``, -1 if there is none."""
        key = state * self.words + word
        t = self._seen.get(key)
        if t is None:
            i = int(np.searchsorted(self.keys, key))
            t = int(self.to[i]) if i < len(self.keys) and self.keys[i] == key else -1
            if len(self._seen) > 1_000_000:
                self._seen.clear()
            self._seen[key] = t
        return t

    def step(self, state: int, matched: int, word: int) -> tuple[int, int]:
        t = self.next(state, word)
        while t < 0 and state > 0:
            state = int(self.link[state])
            matched = int(self.length[state])
            t = self.next(state, word)
        return (t, matched + 1) if t >= 0 else (0, 0)

    def at_length(self, n: int) -> np.ndarray:
        """For every state of length n or more: the suffix state that holds its suffix of length n; else -1."""
        out = np.full(len(self.length), -1, np.int32)
        for s in np.argsort(self.length, kind="stable").tolist():
            if self.length[s] >= n:
                p = int(self.link[s])
                out[s] = s if self.length[p] < n else out[p]
        return out
