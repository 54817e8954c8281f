"""Byte-pair merges replayed over many words at once.

All words of a block lie in one flat array of tokens. An inverted index holds, for each
merge that can happen, the positions of its left token. Merges are applied in rank
order, each to all of its positions together, and only the pairs that touch a merged token are
looked up again and enter the index.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

import numpy as np


class Merges:
    """The merges of a vocabulary: which pair becomes which token, and in which order.

    ``pairs`` maps (left token, right token) to a rank, ``token_of`` maps a rank to the token.
    """

    def __init__(self, pairs: dict[tuple[int, int], int], token_of: np.ndarray):
        self._base = int(max(token_of.max(initial=0), max((max(p) for p in pairs), default=0))) + 1
        keys = np.fromiter((a * self._base + b for a, b in pairs), dtype=np.int64, count=len(pairs))
        order = np.argsort(keys)
        self._keys = np.append(keys[order], np.iinfo(np.int64).max)
        ranks = np.fromiter(pairs.values(), dtype=np.int32, count=len(pairs))
        self._ranks = np.append(ranks[order], -1).astype(np.int32)
        self._token_of = token_of.astype(np.int32)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) * self._base + right
        places = np.searchsorted(self._keys, keys)
        return np.where(self._keys[places] == keys, self._ranks[places], -1)

    def replay(self, first: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words in a row, and the number of tokens of each word.

        ``first`` has the tokens that all words begin with (bytes or characters) in a row, and
        ``lengths`` how many of them belong to each word, at least one.
        """
        n = len(first)
        if not n:
            return np.zeros(0, np.int32), np.zeros(len(lengths), np.int64)
        token = np.empty(n + 1, dtype=np.int32)
        token[:n] = first
        token[n] = -1  # stands before the first and behind the last token of every word
        ends = np.cumsum(lengths)
        starts = ends - lengths
        after = np.arange(1, n + 2, dtype=np.int32)
        after[ends - 1] = n
        after[n] = n
        before = np.arange(-1, n, dtype=np.int32)
        before[starts] = n
        before = np.append(before, np.int32(n))
        alive = np.ones(n, dtype=bool)
        merged = np.zeros(n + 1, dtype=bool)
        merged[n] = True  # the edge of a word is never looked at
        # The rank of the pair that starts at each position, -1 where none can be merged.
        rank = np.full(n + 1, -1, dtype=np.int32)
        inner = np.flatnonzero(after[:n] < n)
        rank[inner] = self._rank(token[inner], token[inner + 1])
        index: dict[int, list[np.ndarray]] = {}
        heap: list[int] = []
        self._enter(index, heap, inner, rank[inner])
        irregular: list[np.ndarray] = []
        while heap:
            r = heapq.heappop(heap)
            parts = index.pop(r)
            here = parts[0] if len(parts) == 1 else np.sort(np.concatenate(parts))
            here = here[rank[here] == r]
            if not here.size:
                continue
            if here.size > 1 and (rank[after[here]] == r).any():
                here = _leftmost(here, after)
            taken = after[here]
            beyond = after[taken]
            token[here] = self._token_of[r]
            alive[taken] = False
            rank[taken] = -1
            after[here] = beyond
            before[beyond] = here
            before[n] = n
            left = before[here]
            merged[here] = True
            touched = np.concatenate([here, left[~merged[left]]])
            merged[here] = False
            follow = after[touched]
            inside = follow < n
            fresh = np.full(touched.size, -1, dtype=np.int32)
            if inside.any():
                fresh[inside] = self._rank(token[touched[inside]], token[follow[inside]])
            rank[touched] = fresh
            possible = fresh >= 0
            if possible.any():
                touched, fresh = touched[possible], fresh[possible]
                if (fresh < r).any():
                    irregular.append(touched[fresh < r])
                self._enter(index, heap, touched, fresh)
        out, counts = token[:n][alive], np.add.reduceat(alive, starts, dtype=np.int64)
        if irregular:
            # A merge made an earlier one possible. Applying all positions together may then
            # differ from going from left to right, so these words are done one by one.
            redo = np.unique(np.searchsorted(ends, np.concatenate(irregular), side="right"))
            pieces = np.split(out, np.cumsum(counts)[:-1])
            for w in redo:
                pieces[w] = np.asarray(self.merge_one(first[starts[w] : ends[w]]), dtype=np.int32)
                counts[w] = len(pieces[w])
            out = np.concatenate(pieces)
        return out, counts

    @staticmethod
    def _enter(index: dict, heap: list, positions: np.ndarray, ranks: np.ndarray) -> None:
        known = ranks >= 0
        positions, ranks = positions[known], ranks[known]
        if not ranks.size:
            return
        if ranks.size > 1:
            order = np.argsort(ranks, kind="stable")
            positions, ranks = positions[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        bounds = [0, *cuts.tolist(), ranks.size]
        for a, b in zip(bounds, bounds[1:]):
            r = int(ranks[a])
            if r in index:
                index[r].append(positions[a:b])
            else:
                index[r] = [positions[a:b]]
                heapq.heappush(heap, r)

    def merge_one(self, word: Sequence[int]) -> list[int]:
        """The same for a single word, the leftmost pair of lowest rank first."""
        tokens = np.asarray(word, dtype=np.int32)
        while len(tokens) > 1:
            ranks = self._rank(tokens[:-1], tokens[1:])
            known = np.flatnonzero(ranks >= 0)
            if not known.size:
                break
            i = int(known[np.argmin(ranks[known])])
            tokens = np.concatenate([tokens[:i], self._token_of[ranks[i : i + 1]], tokens[i + 2 :]])
        return tokens.tolist()


def _leftmost(here: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Of positions that overlap their neighbours, every one that going from left to right would take."""
    kept, gone = [], -1
    for p, q in zip(here.tolist(), after[here].tolist()):
        if p != gone:
            kept.append(p)
            gone = q
    return np.asarray(kept, dtype=here.dtype)
