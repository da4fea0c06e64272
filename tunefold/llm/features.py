"""Hashed text features for the classifiers, found for whole texts with a few array operations a block.

A token is a run of bytes that are no separators. Its features are hashes of the
whole token and of its first bytes (3 to 6), and, if asked for, of its last
three bytes together with how often the text has them (so a mark on one word
differs from a mark on every word), and the share of words that repeat the one
before. A text's features are the distinct ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from tunefold.llm.common import _VALUE, BLOCK_BYTES, _powers, mix

#: Buckets of hashed features.
BUCKETS = 1 << 18
PREFIXES = (3, 4, 5, 6)

_SPACES = np.zeros(256, bool)
_SPACES[[32, 9, 10, 11, 12, 13]] = True
#: ASCII bytes other than letters separate words; bytes of other scripts are letters.
_SIGNS = np.array([c < 128 and not chr(c).isalpha() for c in range(256)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SAME = np.arange(256, dtype=np.uint8)


class Features:
    """Finds distinct features of texts; ``style`` is "words" (letters, lower case) or "marks" (as written)."""

    def __init__(self, style: str):
        self.marks = style == "marks"
        self.separates = _SPACES if self.marks else _SIGNS
        self.fold = _SAME if self.marks else _LOWER
        self.slot = np.zeros(BUCKETS, np.int64)

    def _block(self, texts: list[bytes]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        a = np.frombuffer(b"\n" + b"\n".join(texts) + b"\n", np.uint8)
        gap = self.separates[a]
        edge = np.diff(gap.view(np.int8))
        starts, ends = np.flatnonzero(edge < 0) + 1, np.flatnonzero(edge > 0) + 1
        up, down = _powers(len(a) + 1)
        sums = np.r_[np.zeros(1, np.uint64), np.cumsum(_VALUE[self.fold[a]] * up[: len(a)])]

        def hashed(s: np.ndarray, e: np.ndarray, kind: int) -> np.ndarray:
            return mix((sums[e] - sums[s]) * down[s] + np.uint64(kind))

        size = ends - starts
        found = [hashed(starts, ends, 1)]
        for n in () if self.marks else PREFIXES:
            at = size > n
            h = hashed(starts, np.minimum(starts + n, ends), 10 + n)
            found.append(np.where(at, h, found[0]))
        last = hashed(np.maximum(ends - 3, starts), ends, 20) if self.marks else found[0]
        bounds = np.searchsorted(starts, np.cumsum([1, *(len(t) + 1 for t in texts)]))
        return found, last, bounds

    def _of_tokens(self, found: list[np.ndarray], last: np.ndarray) -> np.ndarray:
        """Distinct buckets of one text's tokens."""
        if self.marks and len(last):
            kind, count = np.unique(last, return_counts=True)
            share = np.clip(-np.log2(count / len(last)), 0, 6).astype(np.uint64)
            again = (found[0][1:] == found[0][:-1]).mean() if len(last) > 1 else 0.0
            often = np.array([900 + int(np.ceil(10 * again))], np.uint64)  # words that repeat the one before, in tenths
            found = [found[0], mix(kind * np.uint64(8) + share), mix(often)]
        idx = (np.concatenate(found) & np.uint64(BUCKETS - 1)).astype(np.int64)
        order = np.arange(len(idx))
        self.slot[idx] = order  # one of equal buckets stays
        return idx[self.slot[idx] == order]

    def of(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """The distinct feature buckets of each text."""
        if sum(map(len, texts)) <= 2 * BLOCK_BYTES:
            found, last, bounds = self._block(texts)
            for x, y in zip(bounds.tolist(), bounds[1:].tolist()):
                yield self._of_tokens([f[x:y] for f in found], last[x:y])
            return
        for t in texts:  # very long texts: in blocks that end at a separator, joined before they are counted
            parts, at = [], 0
            while at < len(t):
                end = min(len(t), at + BLOCK_BYTES)
                while end < len(t) and not self.separates[t[end]]:
                    end += 1
                parts.append(self._block([t[at:end]])[:2])
                at = end
            if not parts:
                yield np.zeros(0, np.int64)
                continue
            yield self._of_tokens([np.concatenate(c) for c in zip(*(p[0] for p in parts))], np.concatenate([p[1] for p in parts]))
