"""A minimal perfect hash over a fixed set of byte strings.

Keys are thrown into a bitmap; those that sit alone in their cell are placed, the others go on to
the next, smaller bitmap.  The rank of a key's cell among all set cells is its index, so n keys get
the indices 0 to n-1.  Looking up works on whole arrays of keys.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash


def hashes(words: Sequence[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), "u8", len(words))


def _mixed(h: np.ndarray, level: int) -> np.ndarray:
    x = h + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class MinimalPerfectHash:
    """``find`` gives the place of each word in ``keys`` (a reordered copy), or -1 if it is none."""

    def __init__(self, words: Sequence[bytes], gamma: float = 2.0) -> None:
        h = hashes(words)
        if len(np.unique(h)) != len(words):
            raise ValueError("keys repeat, or two of them share a 64-bit hash")
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        placed, left, base = [], np.arange(len(words)), 0
        while len(left):
            cells = max(64, int(gamma * len(left)))
            at = (_mixed(h[left], len(self.levels)) % np.uint64(cells)).astype("i8")
            alone = np.bincount(at, minlength=cells) == 1
            ranks = (base + np.cumsum(alone) - 1).astype("i4")
            self.levels.append((cells, alone, ranks))
            lucky = alone[at]
            placed.append(left[lucky][np.argsort(at[lucky])])
            base += int(lucky.sum())
            left = left[~lucky]
        self.order = np.concatenate(placed) if placed else np.zeros(0, "i8")
        self.keys = [words[i] for i in self.order]

    def find(self, words: Sequence[bytes]) -> np.ndarray:
        found, left = np.full(len(words), -1, "i8"), np.arange(len(words))
        h = hashes(words)
        for level, (cells, alone, ranks) in enumerate(self.levels):
            at = (_mixed(h[left], level) % np.uint64(cells)).astype("i8")
            hit = alone[at]
            found[left[hit]] = ranks[at[hit]]
            left = left[~hit]
            if not len(left):
                break
        # The hash sends words that are no keys somewhere too: only equal bytes count.
        keys = self.keys
        wrong = [i for i, k in enumerate(found.tolist()) if k >= 0 and keys[k] != words[i]]
        found[wrong] = -1
        return found
