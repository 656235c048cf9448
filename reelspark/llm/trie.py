"""A two-level n-gram trie in Elias-Fano form, memory-mapped, with quantised probabilities."""
from __future__ import annotations

import os

import numpy as np


class Monotone:
    """A non-decreasing sequence in Elias-Fano form: low bits as they are, high parts in unary.

    A directory, read off the zeros of the unary part, says where the elements of each high part start; there are
    16 elements to a high part on average. `find` is the successor search: within one high part, by halves."""

    def __init__(self, folder: str, name: str, values: np.ndarray, universe: int):
        n = len(values)
        bits = max(0, int(universe).bit_length() - max(n, 1).bit_length()) + 4
        self.n, self.shift, self.top = n, bits, int(universe) >> bits
        high = (values >> bits).astype(np.int64)
        unary = np.zeros(n + self.top + 1, np.uint8)
        unary[high + np.arange(n)] = 1
        kind = next(t for t, size in ((np.uint8, 8), (np.uint16, 16), (np.uint32, 32), (np.uint64, 64)) if bits <= size)
        self.low = _mapped(folder, f"{name}.low", (values & ((1 << bits) - 1)).astype(kind))
        self.unary = _mapped(folder, f"{name}.high", np.packbits(unary, bitorder="little"))
        zeros = np.flatnonzero(np.unpackbits(self.unary, count=len(unary), bitorder="little") == 0)
        self.starts = np.append(0, zeros - np.arange(len(zeros)))

    def find(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the first element not below each value (all below the universe), and whether it is the value."""
        high = values >> self.shift
        low, end = self.starts[high], self.starts[high + 1]
        target = (values & ((1 << self.shift) - 1)).astype(self.low.dtype)
        stop = end.copy()
        open_ = np.flatnonzero(low < stop)
        while open_.size:
            a, b = low[open_], stop[open_]
            mid = (a + b) >> 1
            less = self.low[mid] < target[open_]
            low[open_], stop[open_] = np.where(less, mid + 1, a), np.where(less, b, mid)
            open_ = open_[low[open_] < stop[open_]]
        same = np.zeros(len(values), bool)
        there = np.flatnonzero(low < end)
        same[there] = self.low[low[there]] == target[there]
        return low, same


def _mapped(folder: str, name: str, values: np.ndarray) -> np.ndarray:
    path = os.path.join(folder, f"{name}.npy")
    np.save(path, values)
    return np.load(path, mmap_mode="r" if values.size else None)


class Quantised:
    """Positive numbers as 16-bit codes on an even logarithmic scale; code 0 is the number 0."""

    def __init__(self, values: np.ndarray):
        logs = np.log(values) if len(values) else np.zeros(1)
        self.low, self.step = float(logs.min()), max(float(np.ptp(logs)) / 65_534, 1e-12)
        self.codes = (1 + np.rint((logs - self.low) / self.step)).astype(np.uint16) if len(values) else np.zeros(0, np.uint16)


def numbers(codes: np.ndarray, low: float, step: float) -> np.ndarray:
    return np.where(codes > 0, np.exp(low + (codes.astype(np.float64) - 1) * step), 0.0)


class Trie:
    """Contexts with their followers; discounted probabilities and the mass left to the lower order."""

    def __init__(self, folder: str, context: np.ndarray, follower: np.ndarray, count: np.ndarray, discount: float):
        """Counts above 0 of (context, follower) pairs, ordered by both."""
        heads, starts = np.unique(context, return_index=True)
        ends = np.append(starts[1:], len(context))
        total = np.add.reduceat(count, starts) if len(count) else np.zeros(0, np.int64)
        place = np.repeat(np.arange(len(heads)), ends - starts)
        self.span = int(follower.max()) + 1 if len(follower) else 1
        self.last = int(heads[-1]) if len(heads) else -1
        self.heads = Monotone(folder, "heads", heads, self.last + 1)
        # A context's followers rise; counted on from the context's place, all followers of all contexts do.
        self.followers = Monotone(folder, "followers", place * self.span + follower, max(len(heads), 1) * self.span)
        share = Quantised((count - discount) / total[place])
        left = Quantised(discount * (ends - starts) / total)
        self.share, self.share_scale = _mapped(folder, "share", share.codes), (share.low, share.step)
        self.left, self.left_scale = _mapped(folder, "left", left.codes), (left.low, left.step)

    def query(self, head: np.ndarray, lengths: np.ndarray, follower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the shares of (head, follower) pairs, 0 where unseen, and of the mass left of every head, 0 where unseen."""
        at, known = self.heads.find(np.minimum(head, max(self.last, 0)))
        known &= head <= self.last
        left = np.zeros(len(head), np.uint16)
        left[known] = self.left[at[known]]
        place, usable = np.repeat(at, lengths), np.repeat(known, lengths) & (follower < self.span)
        codes = np.zeros(len(follower), np.uint16)
        asked = np.flatnonzero(usable)
        if asked.size:
            found, same = self.followers.find(place[asked] * self.span + follower[asked])
            codes[asked[same]] = self.share[found[same]]
        return codes, left
