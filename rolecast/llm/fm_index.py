"""FM-index of word sequences in a wavelet matrix, searched for many patterns at once.

The texts are short sequences of words, each followed by a separator of its own; suffixes
are sorted by prefix doubling. The words before the sorted suffixes (the BWT) are kept as
one bit vector per bit of their numbers, with counts per 64 bits: log2(words) bits a word."""

from __future__ import annotations

import numpy as np


class Bits:
    """A bit vector with rank queries."""

    def __init__(self, bits: np.ndarray):
        padded = np.zeros((len(bits) // 64 + 1) * 64, bool)
        padded[: len(bits)] = bits
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int64)
        self.before = np.cumsum(counts) - counts

    def rank(self, places: np.ndarray) -> np.ndarray:
        """Set bits before each place."""
        at = places >> 6
        below = (np.uint64(1) << (places & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[at] + np.bitwise_count(self.words[at] & below)


class WaveletMatrix:
    def __init__(self, symbols: np.ndarray, top: int):
        """`symbols` are 0 .. top."""
        self.levels = []
        for shift in range(max(1, int(top).bit_length()) - 1, -1, -1):
            ones = (symbols >> shift) & 1 == 1
            self.levels.append((shift, Bits(ones), int(len(symbols) - ones.sum())))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.starts = self._walk(np.arange(top + 1), np.zeros(top + 1, np.int64))

    def _walk(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        for shift, bits, zeros in self.levels:
            ones = bits.rank(places)
            places = np.where((symbols >> shift) & 1 == 1, zeros + ones, places - ones)
        return places

    def rank(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before its place."""
        return self._walk(symbols, places) - self.starts[symbols]


def _dense(keys: np.ndarray) -> np.ndarray:
    """Rank of each key among the distinct keys."""
    order = np.argsort(keys, kind="stable")
    sorted_ = keys[order]
    ranks = np.empty(len(keys), np.int64)
    ranks[order] = np.cumsum(np.concatenate([[0], sorted_[1:] != sorted_[:-1]]))
    return ranks


def _joined(left: np.ndarray, right: np.ndarray, by: int) -> np.ndarray:
    """Keys that order suffixes by `left`, then by `right` of the suffix `by` words on."""
    later = np.zeros(len(left), np.int64)
    later[: len(left) - by] = right[by:] + 1
    return left * (len(left) + 1) + later


class WordIndex:
    """Index of fragments (lists of words) with weights, for windows of `width` words.

    Fragments have at most 2 * width words."""

    def __init__(self, fragments: list[list[bytes]], weights: np.ndarray, width: int):
        self.width = width
        numbers: dict[bytes, int] = {}
        flat = [numbers.setdefault(word, len(numbers) + 1) for words in fragments for word in words]
        sizes = np.array([len(words) for words in fragments], np.int64)
        self.first = np.cumsum(sizes + 1) - sizes - 1  # place of each fragment
        self.sizes = sizes
        total = len(flat) + len(fragments)
        self.text = np.zeros(total, np.int64)  # 0 is any separator
        inside = np.ones(total, bool)
        inside[self.first + sizes] = False
        self.text[inside] = flat
        ranks = self.text + len(fragments)
        ranks[~inside] = np.arange(len(fragments))
        ranks, depth = _dense(ranks), 1
        group = None
        while depth <= 2 * width:
            if group is None and 2 * depth >= width - 1:  # two overlapping parts make width - 1 words
                group = _dense(_joined(ranks, ranks, width - 1 - depth))
            ranks = _dense(_joined(ranks, ranks, depth))
            depth *= 2
        order = np.argsort(ranks)
        self.before = self.text[order - 1]
        self.matrix = WaveletMatrix(self.before, len(numbers))
        counts = np.bincount(self.text, minlength=len(numbers) + 2)
        self.smaller = np.cumsum(counts) - counts
        owner = np.repeat(np.arange(len(fragments)), sizes + 1)
        self.weight_before = np.concatenate([[0], np.cumsum(weights[owner[order]] * inside[order])])
        same = group[order]
        edges = np.concatenate([[True], same[1:] != same[:-1]])
        starts = np.flatnonzero(edges)
        run = np.cumsum(edges) - 1
        self.group_low, self.group_high = starts[run], np.append(starts[1:], total)[run]

    def extend(self, words: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of the patterns with one more word before them."""
        base = self.smaller[words]
        return base + self.matrix.rank(words, low), base + self.matrix.rank(words, high)

    def weight(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        return self.weight_before[high] - self.weight_before[low]

    def repeated(self) -> tuple[np.ndarray, np.ndarray]:
        """Fragment and start (in the fragment) of each window of weight two or more.

        Every fragment is streamed through the index from right to left. A pattern grows a
        word at a time while its weight is two or more; at `width` words the window is
        reported, and its last word goes, which leaves the interval of all suffixes with the
        same width - 1 words. If it cannot grow, the next window to the left starts anew.
        Windows with a word that stands nowhere else are passed over."""
        counts = self.smaller[self.text], self.smaller[self.text + 1]
        lonely = np.concatenate([[0], np.cumsum(self.weight(*counts) < 2)])  # separators weigh nothing
        starts = np.arange(len(self.text))
        ends = np.minimum(starts + self.width, len(self.text))
        alive = (ends - starts == self.width) & (lonely[ends] == lonely[starts])
        # each run of neighbouring windows is one search, from its last window to its first
        last = np.flatnonzero(alive & ~np.append(alive[1:], False))
        lane = {"start": last, "length": np.zeros(len(last), np.int64)}
        lane["low"], lane["high"] = np.zeros(len(last), np.int64), np.full(len(last), len(self.text))
        found = np.zeros(len(self.text), bool)
        while len(lane["start"]):
            place = lane["start"] + self.width - 1 - lane["length"]
            low, high = self.extend(self.text[place], lane["low"], lane["high"])
            grown = self.weight(low, high) >= 2
            length = np.where(grown, lane["length"] + 1, 0)
            full = length == self.width
            found[lane["start"][full]] = True
            low, high = np.where(grown, low, 0), np.where(grown, high, len(self.text))
            low, high = np.where(full, self.group_low[np.minimum(low, len(self.text) - 1)], low), np.where(full, self.group_high[np.minimum(low, len(self.text) - 1)], high)
            start = lane["start"] - (full | ~grown)
            going = (start >= 0) & alive[start]
            lane = {"start": start, "length": np.where(full, self.width - 1, length), "low": low, "high": high}
            lane = {name: values[going] for name, values in lane.items()}
        at = np.flatnonzero(found)
        fragment = np.searchsorted(self.first, at, side="right") - 1
        return fragment, at - self.first[fragment]
