"""Burrows-Wheeler transform and common prefixes of many short strings, built column by column.

Each round inserts one symbol a string, from its last to its first: the suffix that is one longer. Long strings begin
first, so that all end in the same round and no finished string is carried along. A new suffix stands where the symbol
put before the last one sorts, so its place follows from counting symbols in the transform so far; the prefix it
shares with its neighbours is one more than the least common prefix between their places in the round before.
Transform and prefixes live in two files, read and written from front to back once a round.
"""

from __future__ import annotations

import tempfile

import numpy as np

END = 0  # of a string; symbols are bytes + 1, which fits as UTF-8 has no byte above 244


class ColumnwiseIndex:
    """Suffixes of ``texts`` (UTF-8 bytes) in order, with common prefixes counted up to ``longest`` (at most 254)."""

    def __init__(self, texts: list[bytes], longest: int):
        self.longest = longest
        self.lengths = np.array([len(text) for text in texts], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.symbols = np.frombuffer(b"".join(texts), np.uint8) + np.uint8(1)
        with tempfile.TemporaryFile() as transform, tempfile.TemporaryFile() as prefixes:
            self.files = transform, prefixes
            self._build()
            self.transform, self.prefixes = map(read, self.files)

    def _before(self, strings: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The symbol in front of each string's suffix of the given length."""
        found = np.full(len(strings), END, np.uint8)
        inside = self.lengths[strings] > lengths
        found[inside] = self.symbols[self.ends[strings[inside]] - lengths[inside] - 1]
        return found

    def _build(self) -> None:
        count, rounds = len(self.lengths), int(self.lengths.max(initial=0))
        self.counts = np.bincount([END], minlength=256) * count
        for file in self.files:  # the empty suffixes come first, in order of the strings
            write(file, np.zeros(count, np.uint8))
        idle = rounds - self.lengths
        by_start = np.argsort(idle, kind="stable")
        bounds = np.searchsorted(idle[by_start], np.arange(rounds + 1))
        strings, places = np.zeros(0, np.int64), np.zeros(0, np.int32)
        for number in range(rounds):
            starting = by_start[bounds[number] : bounds[number + 1]]
            strings, places = np.concatenate([strings, starting]), np.concatenate([places, starting])
            last = self._before(starting, np.zeros(len(starting), np.int64))
            places = self._insert(places, self._before(strings, number + 1 - idle[strings]), count, starting, last)

    def _insert(
        self, places: np.ndarray, before: np.ndarray, count: int, starting: np.ndarray, last: np.ndarray
    ) -> np.ndarray:
        """Put in one suffix for each of ``places``, in front of which ``before`` stands; returns the new places.

        ``last`` are the last symbols of the strings ``starting``, whose empty suffixes had none in front so far.
        """
        transform, prefixes = map(read, self.files)
        transform[starting] = last
        self.counts += np.bincount(last, minlength=256)
        self.counts[END] -= len(last)
        sorted_runs = SortedRuns(transform)
        rank, left, right = sorted_runs.neighbours(places)
        ended = int(self.counts[END])
        new_places = rank - ended + count

        # Prefixes shared with the neighbours in the new order, where these start with the same symbol.
        own = transform[places]
        pairs = np.concatenate([left, places]), np.concatenate([places, right])
        spots = np.concatenate([new_places, new_places + 1])
        alike = np.concatenate([(left >= 0) & (transform[left] == own), (right >= 0) & (transform[right] == own)])
        least = least_between(prefixes, pairs[0][alike], pairs[1][alike])
        shared = np.minimum(least, self.longest - 1) + np.uint8(1)

        size = len(transform) - ended + count
        old = np.ones(size, bool)
        old[new_places] = False
        merged = np.empty(size, np.uint8)
        merged[old] = transform
        merged[new_places] = before
        write(self.files[0], merged)
        merged[old] = prefixes
        merged[new_places] = 0
        merged[spots[~alike & (spots < size)]] = 0
        merged[spots[alike]] = shared
        write(self.files[1], merged)
        self.counts += np.bincount(before, minlength=256)
        return new_places

    def repeated(self, length: int) -> list[np.ndarray]:
        """For each string, where the suffixes start whose first ``length`` symbols are those of another suffix."""
        transform, count = self.transform, len(self.lengths)
        order = np.argsort(transform, kind="stable")
        follow = np.empty(len(order), np.int32)
        follow[order] = np.arange(len(order), dtype=np.int32)
        follow += np.int32(count - int((transform == END).sum()))
        like_before = self.prefixes >= length
        marked = like_before.copy()
        marked[:-1] |= like_before[1:]
        strings, places = np.arange(count), np.arange(count)
        hits, starts = [], []
        for size in range(1, int(self.lengths.max(initial=0)) + 1):
            inside = self.lengths[strings] >= size
            strings, places = strings[inside], places[inside]
            places = follow[places]
            if size >= length:
                hit = strings[marked[places]]
                hits.append(hit)
                starts.append(self.lengths[hit] - size)
        owner = np.concatenate(hits) if hits else np.zeros(0, np.int64)
        start = np.concatenate(starts) if starts else np.zeros(0, np.int64)
        sorting = np.lexsort((start, owner))
        return np.split(start[sorting], np.searchsorted(owner[sorting], np.arange(1, count)))


def read(file) -> np.ndarray:
    size = file.seek(0, 2)
    file.seek(0)
    values = np.empty(size, np.uint8)
    file.readinto(values)
    return values


def write(file, values: np.ndarray) -> None:
    """Over the former content, which was never longer."""
    file.seek(0)
    file.write(values.data)
    file.flush()


class SortedRuns:
    """The places of a transform in order of symbol, then place, held as runs of equal symbols."""

    def __init__(self, transform: np.ndarray):
        cuts = np.flatnonzero(transform[1:] != transform[:-1])
        self.starts = np.zeros(len(cuts) + 2, np.int32)
        np.add(cuts, 1, out=self.starts[1:-1], casting="unsafe")
        self.starts[-1] = len(transform)
        self.count = len(cuts) + 1
        self.order = np.argsort(transform[self.starts[:-1]], kind="stable").astype(np.int32)
        self.spot = np.empty(self.count, np.int32)
        self.spot[self.order] = np.arange(self.count, dtype=np.int32)
        self.rank = np.zeros(self.count + 1, np.int32)
        np.cumsum(np.diff(self.starts)[self.order], out=self.rank[1:])

    def neighbours(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each place its rank in the order, and the places before and after it there; -1 for none."""
        run = np.searchsorted(self.starts[:-1], places, "right") - 1
        spot, inside = self.spot[run], places - self.starts[run]
        earlier = self.order[np.maximum(spot - 1, 0)]
        left = np.where(inside > 0, places - 1, np.where(spot > 0, self.starts[earlier + 1] - 1, -1))
        later = self.order[np.minimum(spot + 1, self.count - 1)]
        last = np.where(spot + 1 < self.count, self.starts[later], -1)
        right = np.where(places + 1 < self.starts[run + 1], places + 1, last)
        return self.rank[spot] + inside, left, right


def least_between(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """The least value after ``low`` up to ``high``, for each pair."""
    if not len(low):
        return np.zeros(0, np.uint8)
    # From right to left, so that what lies between two pairs is not read.
    backwards = np.argsort(-low, kind="stable")
    bounds = np.empty(2 * len(low), np.intp)
    bounds[0::2], bounds[1::2] = low[backwards] + 1, high[backwards] + 1
    found = np.minimum.reduceat(np.append(values, np.uint8(255)), bounds)[0::2]
    result = np.empty(len(low), np.uint8)
    result[backwards] = found
    return result
