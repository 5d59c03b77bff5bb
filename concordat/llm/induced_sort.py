"""Suffix sorting by induction, with queues that go to disk.

The suffixes that are smaller than both neighbours in the text (the leftmost S-types) are sorted
first, through names for the stretches between them; all others follow by induction: a pass up the
buckets places the L-types, a pass down the S-types.  Since a pass takes suffixes in sorted order,
what it queues for a bucket arrives sorted, so each bucket's queue is a plain file of positions that
is read back once.  Whole runs of a bucket are taken at a time.
"""

from __future__ import annotations

import tempfile

import numpy as np

# Bytes of queued positions kept in memory before they go to disk.
MEMORY = 64 << 20


class BucketQueues:
    """A queue of positions for each bucket; runs beyond ``memory`` bytes are spooled to a file.

    The file is unnamed scratch of the running task, as a sort's spill is, and goes with it.
    """

    def __init__(self, buckets: int, memory: int) -> None:
        self._runs: list[list] = [[] for _ in range(buckets)]
        self._memory, self._held, self._file = memory, 0, None
        self.spilled = 0

    def push(self, chars: np.ndarray, positions: np.ndarray) -> None:
        """Each position to its bucket, in the given order."""
        if not len(positions):
            return
        order = np.argsort(chars, kind="stable")
        chars, positions = chars[order], positions[order]
        cuts = np.flatnonzero(chars[1:] != chars[:-1]) + 1
        for part, at in zip(np.split(positions, cuts), np.append(0, cuts)):
            self._runs[chars[at]].append(part)
        self._held += positions.nbytes
        if self._held > self._memory:
            self._spill()

    def _spill(self) -> None:
        if self._file is None:
            self._file = tempfile.TemporaryFile()
        for runs in self._runs:
            for i, run in enumerate(runs):
                if isinstance(run, np.ndarray):
                    runs[i] = (self._file.seek(0, 2), len(run))
                    run.tofile(self._file)
        self.spilled += self._held
        self._held = 0

    def take(self, bucket: int) -> np.ndarray:
        """All of a bucket's positions so far, in the order in which they came."""
        runs, self._runs[bucket] = self._runs[bucket], []
        found = [np.zeros(0, np.int64)]
        for run in runs:
            if isinstance(run, tuple):
                self._file.seek(run[0])
                run = np.fromfile(self._file, np.int64, run[1])
            else:
                self._held -= run.nbytes
            found.append(run)
        return np.concatenate(found)


def _small_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the one after it; the last one counts as smaller."""
    size = len(text)
    turns = np.flatnonzero(text[1:] != text[:-1])
    small = np.ones(size, bool)
    following = np.searchsorted(turns, np.arange(size - 1))
    ended = following >= len(turns)
    turn = turns[np.minimum(following, len(turns) - 1)] if len(turns) else np.zeros(size - 1, int)
    small[:-1] = np.where(ended, False, text[turn + (len(turns) > 0)] > text[turn])
    return small


def _induced(text, small, seeds, buckets, memory):
    """All suffixes in order, given some of the leftmost S-types in order."""
    seeded = BucketQueues(buckets, memory)
    seeded.push(text[seeds], seeds)
    larger = BucketQueues(buckets, memory)
    upward = BucketQueues(buckets, memory)

    def before(positions: np.ndarray, wanted: bool) -> np.ndarray:
        found = positions[positions > 0] - 1
        return found[small[found] == wanted]

    for bucket in range(buckets):
        run = larger.take(bucket)
        while len(run):
            upward.push(np.full(len(run), bucket), run)
            found = before(run, False)
            chars = text[found]
            stays = chars == bucket
            larger.push(chars[~stays], found[~stays])
            run = found[stays]
        found = before(seeded.take(bucket), False)
        larger.push(text[found], found)
    smaller = BucketQueues(buckets, memory)
    last = np.array([len(text) - 1])
    smaller.push(text[last], last)
    parts = []
    for bucket in range(buckets - 1, -1, -1):
        run, own = smaller.take(bucket), []
        while len(run):
            own.append(run)
            found = before(run, True)
            chars = text[found]
            stays = chars == bucket
            smaller.push(chars[~stays], found[~stays])
            run = found[stays]
        low = upward.take(bucket)
        found = before(low[::-1], True)
        smaller.push(text[found], found)
        parts += [np.concatenate(own)[::-1]] if own else []
        parts.append(low)
    return np.concatenate(parts[::-1])


def _named(text, ends, order, size):
    """A number for each stretch in ``order``, equal for equal stretches and rising."""
    starts, stops = order, ends
    fresh = np.ones(len(order), bool)
    if len(order) > 1:
        left, right = starts[:-1], starts[1:]
        lengths = stops - starts
        active = np.flatnonzero(lengths[1:] == lengths[:-1])
        fresh[1:][active] = False
        step = 0
        while len(active):
            active = active[lengths[active] >= step]
            differs = text[np.minimum(left[active] + step, size)] != text[np.minimum(right[active] + step, size)]
            fresh[1:][active[differs]] = True
            active = active[~differs]
            step += 1
    return np.cumsum(fresh) - 1


def suffix_order(text: np.ndarray, depth: int, memory: int = MEMORY) -> np.ndarray:
    """The suffixes of ``text`` sorted by at least their first ``depth`` characters.

    ``text`` holds numbers below some hundreds and ends in a number that occurs nowhere else and is
    below all others.
    """
    buckets = int(text.max()) + 1
    small = _small_types(text)
    marks = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(marks) < 2:
        return _induced(text, small, marks, buckets, memory)
    rough = _induced(text, small, marks, buckets, memory)
    is_mark = np.zeros(len(text), bool)
    is_mark[marks] = True
    order = rough[is_mark[rough]]
    stops = np.append(marks[1:], len(text) - 1)
    place = np.searchsorted(marks, order)
    names = _named(text, stops[place], order, len(text) - 1)
    rank = np.empty(len(marks), np.int64)
    rank[place] = names
    # The reduced text of names: its suffixes are sorted by doubling, each round twice as deep.
    # Marks lie at least two characters apart.
    span = 1
    while rank.max() < len(rank) - 1 and 2 * span <= depth + 2:
        ahead = np.append(rank[span:] + 1, np.zeros(min(span, len(rank)), np.int64))[: len(rank)]
        keys = rank * (len(rank) + 1) + ahead
        _, rank = np.unique(keys, return_inverse=True)
        span *= 2
    return _induced(text, small, marks[np.argsort(rank, kind="stable")], buckets, memory)


def shares(text: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """Whether each suffix in ``order`` begins with the same ``depth`` characters as the one before."""
    same = np.zeros(len(order), bool)
    if len(order) < 2:
        return same
    left, right = order[:-1], order[1:]
    active = np.flatnonzero((left + depth <= len(text)) & (right + depth <= len(text)))
    wide = np.lib.stride_tricks.sliding_window_view(text, min(8, len(text)))
    for step in range(0, depth, 8):
        at = min(step, max(depth - 8, 0))
        if depth < 8:
            equal = (text[left[active][:, None] + np.arange(depth)] == text[right[active][:, None] + np.arange(depth)]).all(1)
        else:
            equal = (wide[left[active] + at] == wide[right[active] + at]).all(1)
        active = active[equal]
    same[active + 1] = True
    return same
