"""Vectorised longest-common-subsequence scores for batches of strings inside a task.

The bit-vector recurrence of Hyyrö (2004) holds a row of the dynamic-programming table in machine
words; numpy runs it over many pairs at a time.  Strings of any length are handled whole, by as
many words as they need.
"""

from __future__ import annotations

import numpy as np

_WORD = 64
_PAIR_CHUNK = 4096
# Characters from which a pair runs alone.
_LONG = 255
# Strings from which an ending is common enough to be met apart, and pairs that are scored at a time.
_ALIKE = 32
_PAIRS = 1 << 16
# A pair that is scored alone takes so many times as long as one among others.
_DENSE = 16
# Beginnings of which it is asked whether they can go.
_FEW_NODES = 64
# Bytes of one word of the rows that a block of strings holds at a time.
_ROW_BYTES = 1 << 21
# The rows of bits, one array for each word, and the lengths of common subsequences.
Met = tuple[list[np.ndarray], np.ndarray]


def _code_points(strings: list[str]) -> np.ndarray:
    """One row of code points per string, padded with zeros."""
    wide = np.array(strings, dtype=np.str_)
    width = max(wide.dtype.itemsize // 4, 1)
    return wide.astype(f"U{width}").view(np.uint32).reshape(len(strings), width)


def _lengths(strings: list[str]) -> np.ndarray:
    return np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))


def ratio(common: np.ndarray, total: np.ndarray) -> np.ndarray:
    """Whole-percent similarity of two strings of ``total`` characters sharing ``common``.

    A string pair without characters is equal, hence 100.
    """
    total = np.maximum(total, 1)
    empty = (total == 1) & (common == 0)
    share = 1.0 - (total - 2 * common) / total
    return np.where(empty, 0, np.rint(100.0 * share)).astype(np.int32)


def _advance(state: list[np.ndarray], matches: list[np.ndarray]) -> list[np.ndarray]:
    """One step of the recurrence on every word, carrying from each word into the next."""
    stepped, carry = [], None
    for word, (row, match) in enumerate(zip(state, matches)):
        both = row & match
        total = row + both
        if word + 1 < len(state) or carry is not None:
            overflow = total < both
            if carry is not None:
                total = total + carry
                overflow |= total < carry
            carry = overflow.astype(row.dtype)
        stepped.append(total | (row - both))
    return stepped


def _zero_bits(state: list[np.ndarray], size: np.ndarray | int) -> np.ndarray:
    """Zeros among the first ``size`` bits: the length of the common subsequence."""
    kind = state[0].dtype.type
    width = state[0].dtype.itemsize * 8
    found = np.zeros(len(state[0]), dtype=np.int64)
    for word, row in enumerate(state):
        bits = np.clip(np.asarray(size) - word * width, 0, width)
        below_top = (kind(1) << np.minimum(bits, width - 1).astype(kind)) - kind(1)
        mask = np.where(bits == width, kind(np.iinfo(kind).max), below_top).astype(kind)
        found += np.bitwise_count(~row & mask)
    return found


def _ones(words: int, count: int) -> list[np.ndarray]:
    return [np.full(count, np.iinfo(np.uint64).max, dtype=np.uint64) for _ in range(words)]


def _lcs_words(left: list[str], right: list[str]) -> np.ndarray:
    """The recurrence for many pairs of about one length at a time."""
    a_codes, b_codes = _code_points(left), _code_points(right)
    words = -(-a_codes.shape[1] // _WORD)
    padded = np.zeros((len(left), words * _WORD), dtype=np.uint32)
    padded[:, : a_codes.shape[1]] = a_codes
    state = _ones(words, len(left))
    for column in b_codes.T:
        equal = (padded == column[:, None]) & (column != 0)[:, None]
        packed = np.packbits(equal, axis=1, bitorder="little").view(np.uint64)
        state = _advance(state, [packed[:, word] for word in range(words)])
    return _zero_bits(state, _lengths(left))


def _lcs_long(left: str, right: str) -> int:
    """The same recurrence for one long pair, its row of bits held in one whole number."""
    where: dict[str, list[int]] = {}
    for place, letter in enumerate(left):
        where.setdefault(letter, []).append(place)
    masks = {}
    for letter, places in where.items():
        bits = np.zeros(len(left), dtype=np.uint8)
        bits[places] = 1
        masks[letter] = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
    row = full = (1 << len(left)) - 1
    for letter in right:
        both = row & masks.get(letter, 0)
        row = ((row + both) | (row - both)) & full
    return len(left) - row.bit_count()


def lcs_pairs(left: list[str], right: list[str]) -> np.ndarray:
    """Common-subsequence length of ``left[i]`` and ``right[i]`` for every ``i``.

    Pairs are grouped by the magnitude of their longer side, so one long pair does not widen the
    tables of all others, and long pairs run alone.
    """
    found = np.zeros(len(left), dtype=np.int64)
    longer = np.maximum(_lengths(left), _lengths(right))
    for place in np.flatnonzero(longer > _LONG).tolist():
        found[place] = _lcs_long(left[place], right[place])
    magnitude = np.array([int(size).bit_length() for size in longer])
    for size in np.unique(magnitude[longer <= _LONG]):
        group = np.flatnonzero((magnitude == size) & (longer <= _LONG))
        for start in range(0, len(group), _PAIR_CHUNK):
            chosen = group[start : start + _PAIR_CHUNK]
            found[chosen] = _lcs_words([left[i] for i in chosen], [right[i] for i in chosen])
    return found


def ratio_pairs(left: list[str], right: list[str]) -> np.ndarray:
    """Whole-percent insert/delete similarity, pair by pair; equal strings are 100."""
    if not left:
        return np.zeros(0, dtype=np.int32)
    scores = ratio(lcs_pairs(left, right), _lengths(left) + _lengths(right))
    same = np.fromiter((a == b for a, b in zip(left, right)), dtype=bool, count=len(left))
    return np.where(same, 100, scores).astype(np.int32)


class Beginnings:
    """Distinct strings whose equal beginnings are one node each, to be met by many others."""

    def __init__(self, strings: list[str]) -> None:
        self.order = np.array(sorted(range(len(strings)), key=strings.__getitem__), dtype=np.int64)
        codes = _code_points([strings[i] for i in self.order])
        sizes = _lengths([strings[i] for i in self.order])
        self.letters = np.unique(codes[codes != 0])
        same = codes[1:] == codes[:-1]
        differs = np.append(~same, np.ones((len(same), 1), dtype=bool), axis=1).argmax(axis=1)
        shared = np.append(0, differs)
        # For each place the letters of its nodes, the nodes they follow, and which strings end there;
        # and how many letters follow a node at most.
        self.levels, self.rest = [], []
        before = None
        for at, column in enumerate(codes.T):
            nodes = np.flatnonzero((shared <= at) & (at < sizes))
            follows = None
            if before is not None and not np.array_equal(before, nodes):
                follows = np.searchsorted(before, nodes, "right") - 1
            # In the given order, so that the first of equals is the first that was given.
            ends = np.flatnonzero(sizes == at + 1)
            ends = ends[np.argsort(self.order[ends])]
            last = np.searchsorted(nodes, ends, "right") - 1 if len(ends) else ends
            letters = np.searchsorted(self.letters, column[nodes])
            if len(letters) and (letters == letters[0]).all():
                letters = letters[:1]
            self.levels.append((letters, follows, last, self.order[ends]))
            self.rest.append(np.maximum.reduceat(sizes, nodes) - at - 1 if len(nodes) else nodes)
            before = nodes

    def _masks(self, others: list[str], kind: np.dtype, words: int) -> list[np.ndarray]:
        """For each word and each letter, where it stands in each of ``others``."""
        width = kind.itemsize * 8
        masks = [np.zeros((len(self.letters), len(others)), kind) for _ in range(words)]
        codes = _code_points(others)
        if not len(self.letters):
            return masks
        places = np.minimum(np.searchsorted(self.letters, codes), len(self.letters) - 1)
        known = (self.letters[places] == codes) & (codes != 0)
        for word, mask in enumerate(masks):
            row, at = np.nonzero(known[:, word * width : (word + 1) * width])
            bits = np.left_shift(kind.type(1), at.astype(kind))
            np.bitwise_or.at(mask, (places[row, at + word * width], row), bits)
        return masks

    def met(self, others: list[str], least: np.ndarray) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
        """Which strings may have ``least`` letters or more in common with one of ``others``, their rows
        of bits and how many letters they have in common.

        A beginning goes as soon as all letters that follow it could not make up for what it lacks.
        """
        kind = _kind(others)
        words = max(1, -(-max(map(len, others)) // (kind.itemsize * 8)))
        masks = self._masks(others, kind, words)
        state = [np.full((1, len(others)), np.iinfo(kind).max, kind) for _ in range(words)]
        # The nodes of the place before that are left, None for all.
        left, found = None, []
        # Where few can go it is asked at ever fewer places.
        asks, pause = 0, 1
        for at, ((letters, follows, last, ends), rest) in enumerate(zip(self.levels, self.rest)):
            nodes = None
            if left is not None:
                place = np.full(left[1], -1)
                place[left[0]] = np.arange(len(left[0]))
                behind = place if follows is None else place[follows]
                nodes = np.flatnonzero(behind >= 0)
                follows = behind[nodes]
                letters = letters if len(letters) == 1 else letters[nodes]
            number = len(rest)
            behind = state if follows is None else [row.take(follows, axis=0) for row in state]
            state = _advance(behind, [mask.take(letters, axis=0) for mask in masks])
            if len(ends):
                if nodes is not None:
                    place = np.full(number, -1)
                    place[nodes] = np.arange(len(nodes))
                    last = place[last]
                    ends, last = ends[last >= 0], last[last >= 0]
                found.append((ends, [row.take(last, axis=0) for row in state]))
            if len(state[0]) >= _FEW_NODES and at >= asks:
                common = _zeros(state) + (rest if nodes is None else rest[nodes])[:, None]
                kept = np.flatnonzero((common >= least).any(axis=1))
                if len(kept) * 4 < 3 * len(state[0]):
                    state = [row.take(kept, axis=0) for row in state]
                    nodes = kept if nodes is None else nodes[kept]
                else:
                    asks, pause = at + 1 + pause, 2 * pause
            if nodes is not None and not len(nodes):
                break
            left = None if nodes is None else (nodes, number)
        ends = np.concatenate([one[0] for one in found]) if found else np.zeros(0, np.int64)
        rows = [
            np.concatenate([one[1][word] for one in found]) if found else np.empty((0, len(others)), kind)
            for word in range(words)
        ]
        return ends, rows, _zeros(rows)


def _zeros(rows: list[np.ndarray]) -> np.ndarray:
    counts = [np.bitwise_count(~row) for row in rows]
    return sum((c.astype(np.int32) for c in counts[1:]), counts[0].astype(np.int16 if len(rows) == 1 else np.int32))


def _kind(strings: list[str]) -> np.dtype:
    """The numbers that hold a row of bits of these strings, or one of its words."""
    longest = max(map(len, strings))
    return np.dtype(next((k for k in (np.uint8, np.uint16, np.uint32) if longest <= 8 * k().nbytes), np.uint64))


class Endings:
    """Distinct strings cut in two where many end alike: what strings have in common with both parts
    bounds from above what they have in common with the whole."""

    def __init__(self, strings: list[str]) -> None:
        counts: dict[str, int] = {}
        for text in strings:
            for at, letter in enumerate(text):
                if letter == " " and at:
                    counts[text[at:]] = counts.get(text[at:], 0) + 1
        cuts = [
            next((at for at, c in enumerate(text) if c == " " and at and counts[text[at:]] >= _ALIKE), len(text))
            for text in strings
        ]
        # Short endings are not worth the second part.
        if 2 * sum(len(text) - at for text, at in zip(strings, cuts)) < sum(map(len, strings)):
            cuts = [len(text) for text in strings]
        heads, tails = ([text[part] for text, part in zip(strings, side)] for side in (
            [slice(0, at) for at in cuts], [slice(at, None) for at in cuts]
        ))
        known = {text: place for place, text in enumerate(dict.fromkeys(heads))}
        self.heads = Beginnings(list(known))
        self.head = np.fromiter((known[text] for text in heads), np.int64, len(heads))
        known = {text: place for place, text in enumerate(dict.fromkeys(tails))}
        self.tail = np.fromiter((known[text] for text in tails), np.int64, len(tails))
        self.tails = Beginnings(list(known))
        self.codes = _code_points(list(known))
        self.sizes = _lengths(strings)
        # The strings of each beginning.
        self.by_head = np.argsort(self.head, kind="stable")
        self.opens = np.searchsorted(self.head[self.by_head], np.arange(len(self.heads.order) + 1))
        # Strings of one ending and one length have one bound.
        kinds, self.kind = np.unique(self.tail << 32 | self.sizes, return_inverse=True)
        self.kind_tail, self.kind_size = kinds >> 32, kinds & 0xFFFFFFFF
        letters = np.unique(self.codes[self.codes != 0])
        places = np.searchsorted(letters, self.codes) if len(letters) else np.zeros(self.codes.shape, np.int64)
        self.places = np.where(self.codes != 0, places, len(letters))

    def best(self, others: list[str], floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``best_ratios``, for a few ``others``."""
        sizes, number = _lengths(others), len(self.sizes)
        ends, _, known = self.tails.met(others, np.zeros(len(others), np.int64))
        ending = np.zeros((len(self.tails.order), len(others)), np.int64)
        ending[ends] = known
        total = self.kind_size[:, None] + sizes[None, :]
        need = np.maximum(np.ceil((floor - 0.5) * total / 200 - 1e-6), 1).astype(np.int64)
        # What the beginning must have in common, by kind.
        least = need - ending[self.kind_tail]
        heads, rows, known = self.heads.met(others, least.min(axis=0))
        best = np.full(len(others), number - 1)  # no score, the first place
        if not len(heads):
            return np.zeros(len(others), np.int32), np.zeros(len(others), np.int64)
        many = np.diff(self.opens)[heads]
        item = self.by_head[np.repeat(self.opens[heads] - (np.cumsum(many) - many), many) + np.arange(many.sum())]
        head = np.repeat(np.arange(len(heads)), many)
        masks = self.tails._masks(others, rows[0].dtype, len(rows))
        masks = [np.append(mask, np.zeros((1, len(others)), mask.dtype), axis=0) for mask in masks]
        known = known if (many == 1).all() else known.take(head, axis=0)
        above = known - least.astype(known.dtype).take(self.kind[item], axis=0)

        def scored(at: np.ndarray, other: np.ndarray) -> np.ndarray:
            """The best number of score and place, the first of equals, of single pairs."""
            state = [row[head[at], other] for row in rows]
            for column in self.places[self.tail[item[at]]].T if self.codes.any() else ():
                state = _advance(state, [mask[column, other] for mask in masks])
            score = ratio(_zeros(state).astype(np.int64), self.sizes[item[at]] + sizes[other])
            return score.astype(np.int64) * number + (number - 1 - item[at])

        every = np.arange(len(others))
        best = np.maximum(best, scored(above.argmax(axis=0), every))
        need = np.ceil((np.maximum(floor, best // number) - 0.5) * total / 200 - 1e-6)
        least = np.maximum(need, 1).astype(np.int64) - ending[self.kind_tail]
        near = known >= least.astype(known.dtype).take(self.kind[item], axis=0)
        single = np.flatnonzero(near.ravel())
        some = np.flatnonzero(near.any(axis=1))
        if len(single) * _DENSE > len(some) * len(others):
            # Many pairs are near: all of the near strings' are worked out together.
            step = max(1, _PAIRS // len(others))
            for part in (some[at : at + step] for at in range(0, len(some), step)):
                state = [row.take(head[part], axis=0) for row in rows]
                for column in self.places[self.tail[item[part]]].T if self.codes.any() else ():
                    state = _advance(state, [mask.take(column, axis=0) for mask in masks])
                score = ratio(_zeros(state).astype(np.int64), self.sizes[item[part]][:, None] + sizes)
                told = score.astype(np.int64) * number + (number - 1 - item[part])[:, None]
                np.maximum(best, told.max(axis=0), out=best)
        else:
            for at in range(0, len(single), _PAIRS):
                row, other = np.divmod(single[at : at + _PAIRS], len(others))
                np.maximum.at(best, other, scored(row, other))
        score, place = best // number, number - 1 - best % number
        return score.astype(np.int32), np.where(score > 0, place, 0)


def best_ratios(
    left: list[str], right: list[str], floor: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``left`` its best ``ratio_pairs`` with all of ``right``, and the first place in
    ``right`` that reaches it.

    ``right`` has distinct strings, none of them empty, and ``left`` none that is empty.  Where
    ``floor`` is given, scores below a string's floor need not be found; the lower scores may be any.
    """
    best = np.zeros(len(left), dtype=np.int32)
    where = np.zeros(len(left), dtype=np.int64)
    offered = Endings(right)
    sizes = _lengths(left)
    # Equal beginnings side by side, among those of about one length.
    texts = np.argsort(np.argsort(np.array(left, dtype=object), kind="stable"), kind="stable") if left else sizes
    by_size = np.lexsort((texts, sizes))
    if floor is None:
        floor = np.zeros(len(left), np.int64)
    start = 0
    while start < len(left):
        # Strings of about one length at a time.
        words = -(-int(sizes[by_size[start]]) // _WORD)
        step = max(1, min(64, _ROW_BYTES // (_kind([left[by_size[start]]]).itemsize * words * len(right))))
        chosen = by_size[start : start + step]
        start += step
        best[chosen], where[chosen] = offered.best([left[i] for i in chosen], floor[chosen])
    places = {text: place for place, text in enumerate(right)}
    for place, text in enumerate(left):
        if text in places:
            # Equal strings are 100; others may only round to it.
            if best[place] < 100 or places[text] < where[place]:
                best[place], where[place] = 100, places[text]
    return best, where
