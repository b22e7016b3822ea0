"""Suffix sorting by recursive induction, and the repeated strings of a shard.

Suffixes are induced from sorted ones: the order of the suffixes behind them is known, so a suffix enters the queue of its
first symbol in rank order, and each queue is a priority queue on (symbol, rank) without comparisons. Queues keep what
does not fit their memory in a temporary file. The left-most smaller suffixes are sorted by a first induction, named, and
sorted exactly by the same procedure on the string of names; a second induction gives the whole order.

At the byte level a queue is emptied in rounds of arrays; in the recursion, where most symbols occur once or twice, queues
are plain lists.
"""

from __future__ import annotations

import tempfile

import numpy as np

from adlake.llm.common import Powers, Rolling, byte_codes, mix

QUEUE_BYTES = 1 << 28  # of one induction, kept in memory
FEW_SYMBOLS = 512
COMPARED = 1 << 15  # neighbours compared at a time


class Queues:
    """A first-in first-out queue of positions for each symbol, in memory up to a bound and beyond it on disk."""

    def __init__(self, symbols: int, most: int = QUEUE_BYTES):
        self.parts: list[list] = [[] for _ in range(symbols)]
        self.used, self.most, self.file = 0, most, None

    def push(self, symbols: np.ndarray, positions: np.ndarray) -> None:
        order = np.argsort(symbols, kind="stable")
        symbols, positions = symbols[order], positions[order]
        edges = np.concatenate([[0], np.flatnonzero(symbols[1:] != symbols[:-1]) + 1, [len(symbols)]])
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if a < b:
                self.parts[symbols[a]].append(self._keep(positions[a:b]))

    def _keep(self, part: np.ndarray):
        self.used += part.nbytes
        if self.used <= self.most:
            return part
        self.used -= part.nbytes
        self.file = self.file or tempfile.TemporaryFile()
        self.file.seek(0, 2)
        at = self.file.tell()
        self.file.write(part.tobytes())
        return at, len(part), part.dtype

    def take(self, symbol: int) -> np.ndarray:
        parts, self.parts[symbol] = self.parts[symbol], []
        arrays = []
        for p in parts:
            if isinstance(p, tuple):
                self.file.seek(p[0])
                p = np.frombuffer(self.file.read(p[1] * p[2].itemsize), p[2])
            else:
                self.used -= p.nbytes
            arrays.append(p)
        return np.concatenate(arrays) if arrays else np.zeros(0, np.int64)


def smaller_types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than the next one; the last suffix counts as smaller."""
    n = len(text)
    change = np.flatnonzero(text[1:] != text[:-1])
    rises = text[change + 1] > text[change]
    after = np.searchsorted(change, np.arange(n - 1), "left")
    types = np.ones(n, bool)
    known = after < len(change)
    types[:-1][known] = rises[after[known]]
    return types


def induce_arrays(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """All suffixes in order, from ``seeds``, the left-most smaller ones in order."""
    larger, queues = [np.zeros(0, np.int64)] * symbols, Queues(symbols)
    first = np.searchsorted(text[seeds], np.arange(symbols + 1))

    def before(items: np.ndarray, kind: bool) -> np.ndarray:
        ahead = items[items > 0] - 1
        return ahead[smaller[ahead] == kind]

    for c in range(symbols):
        rounds, items = [], queues.take(c)
        while len(items):
            rounds.append(items)
            ahead = before(items, False)
            here = text[ahead] == c
            queues.push(text[ahead[~here]], ahead[~here])
            items = ahead[here]
        larger[c] = np.concatenate(rounds) if rounds else larger[c]
        ahead = before(seeds[first[c] : first[c + 1]], False)
        queues.push(text[ahead], ahead)
    queues, order = Queues(symbols), []
    queues.push(text[-1:], np.array([len(text) - 1]))
    for c in reversed(range(symbols)):
        rounds, items = [], queues.take(c)
        while len(items):
            rounds.append(items)
            ahead = before(items, True)
            here = text[ahead] == c
            queues.push(text[ahead[~here]], ahead[~here])
            items = ahead[here]
        ahead = before(larger[c][::-1], True)
        here = text[ahead] == c  # smaller suffixes never follow from larger ones of the same symbol
        queues.push(text[ahead[~here]], ahead[~here])
        order.append(np.concatenate([larger[c], *[r[::-1] for r in reversed(rounds)]]))
    return np.concatenate(order[::-1])


def induce_lists(text: np.ndarray, smaller: np.ndarray, seeds: np.ndarray, symbols: int) -> np.ndarray:
    """The same with lists as queues, for many symbols."""
    at, small = text.tolist(), smaller.tolist()
    larger: list[list] = [[] for _ in range(symbols)]
    seeded: list[list] = [[] for _ in range(symbols)]
    for p in seeds.tolist():
        seeded[at[p]].append(p)
    for c in range(symbols):
        queue = larger[c]
        for p in queue:  # grows as it is read
            if p and not small[p - 1]:
                larger[at[p - 1]].append(p - 1)
        for p in seeded[c]:
            if p:
                larger[at[p - 1]].append(p - 1)
    rest: list[list] = [[] for _ in range(symbols)]
    rest[at[-1]].append(len(at) - 1)
    for c in reversed(range(symbols)):
        queue = rest[c]
        for p in queue:
            if p and small[p - 1]:
                rest[at[p - 1]].append(p - 1)
        for p in reversed(larger[c]):
            if p and small[p - 1]:
                rest[at[p - 1]].append(p - 1)
    order = []
    for c in range(symbols):
        order += larger[c]
        order += reversed(rest[c])
    return np.array(order, np.int64)


def suffix_order(text: np.ndarray, symbols: int) -> np.ndarray:
    """Suffix array of ``text``, whose last symbol is 0 and occurs nowhere else."""
    if len(text) == 1:
        return np.zeros(1, np.int64)
    induce = induce_arrays if symbols <= FEW_SYMBOLS else induce_lists
    smaller = smaller_types(text)
    least = np.flatnonzero(smaller[1:] & ~smaller[:-1]) + 1  # left-most smaller suffixes
    if len(least) == 1:
        return induce(text, smaller, least, symbols)
    rough = least[np.argsort(text[least], kind="stable")]
    found = induce(text, smaller, rough, symbols)
    mark = np.zeros(len(text), bool)
    mark[least] = True
    found = found[mark[found]]
    # Names: equal pieces between two such suffixes, both ends included, get one name.
    ends = np.append(least[1:], len(text) - 1)
    powers = Powers()
    up, down = powers.upto(len(text) + 1)
    code = mix((text.astype(np.uint64) << np.uint64(1)) + smaller + np.uint64(1))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(code * up[: len(text)])])
    piece = mix((sums[ends + 1] - sums[least]) * down[least]) ^ (ends - least).astype(np.uint64)
    number = np.empty(len(text), np.int64)
    number[least] = np.arange(len(least))
    ranked = number[found]
    names = np.cumsum(np.concatenate([[0], piece[ranked[1:]] != piece[ranked[:-1]]]))
    if names[-1] + 1 < len(least):
        reduced = np.empty(len(least), np.int64)
        reduced[ranked] = names
        found = least[suffix_order(reduced, int(names[-1]) + 1)]
    return induce(text, smaller, found, symbols)


def candidates(data: np.ndarray, offsets: np.ndarray, span: int) -> np.ndarray:
    """Starts, in order, of the strings whose hash occurs twice; no other string can repeat, so no other is sorted."""
    row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    at = np.flatnonzero(np.arange(len(data)) + span <= offsets[1:][row])
    strings = Rolling(data, Powers(), byte_codes())(at, at + span)
    order = np.argsort(strings)
    twice = np.zeros(len(at), bool)
    same = strings[order[1:]] == strings[order[:-1]]
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return at[twice]


def repeated_strings(data: np.ndarray, offsets: np.ndarray, span: int) -> np.ndarray:
    """Starts of the strings of ``span`` bytes, none across rows, that also start earlier in ``data``; in order."""
    starts = candidates(data, offsets, span)
    if not len(starts):
        return starts
    # Runs of neighbouring starts become the rows to sort, each with the bytes of its strings.
    row = np.searchsorted(offsets, starts, "right")
    new = np.ones(len(starts), bool)
    new[1:] = (starts[1:] != starts[:-1] + 1) | (row[1:] != row[:-1])
    begins = np.flatnonzero(new)
    sizes = np.diff(np.append(begins, len(starts))) + span - 1
    ends = np.cumsum(sizes)
    # Row r lies at ends[r] - sizes[r] + r in the text; rows end in symbol 1, the whole in symbol 0.
    inside = np.arange(ends[-1]) - np.repeat(ends - sizes, sizes)
    source = np.repeat(starts[begins], sizes) + inside
    text = np.ones(ends[-1] + len(sizes) + 1, np.int64)
    text[-1] = 0
    target = np.arange(ends[-1]) + np.repeat(np.arange(len(sizes)), sizes)
    text[target] = data[source].astype(np.int64) + 2
    place = np.full(len(text), -1)
    place[target] = np.where(inside < np.repeat(sizes, sizes) - span + 1, source, -1)
    at = place[suffix_order(text, 258)]
    at = at[at >= 0]
    # Neighbours in the order share their first ``span`` bytes or no two strings there are equal.
    pieces = np.lib.stride_tricks.sliding_window_view(data, span)
    equal = np.ones(len(at) - 1, bool)
    for k in range(0, len(equal), COMPARED):
        part = slice(k, k + COMPARED)
        equal[part] = (pieces[at[1:][part]] == pieces[at[:-1][part]]).all(axis=1)
    groups = np.flatnonzero(np.concatenate([[True], ~equal]))
    earliest = np.repeat(np.minimum.reduceat(at, groups), np.diff(np.append(groups, len(at))))
    return np.sort(at[at != earliest])
