"""Weighted acyclic automata over sequences of words, kept in arrays.

An automaton accepts sequences of one length and gives each a weight. It is built from
sorted sequences: neighbours share the states of their common prefix, and states that go on
alike are merged, from the last level to the first. Paths are numbered in sorted order, so
the weights are one array beside the merged states. Labels are places in a sorted list
of words, which makes the order of paths that of their words.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

#: Odd factors of the fingerprints by which states are compared first.
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_SIZES = (np.uint8, np.uint16, np.uint32, np.uint64)


class Automaton(NamedTuple):
    words: list[bytes]
    #: For each level: where the arcs of each state start, with the end last; their labels and next states.
    starts: list[np.ndarray]
    labels: list[np.ndarray]
    targets: list[np.ndarray]
    weights: np.ndarray


def gathered(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places ``start, ..., start + size - 1`` of every range, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def built(words: list[bytes], rows: np.ndarray, weights: np.ndarray) -> Automaton:
    """The minimal automaton of sorted distinct ``rows``, a sequence of labels each; only the words used are kept."""
    used, flat = np.unique(rows, return_inverse=True)
    rows = flat.astype(np.int32).reshape(rows.shape)
    new = np.zeros(len(rows), bool)
    new[:1] = True
    starts, labels, before = [], [], np.zeros(len(rows), np.int64)
    for column in rows.T:
        new[1:] |= column[1:] != column[:-1]
        heads = np.flatnonzero(new)
        labels.append(column[heads])
        starts.append(np.searchsorted(before[heads], np.arange(before[-1] + 2 if len(rows) else 2)))
        before = np.cumsum(new) - 1
    targets = [np.zeros(len(labels[-1]), np.int32)]
    if not len(rows):
        return Automaton([], starts, labels, targets * len(labels), weights)
    for level in range(len(labels) - 1, 0, -1):
        kept, kinds = _merged(starts[level], labels[level], targets[0])
        sizes = np.diff(starts[level])[kept]
        arcs = gathered(starts[level][kept], sizes)
        labels[level], targets[0] = labels[level][arcs], targets[0][arcs]
        starts[level] = np.concatenate(([0], np.cumsum(sizes)))
        targets.insert(0, kinds)
    return Automaton([words[i] for i in used.tolist()], starts, labels, targets, weights)


def _merged(starts: np.ndarray, labels: np.ndarray, targets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The states to keep, one of each kind that has the same arcs, and the kind of every state."""
    sizes = np.diff(starts)
    place = (np.arange(len(labels)) - np.repeat(starts[:-1], sizes)).astype(np.uint64)
    mixed = (labels.astype(np.uint64) * _A ^ targets.astype(np.uint64) * _B) + place
    mixed = (mixed ^ (mixed >> np.uint64(29))) * _A
    mixed ^= mixed >> np.uint64(32)
    print_ = np.add.reduceat(mixed, starts[:-1]) * _B + sizes.astype(np.uint64)
    _, first, kinds = np.unique(print_, return_index=True, return_inverse=True)
    model = first[kinds]
    own = gathered(starts[:-1], sizes)
    same_size = sizes[model] == sizes
    other = gathered(starts[:-1][model], np.where(same_size, sizes, 0))
    own = own[np.repeat(same_size, sizes)]
    equal = (labels[own] == labels[other]) & (targets[own] == targets[other])
    alone = ~same_size
    alone[np.repeat(np.arange(len(sizes)), np.where(same_size, sizes, 0))[~equal]] = True
    # Equal fingerprints of different states: those stay as they are.
    odd = np.flatnonzero(alone)
    kinds = kinds.astype(np.int32)
    kinds[odd] = len(first) + np.arange(len(odd))
    return np.concatenate((first, odd)), kinds


def paths(x: Automaton) -> np.ndarray:
    """All accepted sequences in sorted order, as rows of labels."""
    states, rows = np.zeros(1, np.int64), np.empty((1, 0), np.int32)
    for starts, labels, targets in zip(x.starts, x.labels, x.targets, strict=True):
        sizes = starts[states + 1] - starts[states]
        arcs = gathered(starts[states], sizes)
        rows = np.column_stack((np.repeat(rows, sizes, axis=0), labels[arcs]))
        states = targets[arcs]
    return rows


def union(xs: list[Automaton]) -> Automaton:
    """The automaton of all sequences of ``xs``, whose weights are summed."""
    if len(xs) == 1:
        return xs[0]
    words = sorted({w for x in xs for w in x.words})
    at = {w: i for i, w in enumerate(words)}
    rows = np.concatenate([np.fromiter((at[w] for w in x.words), np.int32, len(x.words))[paths(x)] for x in xs])
    weights = np.concatenate([x.weights for x in xs])
    return summed(words, rows, weights)


def summed(words: list[bytes], rows: np.ndarray, weights: np.ndarray) -> Automaton:
    """The automaton of ``rows`` in any order; weights of equal rows are summed."""
    width, size = rows.shape[1], max(len(words), 1)
    if size**width < 1 << 62:
        key = rows[:, 0].astype(np.int64)
        for column in rows.T[1:]:
            key = key * size + column
        order = np.argsort(key, kind="stable")
    else:
        order = np.lexsort(rows.T[::-1])
    rows, weights = rows[order], weights[order]
    new = np.ones(len(rows), bool)
    new[1:] = (rows[1:] != rows[:-1]).any(axis=1)
    heads = np.flatnonzero(new)
    return built(words, rows[heads], np.add.reduceat(weights, heads) if len(heads) else weights)


def pruned(x: Automaton, least: int) -> Automaton:
    """The sequences whose weight reaches ``least``."""
    keep = x.weights >= least
    return x if keep.all() else built(x.words, paths(x)[keep], x.weights[keep])


def composed(x: Automaton, y: Automaton) -> tuple[np.ndarray, np.ndarray]:
    """The sequences that both accept: their rows in the labels of ``x``, and the weights that ``y`` gives them.

    Both are walked together, a level at a time, over pairs of states; an arc of ``y`` adds
    the number of paths before it, which leads to the place of the weight.
    """
    at = {w: i for i, w in enumerate(y.words)}
    same = np.fromiter((at.get(w, -1) for w in x.words), np.int64, len(x.words))
    below = [np.ones(1, np.int64)]
    for starts, targets in zip(y.starts[::-1], y.targets[::-1], strict=True):
        below.insert(0, np.add.reduceat(below[0][targets], starts[:-1]) if len(targets) else np.zeros(1, np.int64))
    xs, ys, places = np.zeros(1, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
    rows = np.empty((1, 0), np.int64)
    for level, (starts, labels, targets) in enumerate(zip(x.starts, x.labels, x.targets, strict=True)):
        sizes = starts[xs + 1] - starts[xs]
        arcs = gathered(starts[xs], sizes)
        owner = np.repeat(np.arange(len(xs)), sizes)
        wanted = same[labels[arcs]]
        y_starts, y_labels, y_targets = y.starts[level], y.labels[level], y.targets[level]
        # Arcs of y are sorted by state and label, so a pair of both is found by one search.
        size = len(y.words) + 1
        keys = np.repeat(np.arange(len(y_starts) - 1), np.diff(y_starts)) * size + y_labels
        pair = ys[owner] * size + wanted
        found = np.searchsorted(keys, pair)
        ok = wanted >= 0
        ok[ok] = (found[ok] < len(keys)) & (keys[np.minimum(found[ok], len(keys) - 1)] == pair[ok]) if len(keys) else False
        arcs, owner, found = arcs[ok], owner[ok], found[ok]
        paths_to = np.concatenate(([0], np.cumsum(below[level + 1][y_targets])))
        places = places[owner] + paths_to[found] - paths_to[y_starts[ys[owner]]]
        rows = np.column_stack((rows[owner], labels[arcs]))
        xs, ys = targets[arcs], y_targets[found]
    return rows, y.weights[places]


def _packed(values: np.ndarray) -> bytes:
    top = int(values.max()) if len(values) else 0
    code = next(i for i, kind in enumerate(_SIZES) if top <= np.iinfo(kind).max)
    return bytes([code]) + len(values).to_bytes(5, "big") + values.astype(_SIZES[code]).tobytes()


def to_bytes(x: Automaton) -> bytes:
    """The automaton in as few bytes a number as its largest ones need."""
    parts = [_packed(np.fromiter(map(len, x.words), np.int64, len(x.words))), b"".join(x.words)]
    for level in zip(x.starts, x.labels, x.targets, strict=True):
        parts += map(_packed, level)
    return bytes([len(x.starts)]) + b"".join([*parts, _packed(x.weights)])


def from_bytes(data: bytes) -> Automaton:
    at = 1

    def values(wanted: type = np.int64) -> np.ndarray:
        nonlocal at
        kind, n = _SIZES[data[at]], int.from_bytes(data[at + 1 : at + 6], "big")
        found = np.frombuffer(data, kind, n, at + 6).astype(wanted)
        at += 6 + n * np.dtype(kind).itemsize
        return found

    words = []
    for size in values().tolist():
        words.append(data[at : at + size])
        at += size
    levels = [(values(), values(np.int32), values(np.int32)) for _ in range(data[0])]
    return Automaton(words, *(list(x) for x in zip(*levels, strict=True)), values())
