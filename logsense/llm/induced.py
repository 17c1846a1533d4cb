"""External induced suffix sorting: queues on disk, whole batches of suffixes at a time.

The suffixes of type S whose left neighbour is of type L are ordered first: their substrings get names
and the string of names is sorted by the same procedure. From them the L suffixes are induced in
ascending order and from these the S suffixes in descending order. A queue of suffixes stands for each
range of first symbols; a popped range is ordered as one batch, pushes the suffixes one position to the
left into later ranges, and moves on. Queues and orders beyond a byte limit lie on disk, so memory
holds the string, its types, places and prefix lengths, and one batch.

Common prefixes are induced with the order: neighbours of one first symbol share one symbol more than the least
that their right neighbours share with all suffixes between them. Only those of the first ordered suffixes,
and of an L next to an S suffix, are compared in the string.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np

#: Suffixes in a range of first symbols, unless one symbol has more.
BATCH = 1 << 16
#: Left neighbours of left neighbours in one range, before the range is halved.
DEPTH = 12
#: Longest common prefix that is told apart, symbols that may be read beyond the string, and the bits of a
#: position in a tuple.
CAP, PAD, SHIFT = 255, 264, 40
LOW = (1 << SHIFT) - 1


class Spill:
    """Sequences of positions; those beyond ``limit`` bytes lie in files of the given store."""

    def __init__(self, store=None, folder: str = "", limit: int = 256 << 20) -> None:
        self.store, self.folder, self.limit = store, f"{folder}/spill-{uuid.uuid4().hex}", limit
        self.held, self.made, self.parts = 0, False, {}

    def push(self, name, positions: np.ndarray) -> None:
        if not len(positions):
            return
        self.parts.setdefault(name, []).append(positions)
        self.held += positions.nbytes
        if self.store is not None and self.held > self.limit:
            self._write()

    def _write(self) -> None:
        if not self.made:
            self.store.create_dir(self.folder, recursive=True)
            self.made = True
        for parts in self.parts.values():
            fresh = [k for k, part in enumerate(parts) if not isinstance(part, str)]
            if fresh:
                path = f"{self.folder}/{uuid.uuid4().hex}"
                with self.store.open_output_stream(path) as out:
                    out.write(np.concatenate([parts[k] for k in fresh]).tobytes())
                parts[fresh[0] :] = [path]  # the unwritten ones are always the last
        self.held = 0

    def pop(self, name) -> np.ndarray:
        found = []
        for part in self.parts.pop(name, []):
            if isinstance(part, str):
                with self.store.open_input_stream(part) as source:
                    found.append(np.frombuffer(source.read(), np.int64))
                self.store.delete_file(part)
            else:
                self.held -= part.nbytes
                found.append(part)
        return np.concatenate(found) if found else np.empty(0, np.int64)

    def close(self) -> None:
        if self.made:
            self.store.delete_dir(self.folder)


def _types(t: np.ndarray) -> np.ndarray:
    """True for S: the suffix is smaller than the next one. The last symbol is the unique least."""
    step = np.diff(t)
    decided = np.where(step != 0, np.arange(len(step)), len(step) - 1)
    nearest = np.minimum.accumulate(decided[::-1])[::-1]
    return np.append(step[nearest] > 0, True)


def _names(t: np.ndarray, s: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """Dense ranks of the substrings from each of ``lms`` to the next, by symbol and then type."""
    lengths = np.append(np.diff(lms) + 1, 1)
    bits = (int(t.max()) * 2 + 2).bit_length()
    per_word = 63 // bits
    rank = np.zeros(len(lms), np.int64)
    active, offset = np.arange(len(lms)), 0
    while len(active):
        word = np.zeros(len(active), np.int64)
        at = lms[active] + offset
        left = lengths[active] - offset
        for k in range(per_word):
            here = np.minimum(at + k, len(t) - 1)
            word = (word << bits) | np.where(k < left, 2 * t[here] + s[here] + 1, 0).astype(np.int64)
        order = np.lexsort((word, rank[active]))
        active, word, left = active[order], word[order], left[order]
        old = rank[active]
        new_old = np.append(True, old[1:] != old[:-1])
        new = new_old | np.append(True, word[1:] != word[:-1])
        index = np.arange(len(active))
        start, old_start = np.maximum.accumulate(np.where(new, index, 0)), np.maximum.accumulate(np.where(new_old, index, 0))
        rank[active] = old + start - old_start
        tied = ~new | np.append(~new[1:], False)
        active = active[tied & (left > per_word)]
        offset += per_word
    return np.unique(rank, return_inverse=True)[1].astype(np.int32)


def _one_symbol(t, target, pending, symbol) -> np.ndarray:
    """The targets of one first symbol: those followed by smaller ones, then in turn their left neighbours."""
    parts = [pending]
    while len(parts[-1]):
        left = parts[-1][parts[-1] > 0] - 1
        parts.append(left[(t[left] == symbol) & target[left]])
    return np.concatenate(parts)


def _ordered(t, target, pending, seeds, begin, end) -> np.ndarray:
    """Targets and seeds of the range of symbols from ``begin`` to before ``end``, in order."""
    if end - begin == 1:
        return np.concatenate([_one_symbol(t, target, pending, begin), seeds])
    ordered = _many_symbols(t, target, pending, seeds, end)
    if ordered is not None:
        return ordered
    middle = (begin + end) // 2
    low, early = t[pending] < middle, t[seeds] < middle
    first = _ordered(t, target, pending[low], seeds[early], begin, middle)
    left = first[first > 0] - 1
    left = left[target[left] & (t[left] >= middle) & (t[left] < end)]
    return np.concatenate([first, _ordered(t, target, np.concatenate([pending[~low], left]), seeds[~early], middle, end)])


def _many_symbols(t, target, pending, seeds, end) -> np.ndarray | None:
    """The same for several symbols at once; None if that takes more than ``DEPTH`` steps.

    A suffix of the range is ordered by its symbol and then by its right neighbour. So the key is the
    chain of symbols up to a suffix that was pending (first of its symbol) or a seed (last of its symbol).
    """
    place = np.concatenate([pending, seeds])
    kind = np.concatenate([np.zeros(len(pending), np.int64), np.full(len(seeds), 2)])
    levels = [(place, [3 * t[place] + kind], np.arange(len(place)))]
    while True:
        place, chain, root = levels[-1]
        left = np.maximum(place - 1, 0)
        into = np.flatnonzero((place > 0) & target[left] & (t[left] < end))
        if not len(into):
            break
        if len(levels) > DEPTH:
            return None
        left = left[into]
        levels.append((left, [3 * t[left] + 1, *(column[into] for column in chain)], root[into]))
    depth = len(levels)
    places = np.concatenate([x[0] for x in levels])
    columns = [np.concatenate([x[1][k] if k < len(x[1]) else np.full(len(x[0]), -1) for x in levels]) for k in range(depth)]
    return places[np.lexsort((np.concatenate([x[2] for x in levels]), *columns[::-1]))]


class Prefixes:
    """Of one pass: the place of each suffix in the order so far, and the prefix it shares with the one before.

    Lengths end at ``CAP``. ``symbols``: the string for comparing, as ``common_prefixes`` takes it.
    """

    def __init__(self, t: np.ndarray, symbols: np.ndarray) -> None:
        self.t, self.compared = t, symbols
        self.place = np.zeros(len(t) + 1, np.int32)
        self.shared = np.zeros(len(t), np.uint8)
        self.n = 0

    def add(self, ordered: np.ndarray, is_target: np.ndarray, seed_shared: np.ndarray) -> np.ndarray:
        base, self.n = self.n, self.n + len(ordered)
        self.place[ordered] = np.arange(base, self.n, dtype=np.int32)
        shared = self.shared
        shared[base : self.n][~is_target] = seed_shared
        symbols = self.t[ordered]
        edges = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1], [True]]))
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            targets = int(np.count_nonzero(is_target[a:b]))  # they come before the seeds of their symbol
            shared[base + a] = 0
            right = self.place[ordered[a : a + targets] + 1]
            done = 1
            while done < targets:
                # right neighbours of one symbol's runs are in this very list: as far as it is known
                upto = int(np.searchsorted(right, base + a + done))
                first, last = int(right[done - 1]), int(right[upto - 1])
                least = np.minimum.reduceat(shared[first + 1 : last + 1], right[done - 1 : upto - 1] - first)
                shared[base + a + done : base + a + upto] = np.minimum(least, CAP - 1) + 1
                done = upto
            if 0 < targets < b - a:
                shared[base + a + targets] = common_prefixes(
                    self.compared, ordered[a + targets - 1 : a + targets], ordered[a + targets : a + targets + 1]
                )[0]
        return shared[base : self.n]


def common_prefixes(symbols: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """How many symbols the suffixes at ``x`` and ``y`` share, up to ``CAP``; uint16 with ``PAD`` zeros at the end."""
    fours = np.lib.stride_tricks.sliding_window_view(symbols, 4)
    length = np.zeros(len(x), np.int64)
    alive = np.arange(len(x))
    for at in range(0, CAP, 4):
        differ = fours[x[alive] + at].view(np.uint64).ravel() ^ fours[y[alive] + at].view(np.uint64).ravel()
        low = (differ & (~differ + np.uint64(1))).astype(np.float64)  # the lowest bit that differs
        equal = differ == 0
        length[alive] += np.where(equal, 4, np.log2(np.where(equal, 1, low)).astype(np.int64) // 16)
        alive = alive[equal]
        if not len(alive):
            break
    return np.minimum(length, CAP).astype(np.uint8)


def _reversed_shared(shared: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint8), shared[:0:-1]])


def _induce(
    t, target, seeds: Iterator[np.ndarray], histogram, spill: Spill, label: str, prefixes: Prefixes | None = None
) -> Iterator[np.ndarray]:
    """Targets and seeds in ascending order, a range of symbols at a time; ``seeds`` come by range.

    With ``prefixes`` seeds and results are tuples in one number: the place, and above ``SHIFT`` bits the prefix
    shared with the one before.
    """
    used = np.cumsum(histogram)
    starts, at = [0], 0
    while at < len(used):
        base = used[at - 1] if at else 0
        at = max(at + 1, int(np.searchsorted(used, base + BATCH, "right")))
        starts.append(at)
    starts = np.array(starts)
    rest = np.empty(0, np.int64)
    for r, (begin, end) in enumerate(zip(starts[:-1], starts[1:])):
        pending = spill.pop((label, r))
        own = [rest]
        while seeds is not None and (not len(own[-1]) or t[own[-1][-1] & LOW] < end):
            more = next(seeds, None)
            if more is None:
                seeds = None
            else:
                own.append(more)
        own = np.concatenate(own)
        cut = np.searchsorted(t[own & LOW], end)
        own, rest = own[:cut], own[cut:]
        ordered = _ordered(t, target, pending, own & LOW, begin, end)
        left = ordered[ordered > 0] - 1
        left = left[target[left] & (t[left] >= end)]
        into = np.searchsorted(starts, t[left], "right") - 1
        by_range = np.argsort(into, kind="stable")
        left, into = left[by_range], into[by_range]
        for part in np.split(left, np.flatnonzero(np.diff(into)) + 1) if len(left) else ():
            spill.push((label, int(np.searchsorted(starts, t[part[0]], "right") - 1)), part)
        if len(ordered) and prefixes is not None:
            shared = prefixes.add(ordered, target[ordered], (own >> SHIFT).astype(np.uint8))
            yield ordered | (shared.astype(np.int64) << SHIFT)
        elif len(ordered):
            yield ordered


def sorted_suffixes(t: np.ndarray, spill: Spill, depth: int = 0, with_prefixes: bool = False) -> Iterator[np.ndarray]:
    """All positions of ``t`` in descending order of their suffixes, in batches.

    ``t`` holds non-negative symbols (int32, below 2 ** 29) and ends with its only 0. With prefixes (symbols below
    2 ** 16) each position carries above ``SHIFT`` bits the prefix it shares with the one before,
    0 at the start of a batch: no batch starts within the suffixes of one first symbol.
    """
    s = _types(t) if len(t) > 1 else np.array([True])
    lms = np.flatnonzero(s[1:] & ~s[:-1]) + 1
    if len(lms) == 0:  # the single symbol
        yield np.zeros(len(t), np.int64)
        return
    names = _names(t, s, lms)
    if names.max() + 1 == len(lms):
        order = lms[np.argsort(names)]
    else:
        order = lms[np.concatenate(list(sorted_suffixes(names, spill, depth + 1)))[::-1]]
    passes = [None, None]
    top = len(histogram := np.bincount(t)) - 1
    if with_prefixes:
        compared = np.concatenate([t.astype(np.uint16), np.zeros(PAD, np.uint16)])
        shared = np.concatenate([np.zeros(1, np.uint8), common_prefixes(compared, order[:-1], order[1:])])
        order = order | (shared.astype(np.int64) << SHIFT)
        passes[0] = Prefixes(t, compared)
    ascending = f"{depth}L"
    n_runs = 0
    for batch in _induce(t, ~s, iter([order]), histogram, spill, f"{depth}l", passes[0]):
        spill.push((ascending, n_runs), batch[~s[batch & LOW]])
        n_runs += 1

    def falling() -> Iterator[np.ndarray]:
        for k in range(n_runs - 1, -1, -1):
            run = spill.pop((ascending, k))
            if len(run):
                yield (run[::-1] & LOW) | (_reversed_shared((run >> SHIFT).astype(np.uint8)).astype(np.int64) << SHIFT)

    passes[0] = None
    if with_prefixes:
        passes[1] = Prefixes(top - t, compared)
    yield from _induce(top - t, s, falling(), histogram[::-1], spill, f"{depth}s", passes[1])
    yield np.array([len(t) - 1])
