"""SentencePiece encoding by sampling segmentations without replacement, and decoding.

Every way to cut a text into pieces of the vocabulary is a path through a lattice. A path's weight is the
product of its pieces' weights, 1 / (2 - score), which for this kind of model is a rank law. The ``k``
paths with the largest Gumbel-perturbed log-probabilities are a sample without replacement. They are found
from the top: the best path of the whole lattice is drawn step by step; at each step the paths that leave
there for another piece form a set whose best perturbed value is drawn below the value of the path they
leave. Such sets wait with their values as exact bounds, and the search always opens the greatest one.

Pieces never span the border before a word mark or a line's end, so units between such borders repeat, and
each worker builds a unit's lattice once. What follows a place in a unit depends on the characters left only, so
units that end alike share the nodes of their common end. All draws are hashes of the row key, the number of the sample and
the place, so a row's result depends on nothing else.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from wayfare.llm.worker import kept

MARK = "▁"
SAMPLES = 3
# sets of paths that leave the best one from this step on wait as one set, and are told apart if it is opened
SINGLE_STEPS = 48
BATCH_UNITS = 100_000
MOST_ARCS = 4_000_000
# characters at the end of a unit whose nodes are looked for among those of other units
SHARED_ENDS = 48
# weight, as a score, of a byte where a character has no piece
BYTE_SCORE = -40_000.0

FACTOR = np.uint64(0x9E3779B97F4A7C15)
STIR = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
CODE_BITS = np.uint64(21)
CODES = (np.uint64(1) << CODE_BITS) - np.uint64(1)
HEAD_BITS = 18
HEAD_SHIFT = np.uint64(64 - HEAD_BITS)


def _seed(seed, *parts) -> np.ndarray:
    """A seed that also depends on ``parts``, integers."""
    x = np.atleast_1d(np.asarray(seed, dtype=np.uint64))
    for part in parts:
        # in place, as most of the time of large arrays is their memory
        x = x + np.asarray(part).astype(np.uint64)
        x *= FACTOR
        x += np.uint64(1)
        x ^= x >> np.uint64(30)
        x *= STIR[0]
        x ^= x >> np.uint64(27)
        x *= STIR[1]
        x ^= x >> np.uint64(31)
    return x


def _uniform(seed, *parts) -> np.ndarray:
    """Numbers between 0 and 1, both excluded, from a seed and integers."""
    x = (_seed(seed, *parts) >> np.uint64(11)).astype(float)
    x += 0.5
    x *= 2.0**-53
    return x


def _starts(lengths: np.ndarray) -> np.ndarray:
    """Where runs of these lengths begin, and at last where they end."""
    starts = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=starts[1:])
    return starts


def _runs(begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of runs that begin there and have these lengths, one run after the other."""
    starts = _starts(lengths)
    return np.repeat(begins - starts[:-1], lengths) + np.arange(starts[-1])


def _n_bytes(codes: np.ndarray) -> np.ndarray:
    """UTF-8 bytes of characters."""
    return 1 + np.searchsorted([128, 2048, 65536], codes, side="right")


def _is_text(model, i: int) -> bool:
    return not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))


def piece_texts(model) -> list[bytes]:
    """What each id of a SentencePiece model stands for; control ids stand for nothing."""
    def text(i: int) -> bytes:
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            return bytes([int(piece[3:-1], 16)])
        return piece.replace(MARK, " ").encode() if _is_text(model, i) else b""

    return [text(i) for i in range(model.get_piece_size())]


class _Numbers:
    """Numbers of keys, integers below 2**64 - 1, looked up and added many at a time."""

    NONE = np.uint64(2**64 - 1)

    def __init__(self, bits: int = 16):
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, self.NONE)
        self.numbers = np.zeros(1 << bits, dtype=np.int32)
        self.n = 0

    def _next(self, at: np.ndarray) -> np.ndarray:
        return (at + 1) & (len(self.keys) - 1)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; minus one for a key without."""
        at = ((keys * FACTOR) >> self.shift).astype(np.int64)
        there = self.keys[at]
        other = np.nonzero((there != keys) & (there != self.NONE))[0]
        while len(other):
            at[other] = self._next(at[other])
            there = self.keys[at[other]]
            other = other[(there != keys[other]) & (there != self.NONE)]
        return np.where(self.keys[at] == keys, self.numbers[at], -1)

    def add(self, keys: np.ndarray, first: int) -> tuple[np.ndarray, np.ndarray]:
        """Number keys that have no number yet from ``first`` on, equal ones alike: numbers, and which keys got them."""
        bits = 64 - int(self.shift)
        while (self.n + len(keys)) * 2 > 1 << bits:
            bits += 1
        if 1 << bits > len(self.keys):
            old = self.keys != self.NONE
            old_keys, old_numbers = self.keys[old], self.numbers[old]
            self.__init__(bits)
            self.numbers[self._places(old_keys)] = old_numbers
            self.n = len(old_keys)
        places = self._places(keys)
        # of equal keys the last one is taken
        self.numbers[places] = np.arange(len(keys))
        taken = np.nonzero(self.numbers[places] == np.arange(len(keys)))[0]
        self.numbers[places[taken]] = first + np.arange(len(taken))
        self.n += len(taken)
        return self.numbers[places], taken

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """Put in keys without a number; where they are then."""
        at = ((keys * FACTOR) >> self.shift).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = left[self.keys[at[left]] == self.NONE]
            # of different ones that come to one place, one is there afterwards
            self.keys[at[free]] = keys[free]
            left = left[self.keys[at[left]] != keys[left]]
            at[left] = self._next(at[left])
        return at


class Lattices:
    """The vocabulary of a model file, and lattices of the units seen so far, as flat arrays of nodes and arcs.

    A node is what is left of a unit: a character and the node after it. Node 0 is the end of every unit.
    """

    def __init__(self, path: str, most_arcs: int = MOST_ARCS):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.most_arcs = most_arcs
        size = self.model.get_piece_size()
        self.bytes_at = next(i for i in range(size) if self.model.is_byte(i))
        prefixes: dict[str, int] = {}
        for i in range(size):
            piece = self.model.id_to_piece(i)
            if _is_text(self.model, i):
                if MARK in piece.lstrip(MARK) or "\n" in piece:
                    raise ValueError("a piece spans the border of a unit")
                for n in range(1, len(piece)):
                    prefixes.setdefault(piece[:n], -1)
                prefixes[piece] = i
        hashes = np.zeros(len(prefixes), dtype=np.uint64)
        for at, prefix in enumerate(prefixes):
            value = 0
            for c in prefix:
                value = (value * int(FACTOR) + ord(c) + 1) % 2**64
            hashes[at] = value * int(STIR[0]) % 2**64
        order = np.argsort(hashes)
        # the greatest number at the end is no prefix; it ends every look-up
        self.prefix_hashes = np.append(hashes[order], np.uint64(2**64 - 1))
        self.prefix_ids = np.append(np.array(list(prefixes.values()), dtype=np.int32)[order], np.int32(-1))
        # the first prefix by leading bits of its hash
        heads = np.arange(1 << HEAD_BITS, dtype=np.uint64)
        self.prefix_heads = np.searchsorted(self.prefix_hashes >> HEAD_SHIFT, heads)
        scores = np.array([self.model.get_score(i) for i in range(size)])
        self.weights = -np.log(2.0 - scores)
        self.byte_weight = -np.log(2.0 - BYTE_SCORE)
        # per node
        self.code = np.zeros(1 << 16, dtype=np.uint32)
        self.after = np.zeros(1 << 16, dtype=np.int32)
        self.mass = np.zeros(1 << 16)
        self.first = np.zeros(1 << 16, dtype=np.int32)
        self.leaving = np.zeros(1 << 16, dtype=np.int32)
        self.stop = np.zeros(1 << 16, dtype=bool)
        # per arc, in the order of nodes
        self.to = np.zeros(1 << 16, dtype=np.int32)
        # the first arc that leaves where an arc leads to; -1 at the end of a unit
        self.onward = np.zeros(1 << 16, dtype=np.int32)
        self.piece = np.zeros(1 << 16, dtype=np.int32)
        self.logp = np.zeros(1 << 16)
        self.upto = np.zeros(1 << 16, dtype=np.float32)
        self.reset()

    def reset(self) -> None:
        """Forget all units; the room of their arrays is used again."""
        self.units: dict[str, int] = {}
        self.numbers = _Numbers()
        self.n_nodes, self.n_arcs = 1, 0
        self.first[0], self.stop[0] = -1, True

    def _room(self, names: tuple[str, ...], needed: int) -> None:
        for name in names:
            old = getattr(self, name)
            if len(old) < needed:
                new = np.zeros(max(needed, len(old) * 5 // 4), dtype=old.dtype)
                new[: len(old)] = old
                setattr(self, name, new)

    def _prefixes(self, value: np.ndarray) -> np.ndarray:
        """Places of the prefixes with these hashes, or minus one."""
        at = self.prefix_heads[value >> HEAD_SHIFT]
        below = np.nonzero(self.prefix_hashes[at] < value)[0]
        while len(below):
            at[below] += 1
            below = below[self.prefix_hashes[at[below]] < value[below]]
        at[self.prefix_hashes[at] != value] = -1
        return at

    def _new_nodes(self, code: np.ndarray, after: np.ndarray) -> None:
        """Go on with new nodes of these characters, and the nodes after them."""
        new = slice(self.n_nodes, self.n_nodes + len(code))
        self._room(("code", "after", "mass", "first", "leaving", "stop"), new.stop)
        self.code[new], self.after[new] = code, after
        self.n_nodes = new.stop

    def add(self, units: list[str]) -> None:
        """Build the lattices of ``units``, all of them new and not empty."""
        code = np.frombuffer("".join(units).encode("utf-32-le"), dtype=np.uint32).astype(np.uint64)
        lengths = np.fromiter(map(len, units), dtype=np.int64, count=len(units))
        by_length = np.argsort(-lengths, kind="stable")
        ends = np.cumsum(lengths)[by_length]
        n_longer = np.searchsorted(-lengths[by_length], -np.arange(1, lengths.max() + 1), side="right")
        # nodes from the last characters of units to the first ones
        node, low, levels = np.zeros(len(units), dtype=np.int64), self.n_nodes, [self.n_nodes]
        for r, n in enumerate(n_longer[:SHARED_ENDS].tolist(), 1):
            key = (node[:n].astype(np.uint64) << CODE_BITS) + code[ends[:n] - r]
            here = self.numbers.get(key)
            new = np.nonzero(here < 0)[0]
            if len(new):
                here[new], taken = self.numbers.add(key[new], self.n_nodes)
                keys = key[new[taken]]
                self._new_nodes(keys & CODES, keys >> CODE_BITS)
            node[:n] = here
            levels.append(self.n_nodes)
        if len(longer := n_longer[SHARED_ENDS:]):
            starts = self.n_nodes + _starts(longer)
            unit, level = _runs(np.zeros(len(longer), dtype=np.int64), longer), np.repeat(np.arange(len(longer)), longer)
            after = np.where(level > 0, starts[level - 1] + unit, node[unit])
            self._new_nodes(code[ends[unit] - SHARED_ENDS - 1 - level], after)
            node[:longer[0]] = starts[lengths[by_length[:longer[0]]] - SHARED_ENDS - 1] + np.arange(longer[0])
            levels += starts[1:].tolist()
        self.units.update(zip([units[i] for i in by_length.tolist()], node.tolist()))

        # pieces by their length: at which of the new nodes they begin, where they lead to, and their ids
        n_new = self.n_nodes - low
        if not n_new:
            return
        spans: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        n_arcs = np.zeros(n_new, dtype=np.int64)
        alive, place, value = np.arange(n_new), np.arange(low, self.n_nodes), np.zeros(n_new, dtype=np.uint64)
        while len(alive):
            value = value * FACTOR
            value += self.code[place]
            value += np.uint64(1)
            found = self._prefixes(value * STIR[0])
            known = np.nonzero(found >= 0)[0]
            alive, value, place, ids = alive[known], value[known], self.after[place[known]], self.prefix_ids[found[known]]
            ends = np.nonzero(ids >= 0)[0]
            spans.append((alive[ends], place[ends], ids[ends]))
            n_arcs[alive[ends]] += 1
            if len(spans) == 1:
                lone = np.nonzero(n_arcs == 0)[0]
            more = np.nonzero(place)[0]
            alive, value, place = alive[more], value[more], place[more]
        # a character without a piece is one arc for its bytes, kept as minus its code
        n_arcs[lone] += 1
        first = _starts(n_arcs)
        target, piece = np.zeros(first[-1], dtype=np.int32), np.zeros(first[-1], dtype=np.int32)
        next_arc = first[:-1].copy()
        target[next_arc[lone]], piece[next_arc[lone]] = self.after[low + lone], -self.code[low + lone].astype(np.int64)
        next_arc[lone] += 1
        # long pieces first: they mostly weigh more, which shortens the search for a draw
        for begin, end, ids in reversed(spans):
            at = next_arc[begin]
            target[at], piece[at] = end, ids
            next_arc[begin] += 1
        weight = self.weights[np.maximum(piece, 0)]
        by_bytes = np.nonzero(piece < 0)[0]
        weight[by_bytes] = _n_bytes(-piece[by_bytes]) * self.byte_weight

        for a, b in zip(levels, levels[1:]):
            if b > a:
                own = first[a - low:b - low]
                each = weight[own[0]:first[b - low]] + self.mass[target[own[0]:first[b - low]]]
                self.mass[a:b] = np.logaddexp.reduceat(each, own - own[0])
        first, last = first[:-1], first[1:] - 1
        logp = weight + self.mass[target]
        logp -= np.repeat(self.mass[low:self.n_nodes], n_arcs)
        logp[first[n_arcs == 1]] = 0.0  # without choice, whatever rounding says
        # node by node, so that rounding does not depend on the other units of the call
        upto = np.exp(logp)
        open_nodes, k = np.nonzero(n_arcs > 1)[0], 1
        while len(open_nodes):
            at = first[open_nodes] + k
            upto[at] += upto[at - 1]
            k += 1
            open_nodes = open_nodes[n_arcs[open_nodes] > k]
        # above any draw, so that the last arc always ends a search
        upto[last] = 2.0

        at, end = self.n_arcs, self.n_arcs + len(target)
        self._room(("to", "onward", "piece", "logp", "upto"), end)
        self.first[low:self.n_nodes], self.leaving[low:self.n_nodes] = at + first, n_arcs
        self.stop[low:self.n_nodes] = False
        self.to[at:end], self.onward[at:end], self.piece[at:end] = target, self.first[target], piece
        self.logp[at:end], self.upto[at:end] = np.minimum(logp, 0.0), upto
        self.n_arcs = end

    def nodes_of(self, units: list[str]) -> np.ndarray:
        """The first nodes of distinct units; minus one for an empty one."""
        get = self.units.get
        nodes = np.array([get(unit, -1) for unit in units], dtype=np.int64)
        new = [i for i in np.nonzero(nodes < 0)[0].tolist() if units[i]]
        if new:
            names = [units[i] for i in new]
            self.add(names)
            nodes[new] = [self.units[name] for name in names]
        return nodes

    def arcs_between(self, arc: int) -> range:
        """All arcs that leave the node of ``arc``, of which the last one is above any draw."""
        low, high = arc, arc
        while low and self.upto[low - 1] < 2.0:
            low -= 1
        while self.upto[high] < 2.0:
            high += 1
        return range(low, high + 1)

    def drawn(self, arcs: np.ndarray, uniform: np.ndarray) -> np.ndarray:
        """An arc by weight, of those that leave a node, for each node's first one."""
        arcs = arcs.astype(np.int64)
        beyond = np.nonzero(self.upto[arcs] <= uniform)[0]
        at, limit = arcs[beyond], uniform[beyond]
        while len(beyond):
            at += 1
            arcs[beyond] = at
            further = np.nonzero(self.upto[at] <= limit)[0]
            beyond, at, limit = beyond[further], at[further], limit[further]
        return arcs

    def ids(self, arcs: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of arcs, with bytes in place of characters without a piece, and where ``cuts`` between arcs go."""
        pieces = self.piece[arcs]
        lone = np.nonzero(pieces < 0)[0]
        if len(lone):
            further = _n_bytes(-pieces[lone]) - 1
            before = _starts(further)
            codes, which = np.unique(-pieces[lone], return_inverse=True)
            encoded = np.array([list(chr(c).encode().ljust(4, b"\0")) for c in codes.tolist()])
            pieces = np.insert(pieces, np.repeat(lone + 1, further), 0)
            for k in range(4):
                has = np.nonzero(further >= k)[0]
                pieces[lone[has] + before[has] + k] = self.bytes_at + encoded[which[has], k]
            cuts = cuts + before[np.searchsorted(lone, cuts)]
        return pieces.astype("<u4"), cuts


def lattices(path: str) -> Lattices:
    return kept(("lattices", path), lambda: Lattices(path))


def spaced(normal: str) -> str:
    """A normalised text with spaces, which it has none of, between its units, and some without a unit between."""
    return normal.replace(MARK, " " + MARK).replace(MARK + " ", MARK).replace("\n", " \n ")


def units_of(normal: str) -> list[str]:
    """Units of a normalised text, which together are the text."""
    return [u for u in spaced(normal).split(" ") if u]


def _unit_nodes(store: Lattices, normal: list[str]) -> list[np.ndarray]:
    """First nodes of the units of each text."""
    split = pc.split_pattern(pa.array(map(spaced, normal), pa.large_string()), " ")
    coded = split.flatten().dictionary_encode()
    code = coded.indices.to_numpy()
    nodes = store.nodes_of(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[code]
    real = nodes >= 0
    cuts = _starts(real)[split.offsets.to_numpy()]
    nodes = nodes[real]
    return [nodes[a:b] for a, b in zip(cuts.tolist(), cuts[1:].tolist())]


def _left_aside(before: np.ndarray, each: np.ndarray) -> np.ndarray:
    """Log-mass of the paths that leave at steps of log-probability ``each``; steps without choice have none."""
    with np.errstate(divide="ignore"):
        return before + np.log(-np.expm1(each))


class _Path:
    """A path of one text: arcs, their log-probabilities, and the values of the sets that wait along it.

    Sets that leave at steps from ``tail`` on wait together with the value ``lump`` until it is opened. The path
    is its own from step ``fresh`` on, within unit ``begin``; ``bounds`` has where its units begin and end.
    """

    def __init__(self, arcs: np.ndarray, each: np.ndarray, fresh: int, seed: int, begin: int, bounds: np.ndarray):
        self.arcs, self.each, self.seed, self.fresh = arcs, each, seed, fresh
        self.begin, self.bounds = begin, bounds
        self.upto = np.cumsum(each)
        self.total = float(self.upto[-1]) if len(arcs) else 0.0
        self.tail = min(fresh + SINGLE_STEPS, len(arcs))
        self.waiting: list[float] = []
        self.lump = -np.inf

    def before(self, start: int, stop: int) -> np.ndarray:
        """Log-probabilities of the path up to, and without, each of these steps."""
        return self.upto[start:stop] - self.each[start:stop]

    def unit(self, step: int) -> int:
        """The unit of a step, not before ``fresh``."""
        return self.begin + int(np.searchsorted(self.bounds[1:], self.bounds[0] + step - self.fresh, side="right"))

    def best(self) -> float:
        return max(max(self.waiting, default=-np.inf), self.lump)

    def opened(self, value: float) -> int:
        """The step at which the set with this greatest ``value`` leaves the path."""
        if self.lump < value:
            return self.fresh + self.waiting.index(value)
        aside = _left_aside(self.before(self.tail, len(self.arcs)), self.each[self.tail:])
        share = np.cumsum(np.exp(aside - aside.max()))
        step = int(np.searchsorted(share, _uniform(self.seed, 1 << 31)[0] * share[-1], side="right"))
        # the other sets of the tail wait on their own from here, below the value of the one that leaves
        draws = _uniform(self.seed, np.arange(self.tail, len(self.arcs)))
        self.waiting += _below(value, aside, draws).tolist()
        step, self.tail, self.lump = self.tail + min(step, len(aside) - 1), len(self.arcs), -np.inf
        return step


def _wait(paths: list[_Path], limits: np.ndarray) -> None:
    """Draw the values of the sets that wait along new ``paths``, below ``limits``: all paths at once."""
    each = np.zeros((len(paths), SINGLE_STEPS))
    before = np.zeros((len(paths), SINGLE_STEPS))
    at_tail, in_tail = np.zeros(len(paths)), np.zeros(len(paths))
    for i, path in enumerate(paths):
        n = path.tail - path.fresh
        each[i, :n], before[i, :n] = path.each[path.fresh:path.tail], path.before(path.fresh, path.tail)
        if path.tail < len(path.arcs):
            at_tail[i] = path.upto[path.tail] - path.each[path.tail]
            in_tail[i] = path.total - at_tail[i]
    seeds = np.array([path.seed for path in paths], dtype=np.uint64)
    steps = np.array([path.fresh for path in paths])[:, None] + np.arange(SINGLE_STEPS)
    values = _below(limits[:, None], _left_aside(before, each), _uniform(seeds[:, None], steps)).tolist()
    # the lump is all that shares the path up to the tail, but for the path itself
    lumps = _below(limits, _left_aside(at_tail, in_tail), _uniform(seeds, 1 << 30)).tolist()
    for path, row, lump in zip(paths, values, lumps):
        path.waiting, path.lump = row[:path.tail - path.fresh], lump


def _below(limit, place, uniform) -> np.ndarray:
    """Gumbel values around ``place``, given that they are below ``limit``."""
    with np.errstate(invalid="ignore"):
        drawn = -np.logaddexp(-np.asarray(limit, dtype=float), np.log(-np.log(uniform)) - place)
    return np.where(np.isneginf(place), -np.inf, drawn)


class _Batch:
    """The search over a batch of texts: every round opens the greatest waiting set of each text."""

    def __init__(self, store: Lattices, keys: np.ndarray, units: list[np.ndarray]):
        self.store, self.keys = store, keys
        self.counts = np.array([len(u) for u in units], dtype=np.int64)
        self.unit_at = _starts(self.counts)
        self.nodes = np.concatenate(units) if units else np.zeros(0, dtype=np.int64)

    def _walk(self, texts: np.ndarray, begin: np.ndarray, node: np.ndarray, sample: int):
        """Draw from unit ``begin`` of each of ``texts`` to its end, the first unit from ``node`` on (if not -1).

        Returns all arcs, the bounds of units among them and, per text, the bounds of its bounds.
        """
        store = self.store
        n = self.counts[texts] - begin
        starts = _starts(n)
        now = self.nodes[_runs(self.unit_at[texts] + begin, n)]
        inside = np.nonzero((n > 0) & (node >= 0))[0]
        now[starts[inside]] = node[inside]
        seed = _seed(np.repeat(_seed(self.keys[texts], sample), n), _runs(begin, n))
        active, steps = np.nonzero(~store.stop[now])[0], []
        seed, arc = seed[active], store.first[now[active]]
        while len(active):
            arc = store.drawn(arc, _uniform(seed, len(steps)))
            steps.append((active, arc))
            arc = store.onward[arc]
            on = np.nonzero(arc >= 0)[0]
            active, seed, arc = active[on], seed[on], arc[on]
        taken = np.concatenate([active for active, _ in steps]) if steps else active
        at = _starts(np.bincount(taken, minlength=len(now)))
        arcs = np.zeros(at[-1], dtype=np.int32)
        for k, (active, arc) in enumerate(steps):
            arcs[at[active] + k] = arc
        return arcs, at, starts.tolist()

    def search(self, k: int) -> list[tuple[list, float]]:
        """Per text its samples (arcs, log-probability, perturbed value) by falling value, and the value after them."""
        store, n = self.store, len(self.counts)
        texts = np.arange(n)
        begin, node = [0] * n, [-1] * n
        values = (-np.log(-np.log(_uniform(self.keys, 1 << 40)))).tolist()
        heads: list[tuple[_Path, int, int] | None] = [None] * n
        paths: list[list[_Path]] = [[] for _ in range(n)]
        found: list[list[tuple]] = [[] for _ in range(n)]
        after = [-np.inf] * n
        left_out: dict[tuple[int, int, int], list[int]] = {}
        for sample in range(k):
            arcs, bounds, cuts = self._walk(
                texts, np.array(begin, dtype=np.int64), np.array(node, dtype=np.int64), sample)
            ends, logp = bounds[cuts].tolist(), store.logp[arcs]
            seeds = _seed(self.keys, (1 << 41) + sample).tolist()
            new = []
            for row, text in enumerate(texts.tolist()):
                own, each, fresh = arcs[ends[row]:ends[row + 1]], logp[ends[row]:ends[row + 1]], 0
                if heads[row]:
                    parent, step, choice = heads[row]
                    own = np.concatenate([parent.arcs[:step], [choice], own], dtype=np.int32)
                    each = np.concatenate([parent.each[:step], [store.logp[choice]], each])
                    fresh = step + 1
                path = _Path(own, each, fresh, seeds[text], begin[row], bounds[cuts[row]:cuts[row + 1] + 1])
                new.append(path)
                paths[text].append(path)
                found[text].append((own, path.total, values[row]))
            _wait(new, np.array(values))
            for text in texts.tolist():
                after[text] = max(p.best() for p in paths[text])
            texts = np.array([t for t in texts.tolist() if after[t] > -np.inf], dtype=np.int64)
            if sample == k - 1 or not len(texts):
                break
            heads, begin, node, values, changed = [], [], [], [], []
            draws = _uniform(self.keys, (1 << 43) + sample).tolist()
            for text in texts.tolist():
                value = after[text]
                p = max(range(len(paths[text])), key=lambda i: paths[text][i].best())
                own = paths[text][p]
                step = own.opened(value)
                out = left_out.setdefault((text, p, step), [int(own.arcs[step])])
                choice, rest = self._other(own, step, out, draws[text])
                out.append(choice)
                changed.append((own, step, rest))
                heads.append((own, step, choice))
                begin.append(own.unit(step)), node.append(int(store.to[choice])), values.append(value)
                after[text] = -np.inf
            # what is still aside at the steps left from waits below the value that just left
            rests = np.array([rest for _, _, rest in changed])
            again = _below(np.array(values), rests, _uniform(self.keys[texts], (1 << 42) + sample)).tolist()
            for (own, step, _), value in zip(changed, again):
                own.waiting[step - own.fresh] = value
        return list(zip(found, after))

    def _other(self, own: _Path, step: int, out: list[int], draw: float) -> tuple[int, float]:
        """An arc besides those ``out`` at a step, drawn by weight, and the log-mass of what stays aside."""
        store = self.store
        leaving = store.arcs_between(int(own.arcs[step]))
        arcs = [a for a in leaving if a not in out]
        share = [math.exp(x) for a, x in zip(leaving, store.logp[leaving.start:leaving.stop].tolist()) if a not in out]
        left, chosen = draw * sum(share), 0
        while chosen < len(arcs) - 1 and left >= share[chosen]:
            left -= share[chosen]
            chosen += 1
        rest = sum(share[:chosen] + share[chosen + 1:])
        return arcs[chosen], float(own.upto[step] - own.each[step]) + math.log(rest) if rest > 0 else -math.inf


def _inclusion(logp: float, threshold: float) -> float:
    """Chance that a path is among the samples, given the value just below them; 1 if there is none."""
    return float(-np.expm1(-np.exp(min(logp - threshold, 700.0)))) if threshold > -np.inf else 1.0


def plain(normal: str) -> str:
    """A normalised text without word marks and without the space that encoding puts first."""
    text = normal.replace(MARK, " ")
    return text[1:] if text.startswith(" ") else text


def key_of(doc_id) -> int:
    return xxhash.xxh64_intdigest(b"" if pd.isna(doc_id) else str(int(doc_id)).encode())


SCHEMA = "doc_id long, sample int, ids binary, logp double, value double, inclusion double, n_chars long, text_crc32 long"


def segmentations(docs: DataFrame, model: str, k: int = SAMPLES, checked: bool = False) -> DataFrame:
    """Up to ``k`` distinct segmentations per row of ``docs`` (doc_id, text), by falling perturbed value.

    Rows: doc_id, sample from 0, ids as little-endian unsigned 32-bit numbers, logp of the segmentation,
    its perturbed value, its inclusion score, the length of the normalised text and the crc32 of it as
    :func:`decoded` gives it back. A null or empty
    text has one segmentation, without pieces; a text with fewer than ``k`` segmentations has all of them.
    Draws depend on doc_id and text alone, so repeated rows repeat their samples, and rows with a null doc_id
    share a key. An empty table gives no rows. Other columns are not looked at. ``checked`` adds
    decoded_crc32, that of the text which the ids stand for.
    """
    schema = f"{SCHEMA}, decoded_crc32 long" if checked else SCHEMA

    def run(texts: list[tuple]) -> pd.DataFrame:
        store = lattices(model)
        if store.n_arcs > store.most_arcs:
            store.reset()
        normal = [store.model.normalize(t) if t else "" for _, t in texts]
        keys = np.array([key_of(d) for d, _ in texts], dtype=np.uint64)
        drawn = _Batch(store, keys, _unit_nodes(store, normal)).search(k)

        paths = [arcs for samples, _ in drawn for arcs, _, _ in samples]
        ids, cuts = store.ids(np.concatenate(paths), _starts(np.array([len(p) for p in paths])))
        # decoded here, as a step of its own would be a second Python worker beside this one
        back = _decoded_crc32(ids, cuts, _piece_texts(model)) if checked else []
        packed, cuts = memoryview(ids.tobytes()), (4 * cuts).tolist()
        out = []
        for (doc_id, _), text, (samples, threshold) in zip(texts, normal, drawn):
            crc = zlib.crc32(plain(text).encode())
            for number, (_, logp, value) in enumerate(samples):
                at = len(out)
                own = bytes(packed[cuts[at]:cuts[at + 1]])
                row = doc_id, number, own, logp, value, _inclusion(logp, threshold), len(text), crc
                out.append((*row, back[at]) if checked else row)
        frame = pd.DataFrame(out, columns=[f.split()[0] for f in schema.split(", ")])
        return frame.assign(doc_id=pd.array(frame["doc_id"], dtype="Int64"))

    def sample(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts, size = [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                texts.append((doc_id, text))
                size += len(text or "") // 6 + 1
                if size >= BATCH_UNITS:
                    yield run(texts)
                    texts, size = [], 0
            if texts:
                yield run(texts)

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInPandas(sample, schema)


_texts: dict[str, pa.Array] = {}


def _piece_texts(path: str) -> pa.Array:
    """What each id stands for, without the lattices."""
    if path not in _texts:
        import sentencepiece

        _texts[path] = pa.array(piece_texts(sentencepiece.SentencePieceProcessor(model_file=path)), pa.large_binary())
    return _texts[path]


def _joined(ids: np.ndarray, texts: pa.Array) -> tuple[memoryview, np.ndarray]:
    """The texts of ``ids``, one after the other, and where each of them begins, and the last one ends."""
    taken = texts.take(pa.array(ids))
    _, offsets, data = taken.buffers()
    return memoryview(data or b""), np.frombuffer(offsets, dtype=np.int64, count=len(ids) + 1)


def _decode(packed: bytes, texts: pa.Array) -> bytes:
    text, at = _joined(np.frombuffer(packed, dtype="<u4"), texts)
    text = bytes(text[:at[-1]])
    return text[1:] if text.startswith(b" ") else text


def _decoded_crc32(ids: np.ndarray, cuts: np.ndarray, texts: pa.Array) -> list[int]:
    """The crc32 of what the ids between each two ``cuts`` decode to."""
    text, at = _joined(ids, texts)
    at = at[cuts].tolist()
    return [zlib.crc32(text[a + (a < b and text[a:a + 1] == b" "):b]) for a, b in zip(at, at[1:])]


def decoded(ids: Column, model: str) -> Column:
    """Text of ``ids`` (little-endian unsigned 32-bit numbers) without the space that encoding puts first."""
    @pandas_udf("string")
    def decode(column: pd.Series) -> pd.Series:
        texts = _piece_texts(model)
        return pd.Series([None if p is None else _decode(p, texts).decode(errors="replace") for p in column], dtype=object)

    return decode(ids)
