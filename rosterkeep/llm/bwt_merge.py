"""Burrows-Wheeler transforms of shards of short strings, merged by iterative interleave refinement.

The transform is taken over symbols of ``Q`` bytes at every byte: with a suffix stands the symbol before it, ``Q`` bytes
back. Symbols are compared by a hash, in any fixed order, since only equal prefixes matter; a symbol that reaches its
string's terminator is unlike all others, so every suffix ends differently. A shard's last and first strings are neighbours,
which makes the step back a permutation of its places.

To merge two transforms, an interleave says for each rank which shard its suffix comes from. One refinement deals the ranks
stably by the symbol before; after t of them suffixes are in order by their first ``t * Q`` bytes, and ranks between which a
border arose in step t have a common prefix of less than that. Refinement ends when all ranks have borders, or at the depth
that is asked for; neither shard's suffixes are sorted again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

Q = 25
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MORE = np.uint64(0xBF58476D1CE4E5B9)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MORE
    return x ^ (x >> np.uint64(29))


def hashes(data: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the ``width`` bytes (16 at least) from each place on, for all places with so many."""
    n = len(data) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    eight = np.ndarray((len(data) - 7,), "<u8", np.ascontiguousarray(data).data, strides=(1,)).astype(np.uint64)
    out = eight[:n] * _MIX
    for at in [*range(8, width - 8, 8), width - 8]:
        out ^= out >> np.uint64(32)
        out ^= eight[at : at + n]
        out *= _MORE
    return mixed(out * _MIX)


def symbols(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, first_string: int = 0) -> np.ndarray:
    """The symbol from each place on; strings lie one after the other, each with a byte more as its terminator."""
    padded = np.concatenate((data, np.zeros(Q, np.uint8)))
    out = hashes(padded, Q)[: len(data)]
    left = np.repeat(starts + lengths, lengths) - np.arange(len(data))
    short = left <= Q
    number = np.repeat(np.arange(len(starts), dtype=np.uint64) + np.uint64(first_string), lengths)[short]
    out[short] = mixed((number * np.uint64(64) + left[short].astype(np.uint64)) * _MIX ^ _MORE)
    return out


def _stable(keys: np.ndarray) -> np.ndarray:
    """Stable order of keys below 2**32, by two rounds of sixteen bits."""
    order = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    high = keys >> 16
    return order[np.argsort(high[order].astype(np.uint16), kind="stable")] if high.any() else order


def _borders(symbol: np.ndarray, block: np.ndarray) -> np.ndarray:
    """Number of the block of equal prefixes at each rank, after dealing by symbol what was in blocks."""
    new = np.ones(len(symbol), bool)
    new[1:] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
    return np.cumsum(new, dtype=np.int32) - 1


@dataclass(frozen=True)
class Transform:
    """Places in the order of their suffixes, and the symbol before each."""

    places: np.ndarray
    before: np.ndarray

    def __len__(self) -> int:
        return len(self.places)


def transform(symbol: np.ndarray, offset: int) -> Transform:
    """Of one shard: its symbols by place; ``offset`` is added to the places."""
    n = len(symbol)
    order, block = np.arange(n, dtype=np.int32), np.zeros(n, np.int32)
    while n and block[-1] + 1 < n:
        back = (order - Q) % n
        dealt = _stable(symbol[back])
        block = _borders(symbol[back][dealt], block[dealt])
        order = back[dealt]
    return Transform(order + np.int32(offset), symbol[(order - Q) % n] if n else symbol)


def merge(a: Transform, b: Transform, depth: int | None = None) -> tuple[Transform, np.ndarray]:
    """The transform of both shards, and the blocks of ranks whose prefixes are equal.

    With a ``depth``, a multiple of Q, refinement ends there: blocks have common prefixes of so many bytes, and the
    result is in order by them, which is enough where it is not merged again.
    """
    n = len(a) + len(b)
    second = np.zeros(n, bool)
    second[len(a) :] = True
    block, step = np.zeros(n, np.int32), 0
    while n and block[-1] + 1 < n and (depth is None or step * Q < depth):
        symbol = np.empty(n, a.before.dtype)
        symbol[~second], symbol[second] = a.before, b.before
        dealt = _stable(symbol)
        second, block, step = second[dealt], _borders(symbol[dealt], block[dealt]), step + 1
    places, before = np.empty(n, a.places.dtype), np.empty(n, a.before.dtype)
    for chosen, shard in ((~second, a), (second, b)):
        places[chosen], before[chosen] = shard.places, shard.before
    return Transform(places, before), block


def equal_windows(data: np.ndarray, lengths: np.ndarray, width: int, shard_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and blocks (numbers) of the windows of ``width`` bytes inside strings that occur more than once.

    ``width`` is a multiple of Q. ``lengths`` include a byte after each string, its terminator. The strings are dealt into shards of whole strings, and those merged pairwise.
    """
    starts = np.cumsum(lengths) - lengths
    # Small numbers for the symbols, the same in all shards.
    symbol = np.unique(symbols(data, starts, lengths), return_inverse=True)[1].astype(np.int32)
    cuts = [0]
    for i, (start, length) in enumerate(zip(starts.tolist(), lengths.tolist(), strict=True), 1):
        if start + length - (starts[cuts[-1]] if cuts[-1] < len(starts) else 0) >= shard_bytes and i < len(starts):
            cuts.append(i)
    edges = [*(int(starts[c]) for c in cuts), len(data)]
    if len(edges) == 2:  # two shards at least
        middle = int(starts[len(starts) // 2])
        edges = [0, middle, len(data)]
    shards = [transform(symbol[x:y], x) for x, y in zip(edges[:-1], edges[1:], strict=True)]
    while len(shards) > 2:
        shards = [merge(shards[i], shards[i + 1])[0] if i + 1 < len(shards) else shards[i] for i in range(0, len(shards), 2)]
    whole, block = merge(*shards, depth=width)
    inside = (np.repeat(starts + lengths, lengths) - np.arange(len(data)) > width)[whole.places]
    places, block = whole.places[inside], block[inside]
    often = np.bincount(block)[block] > 1 if len(block) else np.zeros(0, bool)
    return places[often], block[often]
