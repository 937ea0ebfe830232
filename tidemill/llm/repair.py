"""Re-Pair grammars over token ids, in numpy."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

LEAST_USES = 16  # a rule is kept if it replaces so many pairs
START, FALL = 1 << 11, 4  # pairs of one in START are replaced first, then pairs FALL times rarer, and so on
WORTH = 64  # the last round saves less than one symbol in so many
_BUCKET_BITS = 18
_SPREAD = np.uint64(0x9E37_79B9_7F4A_7C15)
_MAGIC = b"RPT1"


@dataclass
class Grammar:
    """Ids below ``first`` stand for themselves; symbol ``first + i`` is the pair ``left[i], right[i]``.

    ``lengths[i]`` is how many ids rule ``i`` expands to, so that a place among the ids is found in
    ``sequence`` without expanding what lies before it.
    """

    first: int
    left: np.ndarray
    right: np.ndarray
    lengths: np.ndarray
    sequence: np.ndarray

    def ends(self) -> np.ndarray:
        """Number of ids up to the end of each symbol of ``sequence``."""
        size = np.ones(len(self.sequence), np.int64)
        rules = self.sequence >= self.first
        size[rules] = self.lengths[self.sequence[rules] - self.first]
        return np.cumsum(size)

    def expand(self, low: int = 0, high: int | None = None) -> np.ndarray:
        """The ids that symbols ``low:high`` of the sequence stand for."""
        rules: list[bytes] = []
        for one, two in zip(self.left.tolist(), self.right.tolist()):
            rules.append(self._raw(one, rules) + self._raw(two, rules))
        pool = np.concatenate((np.arange(self.first, dtype="<u4"), np.frombuffer(b"".join(rules), "<u4")))
        size = np.concatenate((np.ones(self.first, np.int64), self.lengths))
        begin = np.cumsum(size) - size
        symbols = self.sequence[low:high]
        own = size[symbols]
        shift = begin[symbols] - (np.cumsum(own) - own)
        return pool[np.arange(own.sum()) + np.repeat(shift, own)]

    def _raw(self, symbol: int, rules: list[bytes]) -> bytes:
        return symbol.to_bytes(4, "little") if symbol < self.first else rules[symbol - self.first]

    def span(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start:stop``, expanding no more symbols than hold them."""
        ends = self.ends()
        low, high = np.searchsorted(ends, start, "right"), np.searchsorted(ends, stop, "left") + 1
        before = int(ends[low - 1]) if low else 0
        return self.expand(low, high)[start - before : stop - before]

    def to_bytes(self) -> bytes:
        """Magic, first symbol, counts of rules and symbols, then rules, lengths and sequence.

        All numbers are unsigned and little-endian: 32 bits, or 16 for rules and sequence where all symbols fit.
        """
        kind = "<u2" if self.first + len(self.left) <= 1 << 16 else "<u4"
        head = np.array([self.first, len(self.left), len(self.sequence)], "<u4")
        parts = [self.left.astype(kind), self.right.astype(kind), self.lengths.astype("<u4"), self.sequence.astype(kind)]
        return _MAGIC + head.tobytes() + b"".join(x.tobytes() for x in parts)

    @classmethod
    def from_bytes(cls, data: bytes) -> Grammar:
        if data[:4] != _MAGIC:
            raise ValueError("not a block of Re-Pair symbols")
        first, rules, symbols = np.frombuffer(data, "<u4", 3, 4).tolist()
        kind = np.dtype("<u2" if first + rules <= 1 << 16 else "<u4")
        at, arrays = 16, []
        for count, dtype in ((rules, kind), (rules, kind), (rules, np.dtype("<u4")), (symbols, kind)):
            arrays.append(np.frombuffer(data, dtype, count, at).astype(np.int64))
            at += count * dtype.itemsize
        return cls(first, *arrays)


def _frequent(sequence: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that stand ``least`` times or more, the places where they begin, and which pair begins there.

    Pairs are first counted in hashed buckets, which can only overrate them; what passes is counted exactly.
    """
    pairs = sequence[:-1].astype(np.uint64) << np.uint64(32) | sequence[1:]
    bucket = (pairs * _SPREAD >> np.uint64(64 - _BUCKET_BITS)).view(np.int64)
    at = np.flatnonzero((np.bincount(bucket, minlength=1 << _BUCKET_BITS) >= least)[bucket])
    pairs = pairs[at]
    ordered = np.sort(pairs)
    ends = np.flatnonzero(np.append(ordered[1:] != ordered[:-1], True)) if len(ordered) else at
    known = ordered[ends[np.diff(ends, prepend=-1) >= least]]
    if not len(known):
        return known, at[:0], at[:0]
    found = np.minimum(np.searchsorted(known, pairs), len(known) - 1)
    exact = known[found] == pairs
    return known, at[exact], found[exact]


def _apart(at: np.ndarray) -> np.ndarray:
    """Every other place of each run of neighbouring places, so that no two pairs overlap."""
    place = np.arange(len(at))
    opens = np.ones(len(at), bool)
    opens[1:] = at[1:] != at[:-1] + 1
    return (place - np.maximum.accumulate(np.where(opens, place, 0))) & 1 == 0


def compress(ids: np.ndarray, first: int, least: int = LEAST_USES) -> Grammar:
    """Replace frequent pairs of symbols by new symbols until no pair is left that pays.

    A round replaces all pairs of at least a threshold at once, where the classic method takes one
    pair at a time; the threshold falls by :data:`FALL` from round to round until it is ``least``. Of overlapping pairs
    the left one goes first; a rule that then replaces fewer than ``least`` pairs is given up. The
    end is a round that saves less than one in :data:`WORTH` symbols.
    """
    sequence = ids.astype(np.uint32)
    left, right, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], np.ones(1, np.int64)  # an id is one long
    top, threshold = first, max(least, len(sequence) // START)
    while len(sequence) > 1:
        known, at, found = _frequent(sequence, threshold)
        apart = _apart(at)
        at, found = at[apart], found[apart]
        pays = np.bincount(found, minlength=len(known)) >= least
        keep = pays[found]
        at, found, known = at[keep], found[keep], known[pays]
        saved = len(at)
        if saved:
            sequence[at] = (top - 1 + np.cumsum(pays))[found]
            gone = np.ones(len(sequence), bool)
            gone[at + 1] = False
            sequence = sequence[gone]
            one, two = (known >> np.uint64(32)).astype(np.int64), (known & np.uint64(2**32 - 1)).astype(np.int64)
            left.append(one)
            right.append(two)
            size = lengths[np.maximum(one - first + 1, 0)] + lengths[np.maximum(two - first + 1, 0)]
            lengths = np.concatenate((lengths, size))
            top += len(known)
        if threshold == least and saved * WORTH <= len(sequence):
            break
        threshold = max(least, threshold // FALL)
    return Grammar(first, np.concatenate(left), np.concatenate(right), lengths[1:], sequence.astype(np.int64))
