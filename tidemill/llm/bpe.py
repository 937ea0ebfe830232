"""Token ids of many texts by a public byte-level BPE vocabulary.

Such a vocabulary never joins bytes across the start of a white-space run, so a text can be cut there and every
distinct piece encoded once. Texts with doubled or unusual white space are encoded whole.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa

from tidemill.llm import kernels

VOCABULARY = "byte_bpe_50k.json"
CACHE_BYTES = 24 << 20
SLICE_BYTES = 1 << 20  # longer texts are encoded in parts
_ENTRY = 21  # bytes that a known piece takes beside its ids, 8 of them while others are put in
_LONG = 64  # ids of a piece that is not worth keeping
_TOGETHER = 20_000  # pieces that the tokenizer gets at once

_SPACE = np.zeros(256, bool)  # ASCII bytes that some reader of regular expressions takes for white space
_SPACE[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
_BREAK = np.zeros(256, bool)
_BREAK[[0x20, 0x0A]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_STOP = np.zeros(256, bool)  # punctuation that often ends a word and is apart from its letters
_STOP[list(b".,;:!?)")] = True


def _shown() -> dict[int, str]:
    """How such a vocabulary writes each byte."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [x for x in range(256) if x not in kept]
    return {x: chr(x) for x in kept} | {x: chr(256 + i) for i, x in enumerate(rest)}


_SHOWN = _shown()


@cache
def _tokenizer(name: str):
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    import public_tokenizers
    from tokenizers import Tokenizer, pre_tokenizers

    tokenizer = Tokenizer.from_file(name if "/" in name else public_tokenizers.path(name))
    sizes = np.zeros(tokenizer.get_vocab_size(), np.int64)
    for token, at in tokenizer.get_vocab().items():
        sizes[at] = len(token)  # such a vocabulary writes each byte as one character
    cut, model, stops = tokenizer.pre_tokenizer, tokenizer.model, np.full(256, -1)
    for x in np.flatnonzero(_STOP).tolist():
        at = tokenizer.token_to_id(chr(x))
        stops[x] = -1 if at is None else at
    usual = isinstance(cut, pre_tokenizers.ByteLevel) and cut.use_regex and not cut.add_prefix_space and (stops[_STOP] >= 0).all()
    if not usual or tokenizer.normalizer or any(x.content.isalpha() for x in tokenizer.get_added_tokens_decoder().values()):
        model = None  # its words are not those of the usual pattern
    return tokenizer, sizes, _Known(), model, stops


def _places(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each start on, as many as it counts, one start after the other."""
    end = np.cumsum(count)
    return np.arange(end[-1] if len(end) else 0) + np.repeat(start - (end - count), count)


class _Table:
    """Ids of pieces in arrays, by ascending names."""

    def __init__(self):
        self.names = np.zeros(0, np.uint64)
        self.at, self.count = np.zeros(0, np.int32), np.zeros(0, np.uint8)
        self.ids = np.zeros(0, np.uint32)

    def find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the names that are here, and where they are."""
        where = np.searchsorted(self.names, names)
        here = np.flatnonzero(where < len(self.names))
        here = here[self.names[where[here]] == names[here]]
        return here, where[here]

    def add(self, names: np.ndarray, start: np.ndarray, count: np.ndarray, ids: np.ndarray) -> None:
        """``names`` ascend and are not here yet; ids of a piece are ``count`` from its start in ``ids`` on."""
        kept = count <= _LONG
        names, start, count = names[kept], start[kept], count[kept]
        to = np.searchsorted(self.names, names)
        self.names = np.insert(self.names, to, names)
        self.at = np.insert(self.at, to, len(self.ids) + np.cumsum(count) - count)
        self.count = np.insert(self.count, to, count)
        self.ids = np.concatenate((self.ids, ids[_places(start, count)]))

    def size(self) -> int:
        return _ENTRY * len(self.names) + 4 * len(self.ids)


class _Known:
    """Ids of pieces met before: a full table is kept until another is full, so pieces in use always stay."""

    def __init__(self):
        self.young, self.old = _Table(), _Table()

    def __len__(self) -> int:
        return len(self.young.names) + len(self.old.names)

    def size(self) -> int:
        return self.young.size() + self.old.size()

    def ids_of(self, names: np.ndarray, encoded) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each of the ascending names start, how many there are, and the ids.

        ``encoded`` gives the same for the numbers of names that are not known.
        """
        if self.young.size() > CACHE_BYTES // 2:
            self.young, self.old = _Table(), self.young
        start, count = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
        found, total = [], 0

        def put(which: np.ndarray, begin: np.ndarray, number: np.ndarray, ids: np.ndarray) -> None:
            nonlocal total
            start[which], count[which] = total + np.cumsum(number) - number, number
            found.append(ids[_places(begin, number)])
            total += len(found[-1])

        rest = np.arange(len(names))
        for table in (self.young, self.old):
            here, where = table.find(names[rest])
            put(rest[here], table.at[where], table.count[where].astype(np.int64), table.ids)
            rest = np.delete(rest, here)
            if table is self.young:
                later = rest
        put(rest, *encoded(rest))
        ids = np.concatenate(found)
        self.young.add(names[later], start[later], count[later], ids)
        return start, count, ids


def _letters(data: np.ndarray) -> np.ndarray:
    """Bytes of letters of ASCII, Latin-1 and the first extension of it."""
    found = _LETTER[data]
    at = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))
    at = at[(data[at] > 0xC3) | ((data[at + 1] != 0x97) & (data[at + 1] != 0xB7))]
    found[at] = found[at + 1] = True
    return found


def _wide_space(data: np.ndarray) -> np.ndarray:
    """Places of white space beyond ASCII, and a few that only begin like it."""
    found = []
    for first, second in ((0xC2, 0x85), (0xC2, 0xA0), (0xE1, 0x9A), (0xE2, 0x81), (0xE3, 0x80)):
        at = np.flatnonzero(data[:-1] == first)
        found.append(at[data[at + 1] == second])
    at = np.flatnonzero(data[:-2] == 0xE2)
    at = at[data[at + 1] == 0x80]
    last = data[at + 2]
    found.append(at[(last <= 0x8A) | (last == 0xA8) | (last == 0xA9) | (last == 0xAF)])
    return np.concatenate(found)


def _cut(data: np.ndarray, at: int) -> int:
    """First place from ``at`` on where a text may be cut: a single space or line break between printable ASCII.

    There a piece of the vocabulary's pattern ends and the next begins, whatever else stands in the text.
    """
    while at < len(data) - 1:
        near = data[at - 1 : at + 4097]
        plain = (near > 0x20) & (near < 0x7F)
        found = np.flatnonzero(_BREAK[near[1:-1]] & plain[:-2] & plain[2:])
        if len(found):
            return at + int(found[0])
        at += 4096
    return len(data)


def encode(column: pa.Array, vocabulary: str = VOCABULARY) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a block of texts, one after the other, and the bounds of each text's ids.

    A single long text is encoded in parts of about :data:`SLICE_BYTES`, cut where that changes no id; a text without such a
    place, a single word above all, is encoded whole.
    """
    data, bounds = kernels.text_buffer(column)
    if len(bounds) != 2 or len(data) <= 2 * SLICE_BYTES:
        return _encoded(data, bounds, vocabulary)
    found, at = [], 0
    while at < len(data):
        stop = _cut(data, at + SLICE_BYTES)
        found.append(_encoded(data[at:stop], np.array([0, stop - at]), vocabulary)[0])
        at = stop
    ids = np.concatenate(found)
    return ids, np.array([0, len(ids)])


def _encoded(data: np.ndarray, bounds: np.ndarray, vocabulary: str) -> tuple[np.ndarray, np.ndarray]:
    tokenizer, sizes, known, model, stops = _tokenizer(vocabulary)
    texts = len(bounds) - 1
    if not len(data):
        return np.zeros(0, np.uint32), np.zeros(texts + 1, np.int64)
    raw = data.tobytes()
    size = np.diff(bounds)
    full = np.flatnonzero(size)
    space = _SPACE[data]
    starts = np.zeros(len(data), bool)
    starts[bounds[full]] = True
    twice = np.flatnonzero(space[1:] & space[:-1] & ~starts[1:])
    odd_start = bounds[full][space[bounds[full]] & ~_BREAK[data[bounds[full]]]]
    odd = np.concatenate((twice, odd_start, _wide_space(data)))
    whole = np.zeros(texts, bool)
    whole[np.searchsorted(bounds, odd, "right") - 1] = True

    cut = starts | _BREAK[data]
    for text in np.flatnonzero(whole):
        cut[bounds[text] + 1 : bounds[text + 1]] = False
    start = np.flatnonzero(cut)
    end = np.append(start[1:], len(data))
    sums = kernels.prefix(kernels.BYTE_VALUES[data], kernels.BYTE_BASE)
    names = kernels.mix(kernels.span_hash(sums, start, end, kernels.BYTE_BASE) + (end - start).astype(np.uint64))
    names, first, inverse = np.unique(names, return_index=True, return_inverse=True)

    letters = np.concatenate(([0], np.cumsum(_letters(data))))

    def encoded(missing: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        s, e = start[first[missing]], end[first[missing]]
        alone = space[e - 1] | whole[np.searchsorted(bounds, s, "right") - 1]
        begin, count = np.zeros(len(missing), np.int64), np.zeros(len(missing), np.int64)
        found, total = [np.zeros(0, np.uint32)], 0
        for i in np.flatnonzero(alone).tolist():
            ids = tokenizer.encode(raw[s[i] : e[i]].decode(), add_special_tokens=False).ids
            begin[i], count[i] = total, len(ids)
            found.append(np.array(ids, np.uint32))
            total += len(ids)
        # letters, with a space before and a stop after them or without, are cut as they are: the model takes them at once
        stop = e - _STOP[data[e - 1]]
        inner = stop - s - (data[s] == 0x20)
        plain = ~alone & (inner > 0) & (letters[stop] - letters[s] == inner) & (model is not None)
        words, own = [], []
        last = np.where(stop < e, stops[data[e - 1]], -1)
        for i, j, end_id in zip(s[plain].tolist(), stop[plain].tolist(), last[plain].tolist()):
            own.append(len(words))
            words += [token.id for token in model.tokenize(raw[i:j].decode("latin-1").translate(_SHOWN))]
            if end_id >= 0:
                words.append(end_id)
        begin[plain], count[plain] = np.array(own, np.int64) + total, np.diff([*own, len(words)])
        found.append(np.array(words, np.uint32))
        total += len(words)
        # a piece at the start of a text gets a line break before it, dropped below
        rest = np.flatnonzero(~alone & ~plain)
        for at in range(0, len(rest), _TOGETHER):
            part = rest[at : at + _TOGETHER]
            size = e[part] - s[part]
            bare = ~_BREAK[data[s[part]]]
            joined = np.insert(data[_places(s[part], size)], (np.cumsum(size) - size)[bare], 0x0A)
            ids = tokenizer.encode_batch_fast([joined.tobytes().decode()], add_special_tokens=False)[0].ids
            found.append(np.array(ids, np.uint32))
            stop = np.searchsorted(np.cumsum(sizes[found[-1]]), np.cumsum(size + bare)) + 1
            own = np.concatenate(([0], stop[:-1])) + bare
            begin[part], count[part] = total + own, stop - own
            total += len(ids)
        return begin, count, np.concatenate(found)

    at, lengths, values = known.ids_of(names, encoded)
    count = lengths[inverse]
    ids = values[_places(at[inverse], count)]
    before = np.concatenate(([0], np.cumsum(count)))
    return ids, before[np.searchsorted(start, bounds)]
