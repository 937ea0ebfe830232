"""Token ids of texts by a public BPE vocabulary with word ends.

Such a vocabulary drops white space and never joins across it, so the ids of a text are those of its words
in turn. Words of plain letters, digits and signs are cut further where these meet, as the
vocabulary's own pattern does; all other words go through the tokenizer whole. Every distinct piece is encoded once and
then found by the hash of its bytes.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa

from tidemill.llm import kernels

VOCABULARY = "word_bpe_49k.json"
SLICE_BYTES = 1 << 20  # of texts that are worked on at once; a longer text is cut at white space
CACHE_BYTES = 96 << 20
_ENTRY = 120  # bytes that a known piece takes beside its ids
_SLOT_BITS = 20
_BATCH = 5_000

_ODD, _SPACE, _LETTER, _DIGIT, _SIGN = range(5)
_CLASS = np.full(256, _ODD, np.uint8)
_CLASS[0x21:0x7F] = _SIGN
_CLASS[[0x27, 0x3C]] = _ODD  # apostrophe and < may open longer patterns
_CLASS[0x30:0x3A] = _DIGIT
_CLASS[0x41:0x5B] = _CLASS[0x61:0x7B] = _LETTER
_CLASS[list(kernels.SEPARATORS)] = _SPACE
_LATIN = np.zeros(256, bool)  # second bytes of the letters U+00C0 to U+00FF, which come after 0xC3
_LATIN[0x80:0xC0] = True
_LATIN[[0x97, 0xB7]] = False


class _Pieces:
    """Which bytes of a slice of texts make up a piece, and the pieces' names."""

    def __init__(self, data: np.ndarray, texts: np.ndarray):
        """``texts`` are the places where texts begin."""
        kind = _CLASS[data]
        lead = np.flatnonzero(data[:-1] == 0xC3)
        lead = lead[_LATIN[data[lead + 1]]]
        kind[lead] = kind[lead + 1] = _LETTER
        lower = data + ((data >= 0x41) & (data <= 0x5A)).astype(np.uint8) * np.uint8(32)
        second = lead[data[lead + 1] <= 0x9E] + 1
        lower[second] += np.uint8(32)

        inside = kind != _SPACE
        first = np.zeros(len(data) + 1, bool)
        first[texts] = True
        first = first[:-1]
        opens = inside & first
        opens[1:] |= inside[1:] & ~inside[:-1]
        words = np.flatnonzero(opens)
        odd = np.unique(np.searchsorted(words, np.flatnonzero(kind == _ODD), "right")) - 1
        stops = np.append(words[1:], len(data))
        marks = np.zeros(len(data) + 1, np.int8)
        marks[words[odd]] = 1
        np.subtract.at(marks, stops[odd], 1)
        plain = np.cumsum(marks[:-1], dtype=np.int8) == 0
        cut = kind == _DIGIT
        cut[1:] |= kind[1:] != kind[:-1]
        opens |= inside & cut & plain
        closes = inside.copy()
        closes[:-1] &= opens[1:] | ~inside[1:]
        self.bytes = np.where(plain, lower, data)
        self.start, self.stop = np.flatnonzero(opens), np.flatnonzero(closes) + 1
        self.plain = plain[self.start]
        sums = kernels.prefix(kernels.BYTE_VALUES[self.bytes], kernels.BYTE_BASE)
        self.names = kernels.mix(kernels.span_hash(sums, self.start, self.stop, kernels.BYTE_BASE))


class WordEncoder:
    def __init__(self, name: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        from tokenizers import Tokenizer, pre_tokenizers

        self.whole = Tokenizer.from_file(name if "/" in name else public_tokenizers.path(name))
        self.parts = Tokenizer(self.whole.model)  # for pieces that need no normalizing and no pattern
        self.parts.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        self.size = self.whole.get_vocab_size()
        ending = self.whole.model.end_of_word_suffix
        self.ends = np.zeros(self.size, bool)
        self.ends[[at for token, at in self.whole.get_vocab().items() if token.endswith(ending)]] = True
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[int, int] = {}
        self.pool, self.used = np.zeros(1 << 16, np.uint32), 0
        self.bounds = np.zeros(1 << 14, np.int64)
        # a piece's number is looked up here first, under the high bits of its name
        self.slot_name = np.zeros(1 << _SLOT_BITS, np.uint64)
        self.slot_number = np.full(1 << _SLOT_BITS, -1, np.int32)

    def encode(self, column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
        """``(text, ids)`` in order; the ids of a long text come in several turns, an empty text has none."""
        data, bounds = kernels.text_buffer(column)
        at = 0
        while at < len(data):
            text = int(np.searchsorted(bounds, at + SLICE_BYTES, "right")) - 1
            stop = int(bounds[text])
            if stop <= at:
                stop = self._space(data, at + SLICE_BYTES, int(bounds[text + 1]))
            first, last = np.searchsorted(bounds, (at, stop), "right") - 1
            texts = np.clip(bounds[first : last + 2] - at, 0, stop - at)
            ids, places = self._slice(data[at:stop], texts[:-1])
            cuts = np.searchsorted(places, texts)
            for i, (low, high) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist())):
                if high > low:
                    yield int(first) + i, ids[low:high]
            at = stop

    @staticmethod
    def _space(data: np.ndarray, at: int, stop: int) -> int:
        """Place of the first separator of ``data[at:stop]``, or its end."""
        while at < stop:
            found = np.flatnonzero(_CLASS[data[at : min(stop, at + 4096)]] == _SPACE)
            if len(found):
                return at + int(found[0])
            at += 4096
        return stop

    def _slice(self, data: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids, and the byte where the piece of each id begins."""
        if 4 * self.used + _ENTRY * len(self.numbers) > CACHE_BYTES:
            self._forget()
        pieces = _Pieces(data, texts)
        slot = (pieces.names >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        number = self.slot_number[slot].astype(np.int64)
        far = np.flatnonzero((self.slot_name[slot] != pieces.names) | (number < 0))
        if len(far):
            names, index, inverse = np.unique(pieces.names[far], return_index=True, return_inverse=True)
            keys = names.tolist()
            known = self.numbers
            new = np.array([i for i, key in enumerate(keys) if key not in known], np.int64)
            self._learn(pieces, far[index[new]], [keys[i] for i in new.tolist()])
            found = np.array([known[key] for key in keys], np.int64)
            number[far] = found[inverse]
            slot = (names >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
            self.slot_name[slot], self.slot_number[slot] = names, found
            clash = self.slot_name[slot] != names  # of two in one slot, number and name must be of the same
            self.slot_number[slot[clash]] = -1
        low, size = self.bounds[number], self.bounds[number + 1] - self.bounds[number]
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        ids = self.pool[np.arange(total) + np.repeat(low - (stop - size), size)]
        return ids, np.repeat(pieces.start, size)

    def _learn(self, pieces: _Pieces, chosen: np.ndarray, keys: list[int]) -> None:
        raw = pieces.bytes.tobytes()
        spans = list(zip(pieces.start[chosen].tolist(), pieces.stop[chosen].tolist()))
        plain = pieces.plain[chosen]
        found: list[np.ndarray] = [None] * len(spans)
        simple, odd = np.flatnonzero(plain).tolist(), np.flatnonzero(~plain).tolist()
        for at in range(0, len(simple), _BATCH):
            batch = simple[at : at + _BATCH]
            joined = b" ".join([raw[slice(*spans[i])] for i in batch]).decode()
            ids = np.array(self.parts.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
            # the last token of every piece, and no other, is a word end
            stops = (np.flatnonzero(self.ends[ids]) + 1).tolist()
            if len(stops) != len(batch):
                raise ValueError("this vocabulary does not mark the ends of words")
            for i, low, high in zip(batch, [0, *stops], stops):
                found[i] = ids[low:high]
        for at in range(0, len(odd), _BATCH):
            batch = odd[at : at + _BATCH]
            texts = [raw[slice(*spans[i])].decode() for i in batch]
            for i, x in zip(batch, self.whole.encode_batch_fast(texts, add_special_tokens=False)):
                found[i] = np.array(x.ids, np.uint32)
        if not found:
            return
        ids, first = np.concatenate(found), len(self.numbers)
        while self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate((self.pool, np.zeros_like(self.pool)))
        while first + len(found) + 1 > len(self.bounds):
            self.bounds = np.concatenate((self.bounds, np.zeros_like(self.bounds)))
        self.pool[self.used : self.used + len(ids)] = ids
        self.bounds[first + 1 : first + 1 + len(found)] = self.used + np.cumsum([len(x) for x in found])
        self.used += len(ids)
        self.numbers.update(zip(keys, range(first, first + len(found))))


@cache
def encoder(name: str = VOCABULARY) -> WordEncoder:
    """The encoder of a vocabulary file, one for a worker's life."""
    return WordEncoder(name)
