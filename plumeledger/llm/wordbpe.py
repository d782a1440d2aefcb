"""Exact and fast encoding with a word-level byte-pair tokenizer.

Such a tokenizer splits a text into units (a run of letters, one digit, a run of other
signs, an English contraction) and encodes every unit by itself, so a text's ids are the
ids of its units in order. A task therefore encodes each distinct unit once and gathers
the ids of whole texts from that dictionary with numpy. Texts with characters outside
Latin-1, where normalisation could join or split units, are encoded as they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from .textbytes import SpanHasher, chunks

_SPACE, _LETTER, _DIGIT, _SIGN, _OTHER = range(5)
#: Contractions of the tokenizer's pattern, fixed values.
_CONTRACTIONS = (b"s", b"t", b"re", b"ve", b"m", b"ll", b"d")


def _classes() -> np.ndarray:
    kinds = np.full(256, _OTHER, np.uint8)
    kinds[:128] = _SIGN
    kinds[[9, 10, 11, 12, 13, 32]] = _SPACE
    kinds[48:58] = _DIGIT
    kinds[65:91] = kinds[97:123] = _LETTER
    return kinds


class WordBpe:
    def __init__(self, path: str, known_limit: int = 1 << 20) -> None:
        """``known_limit``: the dictionary starts anew beyond so many units."""
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.kinds = _classes()
        self.hash = SpanHasher()
        self.known_limit = known_limit
        self._forget()

    def _forget(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.slots = np.zeros(0, np.int64)
        self.first = np.zeros(1, np.int64)
        self.flat = np.zeros(0, np.uint32)

    def encode(self, column: pa.Array, end_id: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        """Rows ``lo:hi``, their ids one after the other with ``end_id`` last, and offsets."""
        for lo, hi, data, offsets in chunks(column):
            ids, at = self._chunk(data, offsets, end_id)
            yield lo, hi, ids, at

    def _simple(self, data: np.ndarray, offsets: np.ndarray, kinds: np.ndarray) -> np.ndarray:
        """Mark Latin-1 letters in ``kinds``; which texts hold nothing but simple bytes."""
        lead = np.flatnonzero(data == 0xC3)
        if len(lead):
            follow = data[np.minimum(lead + 1, len(data) - 1)]
            lead = lead[(follow >= 0x80) & (follow != 0x97) & (follow != 0xB7)]
            kinds[lead] = kinds[lead + 1] = _LETTER
        # Separators 0x1C-0x1F and a special token's "<|" are left to the tokenizer itself.
        odd = (kinds == _OTHER) | ((data >= 0x1C) & (data <= 0x1F))
        odd[:-1] |= (data[:-1] == 0x3C) & (data[1:] == 0x7C)
        total = np.concatenate([[0], np.cumsum(odd)])
        return total[offsets[1:]] == total[offsets[:-1]]

    def _chunk(self, data: np.ndarray, offsets: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(offsets) - 1
        kinds = self.kinds[data]
        simple = self._simple(data, offsets, kinds) if len(data) else np.ones(n, bool)
        for i in np.flatnonzero(~simple):
            kinds[offsets[i] : offsets[i + 1]] = _SPACE
        lower = data.copy()
        lower[(data >= 65) & (data <= 90)] += 32
        upper = np.flatnonzero(data[:-1] == 0xC3) + 1
        upper = upper[(data[upper] >= 0x80) & (data[upper] <= 0x9E) & (data[upper] != 0x97)]
        lower[upper] += 0x20
        begins = np.zeros(len(data), bool)
        if len(data):
            begins[0] = True
            begins[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)
            begins[offsets[:-1][offsets[:-1] < len(data)]] = True
            self._contract(lower, kinds, begins, offsets)
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        real = kinds[starts] != _SPACE if len(starts) else np.zeros(0, bool)
        starts, ends = starts[real], ends[real]
        slot = self._lookup(lower, starts, ends)
        per_text = np.searchsorted(starts, offsets)
        sizes = self.first[slot + 1] - self.first[slot]
        ids_before = np.concatenate([[0], np.cumsum(sizes)])
        lengths = ids_before[per_text[1:]] - ids_before[per_text[:-1]] + 1
        whole = {}
        for i in np.flatnonzero(~simple):
            text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
            whole[i] = np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
            lengths[i] = len(whole[i]) + 1
        at = np.concatenate([[0], np.cumsum(lengths)])
        out = np.empty(at[-1], np.uint32)
        out[at[1:] - 1] = end_id
        # Ids of unit k go to its text's start plus the ids of the units before it there.
        text_of = np.repeat(np.arange(n), np.diff(per_text))
        shift = at[:-1][text_of] - ids_before[per_text[:-1]][text_of]
        within = np.arange(ids_before[-1]) - np.repeat(ids_before[:-1], sizes)
        out[np.repeat(ids_before[:-1] + shift, sizes) + within] = self.flat[
            np.repeat(self.first[slot], sizes) + within
        ]
        for i, ids in whole.items():
            out[at[i] : at[i + 1] - 1] = ids
        return out, at

    @staticmethod
    def _contract(lower: np.ndarray, kinds: np.ndarray, begins: np.ndarray, offsets: np.ndarray) -> None:
        """A quote that begins a unit takes the first contraction that follows it."""
        quotes = np.flatnonzero((lower == 0x27) & begins)
        if not len(quotes):
            return
        limit = offsets[np.searchsorted(offsets, quotes, "right")]
        open_ = np.ones(len(quotes), bool)
        for tail in _CONTRACTIONS:
            fits = open_ & (quotes + 1 + len(tail) <= limit)
            for k, byte in enumerate(tail):
                fits[fits] = lower[quotes[fits] + 1 + k] == byte
            at = quotes[fits]
            begins[at + 1] = False
            after = at + 1 + len(tail)
            begins[after[after < len(begins)]] = True
            open_ &= ~fits

    def _lookup(self, lower: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Dictionary slot of every unit; units not seen yet are encoded first."""
        hashes = self.hash(lower, starts, ends)
        distinct, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.keys) + len(distinct) > self.known_limit:
            self._forget()
        place = np.searchsorted(self.keys, distinct)
        held = place < len(self.keys)
        held[held] = self.keys[place[held]] == distinct[held]
        new = np.flatnonzero(~held)
        if len(new):
            self._learn(lower, distinct[new], starts[first[new]], ends[first[new]])
            place = np.searchsorted(self.keys, distinct)
        return self.slots[place][inverse]

    def _learn(self, lower: np.ndarray, keys: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> None:
        raw = lower.tobytes()
        units = [raw[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        texts = [b" ".join(units[i : i + 512]).decode() for i in range(0, len(units), 512)]
        encoded = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.asarray(e.ids, np.uint32) for e in encoded])
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) != len(units) or stops[-1] != len(ids):
            raise ValueError("the tokenizer does not encode these units one by one")
        old = len(self.first) - 1
        self.first = np.concatenate([self.first, len(self.flat) + stops])
        self.flat = np.concatenate([self.flat, ids])
        keys = np.concatenate([self.keys, keys])
        slots = np.concatenate([self.slots, old + np.arange(len(units))])
        order = np.argsort(keys)
        self.keys, self.slots = keys[order], slots[order]
