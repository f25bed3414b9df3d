"""Byte-level BPE over whole Arrow batches of texts with the `tokenizers` library.

The pre-tokens of this kind of tokenizer are runs of letters, of digits or of other
signs, each with one space before it at most, and runs of white space. Between two
bytes of known kind it is therefore certain where one pre-token ends and the next
begins, whatever stands around them. Texts are cut at such places, every distinct
piece is encoded once, and the ids of a text are the ids of its pieces in order.
Where a byte is of no known kind nothing is cut, so a piece may be longer than a
pre-token, up to a whole text. A new piece that is one word goes straight to the
library's BPE model; others are encoded many at a time, joined to longer strings, and
told apart by the byte lengths of their tokens.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from gridcast.llm.rolling import mix, pieces

_JOINED_BYTES = 1 << 15
_AT_ONCE = 8
_SLICE_BYTES = 1 << 19
_KNOWN_PIECES = 1 << 17
_PACKED = 24  # bytes of a piece that is kept, its length among them
_SPACE, _WHITE, _LETTER, _DIGIT, _SIGN, _OTHER = range(6)
_KIND = np.full(256, _OTHER, np.uint8)
_KIND[33:127] = _SIGN
_KIND[48:58] = _DIGIT
_KIND[65:91] = _KIND[97:123] = _LETTER
_KIND[9:14] = _WHITE
_KIND[32] = _SPACE


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string array, and the offsets of its texts; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    wide = pa.types.is_large_string(texts.type)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)[texts.offset:texts.offset + len(texts) + 1].astype(np.int64)
    if data is None or not len(texts):
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[bounds[0]:bounds[-1]], bounds - bounds[0]


def strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """An Arrow string array over bytes and offsets, without a copy."""
    kind, width = (pa.string(), np.int32) if offsets[-1] < 2**31 else (pa.large_string(), np.int64)
    buffers = [None, pa.py_buffer(np.ascontiguousarray(offsets, width)), pa.py_buffer(np.ascontiguousarray(data))]
    return pa.Array.from_buffers(kind, len(offsets) - 1, buffers)


_EMPTY, _LINE = pa.scalar("", pa.large_string()), pa.scalar("\n", pa.large_string())


def _kinds(data: np.ndarray) -> np.ndarray:
    kind = _KIND[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)  # with the next byte: letters, but for the signs of times and division
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    kind[lead] = kind[lead + 1] = _LETTER
    return kind


def _cuts(data: np.ndarray) -> np.ndarray:
    """Whether a pre-token surely begins at each byte; nothing is said of the first byte of a text."""
    kind = _kinds(data)
    plain = (kind >= _LETTER) & (kind <= _SIGN)
    blank = kind <= _WHITE
    before, here = slice(None, -1), slice(1, None)
    cut = np.zeros(len(data), bool)
    cut[here] = plain[before] & blank[here]
    cut[here] |= (kind[before] == _WHITE) & plain[here]
    cut[here] |= plain[before] & plain[here] & (kind[before] != kind[here]) & ~((data[before] == 39) & (kind[here] == _LETTER))
    # the last blank before a word stands apart from the blanks before it
    last = blank[before] & plain[here]
    cut[before] |= last & (kind[before] == _SPACE)
    cut[1:-1] |= last[1:] & blank[:-2]
    return cut


def _ranges(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ..., then those of first[1]: `size` numbers each."""
    upto = np.cumsum(size, dtype=np.int64)
    return np.repeat(first - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)


def _packed(raw: np.ndarray, at: np.ndarray, short: np.ndarray) -> np.ndarray:
    """The bytes and the length of each `short` piece in _PACKED bytes, as whole numbers."""
    wide = np.lib.stride_tricks.sliding_window_view(np.append(raw, np.zeros(_PACKED, np.uint8)), _PACKED)[at[:-1][short]]
    size = np.diff(at)[short]
    wide[np.arange(_PACKED) >= size[:, None]] = 0
    wide[:, -1] = size
    return wide.view(np.uint64)


def _hashed(known: np.ndarray) -> np.ndarray:
    hashes = np.zeros(len(known), np.uint64)
    for column in known.T:
        hashes = mix(hashes + column + np.uint64(0x9E3779B97F4A7C15))
    return hashes


def _byte_letters() -> list[str]:
    """The character that stands for each byte in the tokens of byte-level tokenizers."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b if b in shown else next(others)) for b in range(256)]


_BYTE_LETTERS = _byte_letters()


class PieceEncoder:
    """Encodes batches with the byte-level BPE tokenizer in the JSON file at `path`.

    Pieces shorter than _PACKED bytes stay known for later batches, up to _KNOWN_PIECES of them; beyond
    that, those that were asked for again are kept. They are found by a hash and compared byte by byte.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        if hasattr(self.model, "_resize_cache"):
            self.model._resize_cache(0)  # every piece is new to it
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # the characters of a byte-level token stand for one byte each
        self.token_bytes = np.array([len(self.tokenizer.id_to_token(i)) for i in range(size)], np.int64)
        self.width = 2 if size <= 1 << 16 else 4
        marks = sorted((t.content for t in self.tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
        self.added = re.compile(b"|".join(re.escape(m.encode()) for m in marks)) if marks else None
        self._forget()

    def _forget(self) -> None:
        # by hash: hashes, and the numbers of their pieces; by number: bytes and length, first id, number of ids, use
        self.hashes, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.known = np.zeros((0, _PACKED // 8), np.uint64)
        self.first = self.size = np.zeros(0, np.int32)
        self.again = np.zeros(0, bool)
        self.pool = np.zeros(0, np.uint32)

    def _shrink(self) -> None:
        """Keep what was asked for again; nothing if that is most of it."""
        kept = np.flatnonzero(self.again)
        known, first, size, pool = self.known[kept], self.first[kept], self.size[kept], self.pool
        self._forget()
        if 2 * len(kept) <= _KNOWN_PIECES:
            self._remember(known, size, pool[_ranges(first, size)])

    def _remember(self, known: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        hashes = _hashed(known)
        order = np.argsort(hashes, kind="stable")
        place = np.searchsorted(self.hashes, hashes[order])
        self.hashes = np.insert(self.hashes, place, hashes[order])
        self.numbers = np.insert(self.numbers, place, (len(self.known) + order).astype(np.int32))
        self.known = np.concatenate([self.known, known])
        self.first = np.append(self.first, (len(self.pool) + np.cumsum(size) - size).astype(np.int32))
        self.size = np.append(self.size, size.astype(np.int32))
        self.again = np.append(self.again, np.zeros(len(known), bool))
        self.pool = np.append(self.pool, ids)

    def _find(self, known: np.ndarray) -> np.ndarray:
        """The number of each packed piece, -1 if it is not known. Of several with one hash the first is found."""
        if not len(self.hashes):
            return np.full(len(known), -1)
        hashes = _hashed(known)
        order = np.argsort(hashes)
        place = np.empty(len(known), np.int64)
        place[order] = np.searchsorted(self.hashes, hashes[order])
        number = self.numbers[np.minimum(place, len(self.hashes) - 1)]
        return np.where((self.known[number] == known).all(1), number, -1)

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        # few at a time: an encoding takes far more memory than its ids
        found = [np.zeros(0, np.uint32)]
        for start in range(0, len(texts), _AT_ONCE):
            some = self.tokenizer.encode_batch_fast(texts[start:start + _AT_ONCE], add_special_tokens=False)
            found += [np.array(e.ids, np.uint32) for e in some]
        return np.concatenate(found), np.array([len(ids) for ids in found[1:]], np.int64)

    def _joined(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that each begin with a pre-token when joined, and the number of ids of each."""
        data, offsets = text_bytes(pieces)
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        steps = np.searchsorted(offsets, np.arange(0, offsets[-1], _JOINED_BYTES))
        edges = np.unique(np.concatenate([[0], offsets[steps], [offsets[-1]]]))
        raw = data.tobytes()
        ids, _ = self._ids([raw[a:b].decode() for a, b in zip(edges[:-1], edges[1:])])
        reached = np.cumsum(self.token_bytes[ids])
        last = np.searchsorted(reached, offsets[1:])
        if reached[-1] != offsets[-1] or (reached[last] != offsets[1:]).any():
            raise ValueError("a token of this tokenizer crosses the border of two pre-tokens")
        return ids, np.diff(np.append(0, last + 1))

    def _words(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pieces that are one pre-token each, without another look for pre-tokens, and the number of ids of each."""
        text = raw.tobytes().decode("latin-1").translate(_BYTE_LETTERS)
        bounds, ids, sizes = at.tolist(), [], []
        for a, b in zip(bounds, bounds[1:]):
            found = self.model.tokenize(text[a:b])
            sizes.append(len(found))
            ids += [token.id for token in found]
        return np.array(ids, np.uint32), np.array(sizes, np.int64)

    def _new(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces in order, and the number of ids of each."""
        raw, at = text_bytes(pieces)
        kind, start, long = _kinds(raw), at[:-1], np.diff(at)
        plain = (kind >= _LETTER) & (kind <= _SIGN)
        spaced = (long > 1) & (kind[start] == _SPACE) & plain[np.minimum(start + 1, len(raw) - 1)]
        bare = plain[start]
        # letters to the end, after one space at most
        letters = np.add.reduceat(kind == _LETTER, start, dtype=np.int64)
        word = (letters > 0) & (letters + spaced == long)
        spaced, bare = spaced & ~word, bare & ~word
        rest = ~(spaced | bare | word)
        groups = []
        ids, sizes = self._words(*text_bytes(pieces.filter(pa.array(word))))
        groups.append((word, ids, np.cumsum(sizes) - sizes, sizes))
        ids, sizes = self._joined(pieces.filter(pa.array(spaced)))
        groups.append((spaced, ids, np.cumsum(sizes) - sizes, sizes))
        # a line end before a word is a token of its own
        ids, sizes = self._joined(pc.binary_join_element_wise(_EMPTY, pieces.filter(pa.array(bare)), _LINE))
        groups.append((bare, ids, np.cumsum(sizes) - sizes + 1, sizes - 1))
        ids, sizes = self._ids(pieces.filter(pa.array(rest)).to_pylist())
        groups.append((rest, ids, np.cumsum(sizes) - sizes, sizes))
        first, size, begin = np.empty(len(pieces), np.int64), np.empty(len(pieces), np.int64), 0
        for mine, ids, at, sizes in groups:
            first[mine], size[mine] = at + begin, sizes
            begin += len(ids)
        return np.concatenate([ids for _, ids, _, _ in groups])[_ranges(first, size)], size

    def _slice(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets) - 1, np.int64)
        # an added token is a text of its own between the texts before and after it
        added = [m.span() for m in self.added.finditer(data.tobytes())] if self.added else []
        edges = np.unique(np.concatenate([offsets, np.array(added, np.int64).reshape(-1)]))
        begin, end = edges[:-1], edges[1:]
        filled = end > begin
        cut = np.append(_cuts(data), True)
        # what a cut looked at may lie in another text: the ends of texts are judged alone
        last = end[filled] - 1
        single = last == begin[filled]
        cut[last] = False
        body = last[~single]
        kind, before = _KIND[data[body]], _KIND[data[body - 1]]
        plain = lambda k: (k >= _LETTER) & (k <= _SIGN)
        cut[body] = plain(before) & (kind <= _WHITE) | (before == _WHITE) & plain(kind)
        for a, b in added:
            cut[a:b] = False
        cut[begin[filled]] = True
        bounds = np.flatnonzero(cut)
        coded = strings(data, bounds).dictionary_encode()
        distinct, which = coded.dictionary.cast(pa.large_string()), coded.indices.to_numpy()
        raw, at = text_bytes(distinct)
        short = np.diff(at) < _PACKED
        known = _packed(raw, at, short)
        number = np.full(len(distinct), -1)
        number[short] = self._find(known)
        new = number < 0
        self.again[number[~new]] = True
        first, size, pool = np.empty(len(distinct), np.int64), np.empty(len(distinct), np.int64), self.pool
        first[~new], size[~new] = self.first[number[~new]], self.size[number[~new]]
        if new.any():
            ids, sizes = self._new(distinct.filter(pa.array(new)))
            first[new], size[new] = len(pool) + np.cumsum(sizes) - sizes, sizes
            pool = np.append(pool, ids)
            kept = short[new]
            self._remember(known[new[short]], sizes[kept], ids[np.repeat(kept, sizes)])
        taken = size[which]
        upto = np.append(0, np.cumsum(taken))
        return pool[_ranges(first[which], taken)], np.diff(upto[np.searchsorted(bounds, offsets)])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and the number of ids of each text."""
        data, offsets = text_bytes(texts)
        ids, counts = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for a, b in pieces(offsets, _SLICE_BYTES):
            if len(self.known) > _KNOWN_PIECES:
                self._shrink()
            flat, n = self._slice(data[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a])
            ids.append(flat)
            counts.append(n)
        return np.concatenate(ids), np.concatenate(counts)
