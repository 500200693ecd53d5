"""Token ids of whole texts, with a cache of the pieces that a text can be cut into.

Both tokenizers in use treat a word apart from its neighbours, so a text may be encoded
piece by piece where the cut is one that the tokenizer would make itself, and equal pieces
are encoded once. Texts for which that is not certain are encoded whole.
"""

from __future__ import annotations

import functools
import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa

CACHED_PIECES = 500_000

# besides white space that does not stand alone: the sign that parts pieces here, and odd white space
_UNSURE = re.compile(r"\s\s|\s\Z|\A\s|[\0\x1c-\x1f\x85\xa0]")
_ODD_SPACE = re.compile(r"[^\S \n]|\0")  # a text without any needs no closer look than for these pairs
_SPACE_PAIRS = ("  ", " \n", "\n ", "\n\n")

# How the two tokenizers cut a text into words, for signs up to U+00FF (letters, numbers, others),
# and the byte-level alphabet: printable bytes stand for themselves, the others are numbered from U+0100 on.
_L, _N = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe"
_S = "\t-\r \x85\xa0"
_SPACED = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d| ?[{_L}]+| ?[{_N}]+| ?[^{_S}{_L}{_N}]+|[{_S}]+(?![^{_S}])|[{_S}]+")
_BARE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")
_LATIN = re.compile("[\x01-\xff]*")
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_AS_SIGNS = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in set(_PLAIN))}
_SPACE_SIGN = chr(_AS_SIGNS[0x20])

# White space beyond ASCII in UTF-8: lead byte and the two bytes after it (of two-byte signs one) as a number.
_WIDE = [c.encode() for c in map(chr, range(0x80, 0x10000)) if c.isspace()]
_WIDE_2 = np.array([int.from_bytes(c, "big") << 8 for c in _WIDE if len(c) == 2], np.int32)
_WIDE_3 = np.array([int.from_bytes(c, "big") for c in _WIDE if len(c) == 3], np.int32)


def _odd_places(data: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Where white space but single spaces and line ends may be, and zero bytes. ``low``: places of bytes up to 0x20."""
    sign = data[low]
    plain = (sign == 0x20) | (sign == 0x0A)
    double = low[1:][(np.diff(low) == 1) & plain[1:] & plain[:-1]]
    lead = np.flatnonzero(data >= 0xC2)
    after = [data[np.minimum(lead + k, len(data) - 1)].astype(np.int32) for k in (1, 2)]
    number = (data[lead].astype(np.int32) << 16) | (after[0] << 8)
    wide = np.isin(number, _WIDE_2) | np.isin(number | after[1], _WIDE_3)
    return np.concatenate([low[~plain], double, lead[wide]])


def _unsure(text: str) -> bool:
    if _ODD_SPACE.search(text):
        return _UNSURE.search(text) is not None
    return text[:1] in (" ", "\n") or text[-1:] in (" ", "\n") or any(pair in text for pair in _SPACE_PAIRS)


class _Remembered(dict):
    """Values by key, made where they are first asked for."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        super().__init__()
        self._make = make

    def __missing__(self, key: str) -> bytes:
        value = self[key] = self._make(key)
        return value


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes.

    ``spaced`` is for a byte-level tokenizer, whose pieces keep the space before a word;
    otherwise white space is dropped and words stand alone.
    """

    def __init__(self, path: str, spaced: bool) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # a special token's name in a text is text
        self._tokenize = self._tokenizer.model.tokenize
        self._spaced = spaced
        self._words: dict[str, bytes] = {}
        # two generations: what was not asked for while one filled up is forgotten
        self._recent = _Remembered(self._again_or_new)
        self._older: dict[str, bytes] = {}
        # the same for the pieces of whole columns, in UTF-8
        self._column: dict[bytes, bytes] = {}
        self._column_older: dict[bytes, bytes] = {}

    def _whole(self, texts: list[str]) -> list[bytes]:
        out = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in out]

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece: of each of its words by the tokenizer's model, as the tokenizer itself does it."""
        if piece.isascii():
            text = piece if self._spaced else piece.lower()
            if (text[1:] if self._spaced and text[:1] == " " else text).isalpha():
                return self._word(text)
        elif not _LATIN.fullmatch(piece):
            return self._whole([piece])[0]
        else:
            text = piece if self._spaced else unicodedata.normalize("NFC", piece).lower()
        words, ids = self._words, []
        for word in (_SPACED if self._spaced else _BARE).findall(text):
            found = words.get(word)
            if found is None:
                if len(words) > CACHED_PIECES:
                    words.clear()
                found = words[word] = self._word(word)
            ids.append(found)
        return b"".join(ids)

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():
            signs = word.replace(" ", _SPACE_SIGN)  # the other printable ones stand for themselves
        else:
            signs = word.encode().decode("latin-1").translate(_AS_SIGNS)
        ids = array("I", [t.id for t in self._tokenize(signs)])
        if sys.byteorder == "big":
            ids.byteswap()
        return ids.tobytes()

    def pieces(self, text: str) -> list[str]:
        """Pieces whose ids, put together, are the text's ids."""
        if _unsure(text):
            return [text]
        if self._spaced:
            # one white space between words belongs to the word after it
            return text.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")
        return text.replace("\n", " ").split(" ")

    def _again_or_new(self, piece: str) -> bytes:
        ids = self._older.get(piece)
        return self._piece(piece) if ids is None else ids

    def _ids_of(self, pieces: list[bytes], alone: set[int]) -> list[bytes]:
        """Ids of different pieces; those at the places ``alone`` are whole texts, which are not remembered."""
        if len(self._column) > CACHED_PIECES:
            self._column_older, self._column = self._column, {}
        known, older = self._column, self._column_older
        out = list(map(known.get, pieces))
        texts = []
        for k in [k for k, ids in enumerate(out) if ids is None]:
            piece = pieces[k]
            if k in alone:
                texts.append(k)
                continue
            ids = older.get(piece)
            if ids is None:  # where white space is dropped, so is that before the piece
                text = piece if self._spaced or piece[:1] not in (b" ", b"\n") else piece[1:]
                ids = self._piece(text.decode())
            out[k] = known[piece] = ids
        for k, ids in zip(texts, self._whole([pieces[k].decode() for k in texts])):
            out[k] = ids
        return out

    def encode_column(self, texts: pa.Array) -> list[bytes]:
        """What ``encode`` gives, for a column: each piece that occurs in it is looked up once."""
        if len(texts) == 0:
            return []
        texts = texts.cast(pa.large_string()).fill_null("")
        _, places, signs = texts.buffers()
        starts = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(signs or b"", np.uint8)[starts[0] : starts[-1]]
        starts = starts - starts[0]
        low = np.flatnonzero(data <= 0x20)
        white = low[(data[low] == 0x20) | (data[low] == 0x0A)]
        in_text = np.diff(np.searchsorted(white, starts))
        # texts in one piece: those without white space between words, and those where cuts are not certain
        whole = in_text == 0
        filled = np.flatnonzero(np.diff(starts))
        edges = np.concatenate([starts[filled], starts[filled + 1] - 1])
        edges = edges[(data[edges] == 0x20) | (data[edges] == 0x0A)]
        odd = np.searchsorted(starts, np.concatenate([edges, _odd_places(data, low)]), side="right") - 1
        for k in np.unique(odd).tolist():
            whole[k] = whole[k] or _unsure(texts[k].as_py())
        bounds = np.sort(np.concatenate([starts, white[~np.repeat(whole, in_text)]]))
        n_pieces = np.where(whole, 1, in_text + 1)
        last = np.cumsum(n_pieces)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(data)]
        coded = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers).dictionary_encode()
        alone = set(coded.indices.to_numpy()[(last - n_pieces)[whole]].tolist())
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()  # to_pylist() takes twenty times as long
        ids = pa.array(self._ids_of(different, alone), pa.large_binary()).take(coded.indices)
        _, places, raw = ids.buffers()
        ends = np.frombuffer(places, np.int64)[last].tolist()
        held = memoryview(raw or b"")
        return [held[a:b].tobytes() for a, b in zip([0, *ends], ends)]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if len(self._recent) > CACHED_PIECES:
            self._older, self._recent = self._recent, _Remembered(self._again_or_new)
        get = self._recent.__getitem__
        cut = (self.pieces(t or "") for t in texts)
        return [b"".join(map(get, p)) if len(p) > 1 else self._whole(p)[0] for p in cut]


@functools.lru_cache(maxsize=4)
def encoder(path: str, spaced: bool) -> Encoder:
    """One per Python worker, so that tasks share what is cached."""
    return Encoder(path, spaced)
