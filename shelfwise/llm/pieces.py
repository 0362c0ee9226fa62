"""The pieces of a text that byte-level merges never cross."""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

#: Characters whose classes a plain set can name: ASCII and the Latin-1 letters.
NOT_PLAIN = "[^\x00-\x7fÀ-ÖØ-öø-ÿ]"
_OTHER = re.compile(NOT_PLAIN)
_LETTER, _SPACE = "A-Za-zÀ-ÖØ-öø-ÿ", r" \t\n\r\f\v"


def plain_splitter():
    """``public_tokenizers.PATTERN`` on texts without other characters, for the faster ``re``.

    No two of its alternatives but the last two can begin at the same place with
    the same character, apart from the blank before a word, so the most frequent
    one stands first.
    """
    return re.compile(
        f" ?[{_LETTER}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[0-9]+| ?[^{_SPACE}{_LETTER}0-9]+"
        f"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
    ).findall


def is_plain(text: str) -> bool:
    """Whether ``plain_splitter`` splits this text as the full pattern does."""
    return _OTHER.search(text) is None


#: Classes of the bytes of plain texts: twice the class, a blank one more than other white space.
_LETTERS, _DIGITS, _SIGNS, _WHITE = 0, 2, 4, 6
_CLASSES = np.full(256, _SIGNS, np.uint8)
_CLASSES[[b for b in range(256) if chr(b).isascii() and chr(b).isalpha() or b >= 0x80]] = _LETTERS
_CLASSES[list(b"0123456789")] = _DIGITS
_CLASSES[list(b"\t\n\r\f\v")] = _WHITE
_CLASSES[ord(" ")] = _WHITE + 1


def split_plain(texts: pa.StringArray) -> pa.ListArray:
    """The pieces of ``plain_splitter`` of plain texts without nulls, worked out over their bytes at once.

    A piece begins where the class of the bytes changes. Of white space before a
    sign the last character stands alone, or begins the next piece if it is a
    blank; a shortened word ('s, 'll) goes apart from letters that follow it.
    """
    bounds = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
    size = int(bounds[-1] - bounds[0])
    data = np.zeros(size + 3, np.uint8)
    if size:
        data[:size] = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
    bounds = bounds - bounds[0]
    first = np.zeros(size + 3, bool)  # of a text
    first[bounds] = first[size:] = True
    kinds = _CLASSES[data]
    begins = first.copy()
    begins[1:] |= (kinds[1:] >> 1) != (kinds[:-1] >> 1)
    white = kinds >= _WHITE
    last = white[:-1] & ~white[1:] & ~first[1:]
    begins[:-1] |= last
    begins[1:] &= ~(last & (kinds[:-1] == _WHITE + 1))
    short = np.flatnonzero((data[:-2] == ord("'")) & begins[:-2] & ~first[1:-1])
    one, two = data[short + 1], data[short + 2]
    is_two = (two == ord("e")) & ((one == ord("r")) | (one == ord("v"))) | (two == ord("l")) & (one == ord("l"))
    is_two &= ~first[short + 2]
    is_one = np.isin(one, list(b"stmd"))
    begins[short[is_one | is_two] + 1] = False
    begins[short[is_one] + 2] = True
    begins[short[is_two] + 3] = True
    places = np.append(np.flatnonzero(begins[:size]), size).astype(np.int32)
    pieces = pa.StringArray.from_buffers(len(places) - 1, pa.py_buffer(places), pa.py_buffer(data))
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(places, bounds).astype(np.int32)), pieces)


def byte_letters() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class PieceModel:
    """The merges of a byte-level tokenizer on single pieces of its splitting pattern.

    It asks the tokenizer's own model, without the offsets, masks and token texts
    that an encoding makes: a quarter of the time for the same ids. The tokenizer
    must split by the byte-level pattern and change no text before.
    """

    def __init__(self, tokenizer: Tokenizer):
        config = json.loads(tokenizer.to_str())
        split = config["pre_tokenizer"] or {}
        if config["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex"):
            raise ValueError("the tokenizer does more than split by the byte-level pattern")
        self.model = tokenizer.model
        self.letters = {b: c for c, b in byte_letters().items()}
        self.blank = self.letters[ord(" ")]

    def ids(self, piece: str) -> list[int]:
        """Ids of one piece."""
        word = piece[1:] if piece[:1] == " " else piece
        if word.isalnum() and word.isascii():  # their letters stand for themselves
            letters = piece if word is piece else self.blank + word
        else:
            letters = piece.encode().decode("latin-1").translate(self.letters)
        return [t.id for t in self.model.tokenize(letters)]
