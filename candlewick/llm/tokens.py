"""Tokenizers inside tasks: loaded once per Python worker.

The vocabulary and the merges are read from the tokenizer's file.  Merges run
in ``tiktoken``, several times faster than in the library that the file is
written for, and with the same ids as long as every merge's result is
numbered in the order of the merges; that is checked when a file is loaded,
and any other file is left to its library.

* ``"spaced"``, byte-level with the usual pattern: a whole text at a time.
* ``"words"``, lower case with a word end and without white space: a text is
  cut at ASCII white space, and between a letter and ASCII punctuation, where
  no pattern or normalisation reaches across.  Each distinct chunk is encoded
  once and remembered (in a bounded memory); chunks that are not plain
  letters go to the library.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np

#: Chunks that a worker remembers in each of two generations.
MEMORY = 400_000
#: Letters in every version of Unicode, and what may follow the last of them at a cut.
_PLAIN = "[A-Za-zÀ-ÖØ-öø-ÿ]+"
_AFTER = r"(?=[ \t\n\r.,;:!?*#%&$|<>()]|$)"
_SPACED = re.compile(rf"\s*{_PLAIN}{_AFTER}|\s*\S+|\s+")
_WORDS = re.compile(rf"{_PLAIN}{_AFTER}|[^ \t\n\r]+")
_LETTERS = re.compile(_PLAIN)
#: White space to Python's ``re`` but perhaps not to the tokenizer's pattern.
_ODD = re.compile("[\x1c-\x1f᠎]")
#: Stands for the end of a word; no UTF-8 text has this byte.
_WORD_END = b"\xff"


def _byte_of() -> dict[str, int]:
    """Byte of each symbol of the byte-level alphabet: printable bytes stand
    for themselves, the others follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def _ranks(path: str, end: str) -> dict[bytes, int] | None:
    """Token bytes to ids, or None if ids don't follow the merges."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab, merges, byte_of = model["vocab"], model["merges"], _byte_of()
    base = 512 if end else 256
    pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
    if any(vocab.get(a.removesuffix(end) + b if end else a + b) != base + i for i, (a, b) in enumerate(pairs)):
        return None

    def raw(token: str) -> bytes | None:
        body = token.removesuffix(end) if end else token
        if any(c not in byte_of for c in body):
            return None
        return bytes(map(byte_of.get, body)) + (_WORD_END if body != token else b"")

    out = {raw(t): i for t, i in vocab.items() if i < base + len(pairs)}
    if end:     # the bare word end is never an id of its own, as it merges first of all
        out[_WORD_END] = max(vocab.values()) + 1
    return out if None not in out and len(out) >= base else None


class _Memory(dict):
    """Chunk to ids (packed 32-bit); on overflow the chunks become the older
    generation, from which those still met come back."""

    def __init__(self, encode):
        self.encode, self.older = encode, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self.older.get(chunk)
        if ids is None:
            ids = array("i", self.encode(chunk)).tobytes()
        self[chunk] = ids
        return ids

    def turn(self) -> None:
        if len(self) > MEMORY:
            self.older = dict(self)
            self.clear()


class Encoder:
    """``ids(text)`` equals the library's ids of the whole text."""

    def __init__(self, path: str, cut: str):
        import tiktoken
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.special = {t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.cut = cut
        ranks = _ranks(path, "</w>" if cut == "words" else "")
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"  # fixed value
        self.fast = ranks and tiktoken.Encoding(
            cut, pat_str=pattern, mergeable_ranks=ranks, special_tokens={} if cut == "words" else self.special)
        self.memory = _Memory(self._chunk)

    def _chunk(self, chunk: str) -> list[int]:
        if self.cut == "words" and self.fast and _LETTERS.fullmatch(chunk):
            return self.fast._encode_single_piece(chunk.lower().encode() + _WORD_END)
        return self.tokenizer.encode(chunk, add_special_tokens=False).ids

    def chunks(self, text: str) -> list[str]:
        """Pieces of the text that can be encoded one by one."""
        if self.cut == "words":
            return _WORDS.findall(text)
        return [text] if _ODD.search(text) else _SPACED.findall(text)

    def ids(self, text: str) -> np.ndarray:
        if self.cut == "spaced" and self.fast:
            if any(s in text for s in self.special):
                return np.array(self.fast.encode(text, allowed_special="all"), np.int32)
            return np.array(self.fast.encode_ordinary(text), np.int32)
        self.memory.turn()
        return np.frombuffer(b"".join(map(self.memory.__getitem__, self.chunks(text))), np.int32)

    def text(self, ids: list[int]) -> str:
        """The library's text of the ids, special tokens included."""
        if self.cut == "spaced" and self.fast:
            return self.fast.decode_bytes(ids).decode("utf-8", "replace")
        return self.tokenizer.decode(ids, skip_special_tokens=False)


@lru_cache(maxsize=4)
def encoder(path: str, cut: str) -> Encoder:
    return Encoder(path, cut)
