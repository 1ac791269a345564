"""Token ids of whole texts, as the ``tokenizers`` library gives them.

A text is cut at spaces where no token can reach across, and a Python worker encodes each distinct chunk once and
remembers its ids. The result equals that of encoding the whole text, which the tests hold it to.
"""

from __future__ import annotations

import array
import functools
import hashlib
import os
import re
import sys
from collections.abc import Iterable

import numpy as np

#: Chunks a worker remembers, in each of two generations; the older one is forgotten when the newer is full.
REMEMBERED = 500_000
#: Longer chunks are encoded each time.
LONGEST = 64

_AT_SPACE = re.compile(r"(?<=\S) (?=\S)")
#: Letters that are their own normal form and have a simple lower case, and common marks behind them.
_PLAIN = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,|!?;:#$%&*]*)")
#: How byte-level vocabularies write a byte: printable ones of Latin-1 as themselves, the others from U+0100 on.
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_BYTE = {b: chr(b) for b in _SHOWN} | {b: chr(0x100 + i) for i, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}


def tokenizer_path(name: str) -> str:
    """Where a file of the installed public tokenizers lies."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_version(path: str) -> str:
    """Digest of the tokenizer's file: counts made with another version are other counts."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read()).hexdigest()


class _Memory(dict):
    def __init__(self, encode):
        super().__init__()
        self.encode, self.older = encode, {}

    def __missing__(self, chunk: str):
        value = self.older[chunk] if chunk in self.older else self.encode(chunk)
        if len(chunk) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.older = dict(self)
                self.clear()
            self[chunk] = value
        return value


class Encoder:
    """Ids of whole texts from one tokenizer file, without begin, end or padding.

    Null and empty texts have no ids. Strings of special tokens inside a text are treated as the library does by
    default; such texts are encoded whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.tokenizer = t = Tokenizer.from_file(path)
        t.no_truncation()
        t.no_padding()
        self.special = [x.content for x in t.get_added_tokens_decoder().values()]
        self.dtype = np.dtype("<u2" if t.get_vocab_size() <= 1 << 16 else "<u4")
        self.code = "H" if self.dtype.itemsize == 2 else "I"
        probe = lambda text: t.encode(text, add_special_tokens=False).ids
        #: Whether white space yields no id, as in vocabularies with word ends; else a space belongs to the next word.
        self.drops_space = probe("a b") == probe("a") + probe("b") and not probe(" ")
        self.lower = probe("ABC") == probe("abc")
        self.tail: dict[str, bytes] = {"": b""}
        self.first, self.later = _Memory(self._first), _Memory(self._later)

    def whole(self, text: str) -> bytes:
        return self._packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _packed(self, ids: list[int]) -> bytes:
        packed = array.array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _plain(self, chunk: str, space: str) -> bytes | None:
        """Ids of letters and punctuation behind them: two pieces for any of the vocabularies, so the model is asked for
        the letters, written as it has them, and the punctuation is looked up."""
        m = _PLAIN.fullmatch(chunk)
        if not m:
            return None
        if m[2] not in self.tail:
            if len(self.tail) > 10_000:
                self.tail = {"": b""}
            self.tail[m[2]] = self.whole(m[2])
        word = m[1].lower() if self.lower else m[1]
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTE)
        return self._packed([x.id for x in self.tokenizer.model.tokenize(space + word)]) + self.tail[m[2]]

    def _first(self, chunk: str) -> bytes:
        ids = self._plain(chunk, "")
        return self.whole(chunk) if ids is None else ids

    def _later(self, chunk: str) -> bytes | None:
        """Ids of a space and the chunk; None where no cut is allowed beside the chunk."""
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return None
        ids = self._plain(chunk, "Ġ")  # the letter by which byte-level vocabularies write a space
        return self.whole(f" {chunk}") if ids is None else ids

    def _chunks(self, text: str) -> Iterable[bytes]:
        if any(x in text for x in self.special):
            return [self.whole(text)]
        if self.drops_space:
            return map(self.first.__getitem__, text.replace("\n", " ").split(" "))
        first, *rest = text.split(" ")
        found = list(map(self.later.__getitem__, rest))
        if None in found or first and first[-1].isspace() or not first and rest:
            first, *rest = _AT_SPACE.split(text)
            found = [self.whole(f" {x}") for x in rest]
            return [self.whole(first), *found]
        return [self.first[first], *found]

    def ids(self, text: str | None) -> bytes:
        """The ids as little-endian integers of ``dtype``."""
        return b"".join(self._chunks(text)) if text else b""

    def count(self, text: str | None) -> int:
        return sum(map(len, self._chunks(text))) // self.dtype.itemsize if text else 0


@functools.lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder for each worker process, kept between its tasks."""
    return Encoder(path)
