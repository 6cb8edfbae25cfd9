"""Token ids of whole texts by the ``tokenizers`` library, one distinct pre-token at a time.

A byte-level or word-end BPE never merges across pre-tokens, so the library's
model is asked once per distinct pre-token and worker, and its answer is reused.
Texts that hold other characters than ASCII and Latin letters, or a piece of a
special token, go to the library as they are, in segments cut at spaces between
ASCII letters, where no pre-token and no special token can reach across.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

# The end of both patterns is the library files' own; letters are those of SAFE.
_LETTER = "A-Za-zÀ-ÖØ-öø-ÿ"
_SAFE = re.compile(rf"[\t\n\r\x20-\x7e{_LETTER[6:]}]*")
_BYTE_LEVEL = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTER}]+| ?[0-9]+| ?[^\s{_LETTER}0-9]+|\s+(?!\S)|\s+")
_WORD_END = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[0-9]|[^\s{_LETTER}0-9]+")
_CUT = re.compile(r"(?<=[A-Za-z0-9]) (?=[A-Za-z0-9])")

#: What a text must pass to be taken apart here; the library has the last word, see ``Encoder``.
_PROBES = (
    "", " ", "  ", "a", " a", "a b", "a  b", "a   b ", "It's THE  end.\n\n Über-Maß, 1234 élan's\t%&*!$#|", "\n \n x", "I'LL we'Ll",
    "x\r\n y--z 3.14 ÀÉ", "don't  stop", "a\n", "|| | a|b", "''s '' ' t", "ß ÿ Ø ñandú 007",
)


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class Encoder(dict):
    """``encode(text)``: ids as little-endian unsigned 32-bit integers. The dictionary holds the known pre-tokens.

    most: pre-tokens held at once. At half of them the dictionary starts anew, beside what it held until then; of that,
          pre-tokens that come again are taken over, and the others go the next time.
    segment: least characters of a text that goes to the library in one call, where it can be cut.
    """

    def __init__(self, file: str, most: int = 250_000, segment: int = 20_000):
        from tokenizers import Tokenizer

        super().__init__()
        self._before: dict[str, bytes] = {}
        self.library = Tokenizer.from_file(file)
        self.most, self.segment = most, segment
        self.words = self.library.normalizer is not None
        self._split = (_WORD_END if self.words else _BYTE_LEVEL).findall
        self._letters = byte_letters()
        self._model = self.library.model
        self.apart = all(self._apart(t) == self._whole(t) for t in _PROBES)

    def __missing__(self, word: str) -> bytes:
        if (ids := self._before.get(word)) is not None:
            self[word] = ids
            return ids
        tokens = self._model.tokenize(word.encode().decode("latin-1").translate(self._letters))
        ids = self[word] = struct.pack(f"<{len(tokens)}I", *[t.id for t in tokens])
        return ids

    def _whole(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return struct.pack(f"<{len(ids)}I", *ids)

    def _apart(self, text: str) -> bytes:
        return b"".join(map(self.__getitem__, self._split(text.lower() if self.words else text)))

    def segments(self, text: str) -> Iterator[str]:
        start = 0
        for cut in _CUT.finditer(text):
            if cut.start() - start >= self.segment:
                yield text[start : cut.start()]
                start = cut.start()
        yield text[start:]

    def encode(self, text: str) -> bytes:
        if self.apart and "<|" not in text and _SAFE.fullmatch(text):
            if len(self) > self.most // 2:
                self._before = dict(self)
                self.clear()
            return self._apart(text)
        return b"".join(map(self._whole, self.segments(text)))


@lru_cache(maxsize=4)
def encoder(file: str, most: int = 250_000) -> Encoder:
    """One per worker process."""
    return Encoder(file, most)
