"""SentencePiece encoding and decoding of whole texts, with a suffix array instead of merges.

Method (suffix-array matching): a batch of texts is cut wherever no piece reaches
across, which is where the two characters stand side by side in no piece. The
stretches that no earlier batch had are put one after another, and a suffix
array of that text is built, ordered by as many characters as the longest piece
has. Binary search gives every piece its range of the array, that is all places
where it occurs. Each occurrence is an edge from its first to its last place; the
edges are sorted by where they end, and one walk over them relaxes each place: of
the pieces that end there, it takes the one that the model's merges leave last in
the stretch so far. Whether they do depends on that piece and the one before it
alone: two pieces stand side by side exactly if merging their joint string gives
those two again. That is asked once for each pair and remembered.

Why this is exact: the merges take the best pair of neighbours first, wherever it
is, so what happens inside a stretch that no merge crosses doesn't depend on the
rest. A sequence of pieces is the encoding exactly if each neighbouring pair is
its own encoding, and an encoding's beginning is the encoding of a beginning.

A stretch may be as long as its text. What is indexed at once is bounded all the
same: a window of characters is indexed with as many before it as the longest
piece has, and the walk goes on from the places relaxed in the window before. Of
a place behind the window only its last piece is kept, in four bytes.

Characters without a piece become the pieces of their UTF-8 bytes. Decoding joins
pieces and bytes and drops the mark in front; a space mark in a text comes back
as a space, as the library has it. A null or empty text has no ids and decodes to
the empty text. Repeated rows each give a row; an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import struct
import zlib
from array import array
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.rows import batches, documents
from lakeloom.llm.token_counts import MARK, proved

_BETWEEN = "\ud800"  # between texts and stretches: half a surrogate pair, which no text holds
_LAST = "\U0010ffff"
_EDGES = 50_000  # taken from numpy to Python at once


def suffix_order(codes: np.ndarray, depth: int) -> np.ndarray:
    """The places of a text ordered by their next ``depth`` characters (a power of two), by doubling."""
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64) + 1
    order, reach = np.argsort(rank, kind="stable"), 1
    while reach < depth:
        behind = np.zeros_like(rank)
        behind[:-reach] = rank[reach:]
        key = rank * (int(rank.max()) + 1) + behind
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty_like(rank)
        rank[order] = np.cumsum(np.concatenate(([1], ordered[1:] != ordered[:-1])))
        reach *= 2
    return order


def codes_of(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


class Pieces:
    """A model's pieces by id, and decoding with them."""

    def __init__(self, file: str):
        import sentencepiece

        self.library = library = sentencepiece.SentencePieceProcessor(model_file=file)
        n = library.vocab_size()
        self.names = [library.id_to_piece(i) for i in range(n)]
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(n) if library.is_byte(i)}
        aside = (library.is_byte, library.is_control, library.is_unknown, library.is_unused)
        self.own = [i for i in range(n) if not any(f(i) for f in aside)]
        self._raw = {i: self.names[i].replace(MARK, " ").encode() for i in self.own}
        self._raw |= {i: bytes([b]) for b, i in self.bytes.items()}

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self._raw.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if text.startswith(" ") else text


class Matcher(Pieces):
    """Encoding with them.

    most: stretches, and pairs of pieces, remembered; beyond it they are asked anew, which costs time only.
    most_letters: characters of the stretches remembered, likewise.
    block: characters indexed at once, about; of a longer stretch one window after the other.
    """

    def __init__(self, file: str, most: int = 400_000, block: int = 250_000, most_letters: int = 8_000_000):
        super().__init__(file)
        proved(self.library)  # raises for models that change texts
        self.most, self.block, self.most_letters, self.letters = most, block, most_letters, 0
        self.scores = {self.names[i]: self.library.get_score(i) for i in self.own}
        self.ids = {self.names[i]: i for i in self.own}
        # a piece that its own merges don't end with is in no encoding
        reached = [i for i in self.own if self._merged(self.names[i]) == [self.names[i]]]
        longest = max(len(self.names[i]) for i in reached)
        self.depth = 1 << (longest - 1).bit_length()
        self._piece = np.array(reached)
        self._size = np.array([len(self.names[i]) for i in reached])
        self._first = np.array([self.names[i] for i in reached], f"<U{self.depth}")
        self._behind = np.array([self.names[i] + _LAST for i in reached], f"<U{self.depth + 1}")
        pairs = {x + y for i in self.own for x, y in zip(self.names[i], self.names[i][1:], strict=False)}
        self._class = np.zeros(0x110000, np.uint16)  # 0: stands beside no other
        for number, letter in enumerate(sorted({x for p in pairs for x in p}), 1):
            self._class[ord(letter)] = number
        count = int(self._class.max()) + 1
        self._beside = np.zeros((count, count), bool)
        for p in pairs:
            self._beside[self._class[ord(p[0])], self._class[ord(p[1])]] = True
        self.known: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}

    def _merged(self, text: str) -> list[str]:
        """A short string by the model's own rule: the neighbours with the best joint piece first, leftmost of equals."""
        parts = list(text)
        scores = self.scores
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                score = scores.get(parts[i] + parts[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def _name(self, number: int) -> str:
        """Of a piece, or of a character without one, which has a number above them."""
        return self.names[number] if number < len(self.names) else chr(number - len(self.names))

    def _fits(self, one: int, two: int) -> bool:
        x, y = self._name(one), self._name(two)
        return self._merged(x + y) == [x, y]

    def occurrences(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Edges (end, start, piece) of all pieces in a text, sorted by end, the longest first."""
        codes = codes_of(text)
        order = suffix_order(codes, self.depth)
        padded = np.concatenate([codes, np.zeros(self.depth, np.uint32)])
        ahead = np.lib.stride_tricks.sliding_window_view(padded, self.depth)[order]
        suffixes = np.ascontiguousarray(ahead).view(self._first.dtype).ravel()
        low = np.searchsorted(suffixes, self._first, "left")
        counts = np.maximum(np.searchsorted(suffixes, self._behind, "left") - low, 0)
        piece = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(piece)) - np.repeat(np.cumsum(counts) - counts, counts)
        start = order[np.repeat(low, counts) + within]
        size = self._size[piece]
        end = start + size
        by_end = np.argsort(end * (self.depth + 1) - size, kind="stable")
        return end[by_end], start[by_end], self._piece[piece[by_end]]

    def _edges(self, text: str, skip: int) -> Iterator[tuple[int, int, int]]:
        """The edges that end behind the first ``skip`` places, taken to Python some thousand at a time."""
        end, start, piece = self.occurrences(text)
        for at in range(int(np.searchsorted(end, skip, "right")), len(end), _EDGES):
            to = at + _EDGES
            yield from zip(end[at:to].tolist(), start[at:to].tolist(), piece[at:to].tolist(), strict=True)

    def _walk(self, text: str, last: list[int], begins: set[int], skip: int = 0) -> None:
        """Relax the places of a text behind the first ``skip``, whose last pieces are known."""
        above = len(self.names)
        pairs, done = self.pairs, skip
        for end, start, piece in self._edges(text, skip):
            if last[end] < 0:
                while done < end - 1:  # a place that no piece reached: its character has none
                    done += 1
                    if last[done] < 0:
                        last[done] = above + ord(text[done - 1])
                if start in begins:
                    last[end] = piece
                else:
                    pair = last[start] << 32 | piece
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = self._fits(last[start], piece)
                    if fits:
                        last[end] = piece
        for place in range(done + 1, len(text) + 1):
            if last[place] < 0:
                last[place] = above + ord(text[place - 1])
        if len(pairs) > self.most:
            pairs.clear()

    def _remember(self, stretch: str, last: Sequence[int], begin: int = 0) -> None:
        """Read a stretch's pieces off its places, from its end back, and remember them."""
        above, at, ids = len(self.names), begin + len(stretch), array("I")
        while at > begin:
            name = self._name(last[at])
            ids.extend([last[at]] if last[at] < above else self._by_bytes(name)[::-1])
            at -= len(name)
        ids.reverse()
        self.known[stretch] = ids.tobytes()
        self.letters += len(stretch)

    def _relax(self, block: list[str]) -> None:
        """Encode stretches and remember them."""
        text = _BETWEEN.join(block)
        last = [-1] * (len(text) + 1)
        begins = np.cumsum([0, *(len(x) + 1 for x in block)])[:-1].tolist()
        self._walk(text, last, set(begins))
        for stretch, begin in zip(block, begins, strict=True):
            self._remember(stretch, last, begin)

    def _relax_long(self, stretch: str) -> None:
        """Encode one stretch, window after window, and remember it."""
        places = array("i", [-1])  # of the last piece at each place so far
        for at in range(0, len(stretch), self.block):
            back = min(at, self.depth)
            text = stretch[at - back : at + self.block]
            last = [*places[at - back :], *[-1] * (len(text) - back)]
            self._walk(text, last, set() if at else {0}, back)
            places.extend(last[back + 1 :])
        self._remember(stretch, places)

    def _by_bytes(self, letter: str) -> list[int]:
        known = self.ids.get(letter)
        return [known] if known is not None else [self.bytes[b] for b in letter.encode()]

    def _learn(self, stretches: set[str]) -> None:
        block, size = [], 0
        for stretch in stretches:
            if len(stretch) == 1:
                ids = self._by_bytes(stretch)
                self.known[stretch] = struct.pack(f"<{len(ids)}I", *ids)
                continue
            if len(stretch) > self.block:
                self._relax_long(stretch)
                continue
            block.append(stretch)
            size += len(stretch) + 1
            if size >= self.block:
                self._relax(block)
                block, size = [], 0
        if block:
            self._relax(block)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian unsigned 32-bit integers."""
        if len(self.known) > self.most or self.letters > self.most_letters:
            self.known.clear()
            self.letters = 0
        # as the model sees them: a mark for each space and one in front
        joined = _BETWEEN.join(MARK + t.replace(" ", MARK) if t else "" for t in texts) + _BETWEEN
        codes = codes_of(joined)
        letters = self._class[codes]
        cuts = np.flatnonzero(~self._beside[letters[:-1], letters[1:]]) + 1
        ends = [*cuts.tolist(), len(joined)]
        stretches = list(map(joined.__getitem__, map(slice, [0, *ends], ends)))
        self.known[_BETWEEN] = b""
        if new := set(stretches).difference(self.known):
            self._learn(new)
        # a text's stretches end with the mark between texts, which stands alone
        bounds = np.searchsorted(cuts, np.flatnonzero(codes == ord(_BETWEEN))).tolist()
        ids = list(map(self.known.__getitem__, stretches))
        return [b"".join(ids[a:b]) for a, b in zip([0, *(x + 1 for x in bounds)], [x + 1 for x in bounds], strict=False)]


@lru_cache(maxsize=2)
def matcher(file: str) -> Matcher:
    """One per worker process."""
    return Matcher(file)


@lru_cache(maxsize=2)
def pieces(file: str) -> Pieces:
    return Pieces(file)


def encode(docs: DataFrame, file: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of the ids as little-endian unsigned 32-bit integers) and ids of every text."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = matcher(file)
        for batch in batches(frames, 1000):
            ids = model.encode(batch.column("text").to_pylist())
            sizes = np.fromiter((len(x) // 4 for x in ids), np.int64, len(ids))
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(ids), "<i4")))
            sums = pa.array(map(zlib.crc32, ids), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes), sums, lists], ["doc_id", "n_tokens", "ids_crc32", "ids"]
            )

    return documents(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_crc32 long, ids array<int>")


def decode(encoded: DataFrame, file: str) -> DataFrame:
    """What has an ``ids`` column, with the text of the ids as one more column, ``decoded``."""

    @F.pandas_udf("string")
    def run(ids: pd.Series) -> pd.Series:
        model = pieces(file)
        return pd.Series([model.decode(x.tolist()) for x in ids], dtype=object)

    return encoded.withColumn("decoded", run("ids"))
