"""Token counts by a SentencePiece model, most of them without running its merges.

Method (whole-token shortcut): no piece of the vocabulary spans the end of a
word and the space after it, so a text's count is the sum over its words, each
with the space mark before it. Which vocabulary strings encode alone as one
token is proved with the library itself, once per worker and for every piece; a
word among them counts 1 without further ado. Only the rest goes to the
library's merges, each distinct word once.

Nulls count as empty texts (0 tokens); an empty table gives an empty result;
repeated rows each give a row; other columns of the input are ignored. Long
texts are taken apart at their spaces, so no text is encoded in one call unless
it has none. The result holds for models without a normaliser that put a space
mark before the text; others raise ``ValueError``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeloom.llm.rows import batches, documents

MARK = "▁"  # stands for a space in pieces
_WORDS = re.compile(f"{MARK}*[^{MARK}]*")


class Counter(dict):
    """Token counts of words, each with its space marks in front.

    most: words held at once beside the proved ones; beyond it they are dropped, which costs time only.
    """

    def __init__(self, file: str, most: int = 400_000):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=file)
        self.most = most
        self.proved = proved(self.library)
        super().__init__(self.proved)

    def count(self, texts: list[str]) -> list[int]:
        if len(self) > len(self.proved) + self.most:
            self.clear()
            self.update(self.proved)
        split = [words(t) for t in texts]
        rest = list({w for of in split for w in of if w not in self})
        # the library puts the first mark in front by itself
        for word, ids in zip(rest, self.library.encode([w[1:].replace(MARK, " ") for w in rest], num_threads=1), strict=True):
            self[word] = len(ids)
        of = self.__getitem__
        return [sum(map(of, ws)) for ws in split]


def words(text: str) -> list[str]:
    """A text as the model sees it, cut before each run of space marks; the empty text has no words."""
    if not text:
        return []
    if MARK not in text and "  " not in text and text[0] != " " and text[-1] != " ":
        return [MARK + w for w in text.split(" ")]
    return [w for w in _WORDS.findall(MARK + text.replace(" ", MARK)) if w]


def proved(library) -> dict[str, int]:
    """The pieces that start with a space mark and that the library gives back as that one token, each with 1.

    Raises ValueError where the sum over words doesn't hold: a piece with a mark after another character, or a
    library that changes texts before it encodes them.
    """
    pieces = [library.id_to_piece(i) for i in range(library.vocab_size())]
    if any(MARK in p.lstrip(MARK) for p in pieces):
        raise ValueError("a piece reaches over the end of a word")
    for text in ("a  b ", " a", "ﬁ Å ①", "\t\r\n"):
        if library.decode(library.encode(text)) != text:
            raise ValueError("the model changes texts before it encodes them")
    if library.encode("a", out_type=str)[0][0] != MARK:
        raise ValueError("the model puts no space mark before a text")
    marked = [(i, p) for i, p in enumerate(pieces) if p.startswith(MARK)]
    found = library.encode([p[1:].replace(MARK, " ") for _, p in marked], num_threads=1)
    single = {p: 1 for (i, p), ids in zip(marked, found, strict=True) if ids == [i]}
    # a mark at the end of a text can't be asked for alone: it is a piece or its bytes
    return single | {MARK: 1 if MARK in pieces else len(MARK.encode())}


@lru_cache(maxsize=2)
def counter(file: str) -> Counter:
    return Counter(file)


def count_tokens(docs: DataFrame, file: str) -> DataFrame:
    """doc_id, n_bytes (UTF-8) and n_tokens of every text."""

    def run(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = counter(file)
        for batch in batches(frames):
            n = of.count(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
            )

    texts = documents(docs).withColumn("n_bytes", F.octet_length("text").cast("long"))
    return texts.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
