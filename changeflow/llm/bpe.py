"""Byte-level BPE encoding and decoding as reductions of monoid trees.

The canonical encoding of a piece of text is an element of a monoid: the encodings of two neighbours
determine that of their concatenation. ``encode`` halves a piece down to leaves of a few bytes and
joins the halves. ``join`` re-encodes a window around the seam, taking one token of each side at
first and twice as many each time, until the tokens outside provably stay: a row of tokens is the
canonical one if and only if each neighbouring pair of it, spelled out and encoded by itself, gives
that pair again (merges go by rank, and a merge across a seam would have to happen in the pair next
to it as well). So when the pairs at both ends of the window pass, the rest needs no look.

Decoding concatenates the tokens' bytes up a tree as well: halves of the row of ids, then their bytes.

A text is cut into the matches of a pattern, and each match is encoded separately. Texts hold few
different matches, so workers remember them, ``REMEMBERED`` at most; the text itself is first cut at
single spaces between other characters, where the pattern always cuts, so that most of it never meets
the pattern. Texts of any length are encoded whole; rows stay in their partition, nothing is shuffled.

Cases: a null or empty text has no ids. Ids out of range fail. Repeated rows are encoded alike. Other
columns pass through; those named like the added ones are replaced.
"""

from __future__ import annotations

import array
import base64
import heapq
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import columns_of, kept, map_batches, row_of, with_row

#: Pieces of text, and pairs and halves, that a worker remembers.
REMEMBERED = 400_000
#: Most ids of a leaf in decoding.
DECODED_TOGETHER = 1 << 16
#: Most bytes of a leaf, which is encoded from the definition.
LEAF = 6

# A space with white space or an end of the text beside it; such texts are cut by the pattern alone.
_ODD_SPACE = re.compile(r"\s[ ]|[ ]\s|\A[ ]|[ ]\Z")


class Vocabulary:
    """Ranks of byte strings, with the monoid's operation on rows of them."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.spelled = [b""] * (max(ranks.values(), default=-1) + 1)
        for token, rank in ranks.items():
            self.spelled[rank] = token
        self.lengths = np.array([len(t) for t in self.spelled], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(self.spelled), np.uint8)
        self.known: dict[bytes, tuple[int, ...]] = {}
        self.fits: dict[tuple[int, int], bool] = {}

    def merged(self, text: bytes) -> tuple[int, ...]:
        """The canonical encoding from its definition: the lowest rank merges first, leftmost on ties.

        For leaves and windows. Every part is known by its first byte's place; a heap has the pairs that can merge.
        """
        ranks, n = self.ranks, len(text)
        if n < 2 or (n == 2 and text not in ranks):
            return tuple(ranks[text[i : i + 1]] for i in range(n))
        after = list(range(1, n + 1))  # where a part ends; the part there is its right neighbour
        before = list(range(-1, n - 1))
        heap = [(rank, i, i + 2) for i in range(n - 1) if (rank := ranks.get(text[i : i + 2])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, end = heapq.heappop(heap)
            middle = after[i]
            if middle >= n or middle <= i or after[middle] != end:
                continue  # one of the two parts has merged since
            after[i], after[middle] = end, 0
            if end < n:
                before[end] = i
                if (rank := ranks.get(text[i : after[end]])) is not None:
                    heapq.heappush(heap, (rank, i, after[end]))
            if (left := before[i]) >= 0 and (rank := ranks.get(text[left:end])) is not None:
                heapq.heappush(heap, (rank, left, end))
        out, i = [], 0
        while i < n:
            out.append(ranks[text[i : after[i]]])
            i = after[i]
        return tuple(out)

    def stays(self, left: int, right: int) -> bool:
        """Whether two tokens beside each other are their own canonical encoding."""
        pair = (left, right)
        if (fits := self.fits.get(pair)) is None:
            fits = self.merged(self.spelled[left] + self.spelled[right]) == pair
            if len(self.fits) < REMEMBERED:
                self.fits[pair] = fits
        return fits

    def join(self, left: tuple[int, ...], right: tuple[int, ...]) -> tuple[int, ...]:
        """The encoding of two neighbours from theirs."""
        if not left or not right:
            return left or right
        if self.stays(left[-1], right[0]):
            return left + right
        reach = 1
        while True:
            window = b"".join(self.spelled[t] for t in left[-reach:] + right[:reach])
            middle = self.merged(window)
            before, after = left[:-reach], right[reach:]
            if (not before or self.stays(before[-1], middle[0])) and (not after or self.stays(middle[-1], after[0])):
                return before + middle + after
            reach *= 2

    def encode(self, text: bytes) -> tuple[int, ...]:
        """The canonical encoding, by halves down to leaves."""
        if len(text) > LEAF:
            half = len(text) // 2
            return self.join(self.encode(text[:half]), self.encode(text[half:]))
        out = self.known.get(text)
        if out is None:
            out = self.merged(text)
            if len(self.known) < REMEMBERED:
                self.known[text] = out
        return out

    def encode_piece(self, text: bytes) -> tuple[int, ...]:
        """A match of the pattern: a token of the vocabulary as such, else its canonical encoding."""
        whole = self.ranks.get(text)
        return self.encode(text) if whole is None else (whole,)

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of a row of ids, by halves; a leaf gathers the bytes of its tokens."""
        if len(ids) > DECODED_TOGETHER:
            half = len(ids) // 2
            return self.decode(ids[:half]) + self.decode(ids[half:])
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        places = np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(ends[-1] if len(ids) else 0)
        return self.letters[places].tobytes()


def vocabulary(path: str) -> Vocabulary:
    """A file of lines "base64 rank"."""
    with open(path, "rb") as lines:
        return Vocabulary({base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)})


class TextEncoder:
    """Encodes texts by a vocabulary and a pattern, and remembers the parts between single spaces as packed ids."""

    def __init__(self, path: str, pattern: str):
        self.words, self.pattern = vocabulary(path), regex.compile(pattern)
        self.parts: dict[str, bytes] = {}

    def encode_part(self, part: str) -> bytes:
        ids = [t for piece in self.pattern.findall(part) for t in self.words.encode_piece(piece.encode())]
        packed = array.array("i", ids).tobytes()
        if len(self.parts) < REMEMBERED:
            self.parts[part] = packed
        return packed

    def encode(self, text: str) -> bytes:
        """The ids, each a signed integer of 32 bits."""
        if _ODD_SPACE.search(text):
            parts = [text]
        else:
            first, *rest = text.split(" ")
            parts = [first, *[" " + x for x in rest]]
        found = list(map(self.parts.get, parts))
        if None in found:
            found = [self.encode_part(part) if ids is None else ids for part, ids in zip(parts, found)]
        return b"".join(found)


def text_encoder(path: str, pattern: str) -> TextEncoder:
    return kept(("encoder", path, pattern), lambda: TextEncoder(path, pattern))


def encode_texts(documents: DataFrame, path: str, pattern: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """All rows with ``ids`` (array of int) and ``decoded`` (the bytes that they spell).

    Only the columns to ``keep`` go through the workers and come back, by default all.
    """
    others = [c for c in (documents.columns if keep is None else keep) if c not in ("ids", "decoded")]
    rows = documents.select(row_of(others), F.col(f"`{text}`").cast("string").alias("_text"))

    def work(batch: pa.RecordBatch) -> dict:
        encoder = text_encoder(path, pattern)
        packed = [encoder.encode(x or "") for x in batch.column(1).to_pylist()]
        ids = np.frombuffer(b"".join(packed), np.int32)
        ends = np.cumsum([0, *[len(x) // 4 for x in packed]])
        decoded = pa.array([encoder.words.decode(ids[a:z]) for a, z in zip(ends, ends[1:])], pa.binary())
        return {"_row": batch.column(0), "ids": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)), "decoded": decoded}

    return map_batches(rows, work, with_row(rows, "ids array<int>, decoded binary"), keeps=True).select(*columns_of(others), "ids", "decoded")
