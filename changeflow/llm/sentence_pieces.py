"""SentencePiece encoding and decoding by a table of prefixes (merge-type vocabularies).

The pieces of a merge-type model (BPE) have a property that makes a table possible: a row of pieces is
the encoding of its text if and only if each neighbouring pair of it, joined and encoded by itself,
gives that pair again. (Merges go by score, leftmost on ties; a merge across a seam would have to
happen in the pair beside it as well.) So every prefix of an encoding encodes that prefix, and

    each prefix of a text has one *last piece*: of the pieces that end there, the one which stands at
    the beginning or fits the last piece of the prefix before it.

``encode`` runs an automaton of all pieces over the text, which names the pieces that end at each
place, tests them against the last piece before them, and stores the one that fits. The ids are then
read from the table backwards. A character that no piece holds ends every merge: it fits anything, and
is spelled in byte pieces. Whether two pieces fit is decided by merging their joined text from the
definition, and remembered. Pieces that are not their own encoding never occur and stay out.

Where no piece has a space mark behind another character, none reaches over such a place, so texts are
cut there and workers remember the parts (``Memory``, bounded); other vocabularies are not cut. A text
of any length is encoded whole, with four bytes of table for each character of its longest part.
Rows stay in their partition, nothing is shuffled.

Decoding joins what the ids spell, without the space that encoding puts before a text. A space mark in
the text itself comes back as a space, as it does in the library.

Cases: a null or empty text has no ids but those of begin and end. Ids out of range fail. Repeated rows
are encoded alike. The caller's other columns pass through; those named like the added ones are replaced.
Models that normalise, drop spaces or lack byte pieces are refused, as are those without merges.
"""

from __future__ import annotations

import array
import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Memory, columns_of, kept, map_batches, row_of, with_row

SPACE = "\u2581"
#: Parts of texts that a worker remembers, and pairs of pieces.
REMEMBERED = 150_000
#: Characters of a text whose parts are looked up together.
TOGETHER = 1 << 20
#: A character that no piece holds.
ALONE = -1

_PART = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
_SEAM = re.compile(f"[^{SPACE}]{SPACE}")


class Pieces:
    """A merge-type vocabulary: which pieces fit beside each other, encoding by the table, and decoding."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(len(model))
        self.begin, self.end = model.bos_id(), model.eos_id()
        spelled = [model.id_to_piece(i) for i in ids]
        plain = [i for i in ids if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        self.bytes_of = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.id_of = {spelled[i]: i for i in plain}
        order = {score: rank for rank, score in enumerate(sorted({model.get_score(i) for i in plain}, reverse=True))}
        self.rank_of = {spelled[i]: order[model.get_score(i)] for i in plain}
        letters = set("".join(self.id_of))
        odd = " a\u00a0\ufb01  b "
        if not all(map(model.is_byte, self.bytes_of)) or model.normalize(odd) != SPACE + odd.replace(" ", SPACE):
            raise ValueError("the model normalises texts, or has no byte pieces")
        if not letters <= self.id_of.keys():
            raise ValueError("characters of pieces that are no pieces themselves")
        self.cuts = not any(SPACE in piece.lstrip(SPACE) for piece in self.id_of)
        self.spelled, self.sizes = spelled, [len(p) for p in spelled]
        self.automaton = ahocorasick.Automaton()
        for piece, i in self.id_of.items():
            if len(piece) == 1 or self.merged(piece) == [piece]:
                self.automaton.add_word(piece, (i, len(piece)))
        self.automaton.make_automaton()
        self.fitting, self.known = Memory(4 * REMEMBERED), Memory(REMEMBERED)
        # What each id spells in decoding.
        surface = [p.replace(SPACE, " ").encode() for p in spelled]
        for i in ids:
            if model.is_control(i):
                surface[i] = b""
            elif model.is_unknown(i):
                surface[i] = " \u2047 ".encode()
        for b, i in enumerate(self.bytes_of):
            surface[i] = bytes([b])
        self.silent = {i for i in ids if not surface[i]}
        self.spaced = {i for i in plain if spelled[i].startswith(SPACE)}
        self.lengths = np.array([len(x) for x in surface], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.letters = np.frombuffer(b"".join(surface), np.uint8)

    def merged(self, text: str) -> list[str]:
        """A short text in pieces, from the definition: the best score merges first, leftmost on ties."""
        parts, rank_of = list(text), self.rank_of
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                rank = rank_of.get(parts[i] + parts[i + 1])
                if rank is not None and (best is None or rank < best):
                    best, at = rank, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether two pieces beside each other are their own encoding."""
        key = left << 32 | right
        told = self.fitting.get(key)
        if told is None:
            pair = [self.spelled[left], self.spelled[right]]
            told = self.merged(pair[0] + pair[1]) == pair
            self.fitting.put(key, told)
        return told

    def last_pieces(self, text: str) -> array.array:
        """The last piece of each prefix: its id, or ALONE where the prefix ends with a character that no piece holds."""
        last, known = array.array("i", [ALONE]) * (len(text) + 1), self.fitting.young
        for at, (piece, size) in self.automaton.iter(text):
            if last[at + 1] >= 0:
                continue
            before = last[at + 1 - size]
            if before < 0:  # the beginning, or behind a character that fits anything
                last[at + 1] = piece
                continue
            told = known.get(before << 32 | piece)
            if told is None:
                told, known = self.fits(before, piece), self.fitting.young
            if told:
                last[at + 1] = piece
        return last

    def encode_part(self, text: str) -> bytes:
        """The ids of a part, recovered from the end of the table, as signed integers of 32 bits."""
        last, out, at = self.last_pieces(text), array.array("i"), len(text)
        while at:
            piece = last[at]
            if piece == ALONE:
                out.extend(self.bytes_of[b] for b in reversed(text[at - 1].encode()))
                at -= 1
            else:
                out.append(piece)
                at -= self.sizes[piece]
        out.reverse()
        return out.tobytes()

    def parts(self, text: str) -> Iterator[list[str]]:
        """A marked text in lists of parts that no piece reaches over; a list holds about TOGETHER characters, or one longer part."""
        if not self.cuts:
            yield [text]
            return
        first = 0
        while first < len(text):
            cut = _SEAM.search(text, first + TOGETHER)
            last = cut.start() + 1 if cut else len(text)
            yield _PART.findall(text, first, last)
            first = last

    def encode(self, text: str, begin: bool = False, end: bool = False) -> bytes:
        """The ids, each a signed integer of 32 bits."""
        out = [array.array("i", [self.begin]).tobytes()] if begin else []
        if text:
            for parts in self.parts(SPACE + text.replace(" ", SPACE)):
                found = list(map(self.known.young.get, parts))
                if None in found:
                    for i, ids in enumerate(found):
                        if ids is None and (ids := self.known.get(parts[i])) is None:
                            ids = self.encode_part(parts[i])
                            self.known.put(parts[i], ids)
                        found[i] = ids
                out.append(b"".join(found))
        if end:
            out.append(array.array("i", [self.end]).tobytes())
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> str:
        """What the ids spell; the space before the first piece goes."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        places = np.repeat(self.starts[ids] - ends + lengths, lengths) + np.arange(ends[-1] if len(ids) else 0)
        text = self.letters[places].tobytes().decode("utf-8", "replace")
        first = next((int(i) for i in ids if int(i) not in self.silent), None)
        return text[1:] if first in self.spaced else text


def pieces(path: str) -> Pieces:
    """A worker's vocabulary."""
    return kept(("pieces", path), lambda: Pieces(path))


def encode_texts(
    documents: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, begin: bool = True, end: bool = True, packed: bool = False
) -> DataFrame:
    """All rows with ``ids`` and ``decoded``, the text that they spell.

    The ids are an array of int or, if ``packed``, binary: each a little-endian integer of 32 bits. Only the columns to
    ``keep`` go through the workers and come back, by default all.
    """
    keep = [c for c in (documents.columns if keep is None else keep) if c not in ("ids", "decoded")]
    rows = documents.select(row_of(keep), F.col(f"`{text}`").cast("string").alias("_text"))

    def work(batch: pa.RecordBatch) -> dict:
        words = pieces(path)
        found = [words.encode(x or "", begin, end) for x in batch.column(1).to_pylist()]
        spelled = pa.array([words.decode(np.frombuffer(x, np.int32)) for x in found], pa.string())
        if packed:
            ids = pa.array(found, pa.binary())
        else:
            ends = np.cumsum([0, *[len(x) // 4 for x in found]])
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(found), np.int32)))
        return {"_row": batch.column(0), "ids": ids, "decoded": spelled}

    schema = with_row(rows, f"ids {'binary' if packed else 'array<int>'}, decoded string")
    return map_batches(rows, work, schema, keeps=True).select(*columns_of(keep), "ids", "decoded")
