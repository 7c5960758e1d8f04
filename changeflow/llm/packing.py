"""Vector bin packing of tokenised examples into training sequences.

An example has three amounts: tokens, segments (one for each piece) and loss-bearing tokens. A sequence
has a limit for each. Pieces as long as a sequence become sequences at once; what is left of an example
waits in a pool. A sequence is filled by the dot-product heuristic: of the examples that fit in all
three limits, the one whose amounts have the largest dot product with the room that is left, each
amount as a share of its limit, is placed next. If none fits, the one with the largest product that
can be cut is cut so that its head fills the room; its tail stays in the pool.

A pool holds ``POOL`` examples of one task; when it is full, sequences are filled until half of it is
used. At the end of a task the pool is emptied, and the last, unfilled sequence is cut into sequences
whose lengths are powers of two, which need no padding. So padding arises only where a limit other
than tokens binds. Rows stay in their partition, nothing is shuffled, and memory is bounded by the
pool; a task that runs again gives the same sequences.

``sequence_id`` has the number of the task in its upper bits, so it is unique without any exchange.

Cases: a null text is empty; every example ends with a separator, so none is without tokens. Repeated
rows are packed once each. Texts of any length are tokenised whole. Other columns pass through.
"""

from __future__ import annotations

import array
import json
import os
import string
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import columns_of, kept, prepare, row_of, with_row

#: Examples that wait in a task.
POOL = 1024
#: Parts of texts that a worker remembers the ids of (about 100 MB).
REMEMBERED = 600_000
# Marks that end a part; none of them is a letter, a digit or white space.
MARKS = string.punctuation


def ranked(tokenizer: Tokenizer) -> tiktoken.Encoding | None:
    """The merges of a byte-level tokenizer as ranks of byte strings, which merge words several times faster; None where its
    merges do not go by the ids or words are not taken as they are."""
    told = json.loads(tokenizer.to_str())
    model, cutter = told["model"], told["pre_tokenizer"] or {}
    if told["normalizer"] or model["type"] != "BPE" or model["dropout"] or model.get("ignore_merges") or cutter.get("type") != "ByteLevel":
        return None
    if not cutter["use_regex"] or cutter["add_prefix_space"] or any(model[k] for k in ("continuing_subword_prefix", "end_of_word_suffix")):
        return None
    # Byte-level vocabularies spell a byte as itself where it is visible, and else as the next of the characters from 256 on.
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    byte_of = {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}
    made = [model["vocab"]["".join(pair)] for pair in model["merges"]]
    ranks = {bytes(map(byte_of.__getitem__, token)): i for token, i in model["vocab"].items() if set(token) <= byte_of.keys()}
    letters = [ranks.get(bytes([b]), -1) for b in range(256)]
    if made != sorted(made) or min(letters) < 0 or max(letters) > min(made) or len(ranks) != 256 + len(made):
        return None
    return tiktoken.Encoding("ranked", pat_str=r" ?\p{L}+", mergeable_ranks=ranks, special_tokens={})


class Tokens:
    """Ids of texts as little-endian unsigned integers of 32 bits.

    The tokenizer's pattern always cuts at a single space between other characters. Texts are cut there
    first, and each different part is tokenised once as long as it is remembered. The pattern also cuts
    around a single line end between other characters, and between letters and the marks that end a part,
    so a part that is new is put together from such pieces, most of which are known. A part with white
    space beside its ends means that the text has other spaces; such a text is tokenised as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.ranked = ranked(self.tokenizer)
        self.parts: dict[str, bytes] = {}
        self.odd: set[str] = set()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        for at in range(0, len(texts), 10_000):
            for found in self.tokenizer.encode_batch_fast(texts[at : at + 10_000], add_special_tokens=False):
                yield array.array("I", found.ids).tobytes()

    def of_words(self, words: list[str]) -> Iterator[bytes]:
        """Words of letters alone, each one match of the pattern: merged by the ranks of the tokenizer's own file, which gives its ids."""
        if self.ranked is None:
            yield from self.encode(words)
        else:
            for word in words:
                yield array.array("I", self.ranked.encode_ordinary(word)).tobytes()

    @staticmethod
    def pieces(part: str) -> list[str]:
        """A part in pieces that the pattern always parts: letters, the marks behind them, line ends; or the part itself."""
        lines = part.split("\n")
        if len(lines) > 1 and any(not line or line[-1].isspace() or (i and line[0].isspace()) for i, line in enumerate(lines)):
            return [part]
        out = []
        for i, line in enumerate(lines):
            if i:
                out.append("\n")
            stem = line.rstrip(MARKS)
            if len(stem) < len(line) and stem.lstrip(" ").isalpha():
                out += (stem, line[len(stem) :])
            else:
                out.append(line)
        return out

    def learn(self, parts: set[str]) -> set[str]:
        """Remember the ids of new parts and of their pieces; all that is new."""
        known = self.parts
        mixed = [p for p in parts if not p[p[:1] == " " :].isalpha()]  # most are a word
        self.odd = {p for p in mixed if (bare := p[p[:1] == " " :]) == "" or bare != bare.strip()}
        made = {part: self.pieces(part) for part in mixed if part not in self.odd}
        new = {x for pieces in made.values() for x in pieces}.union(parts.difference(mixed)).difference(known)
        words = [x for x in new if x[x[:1] == " " :].isalpha()]
        known.update(zip(words, self.of_words(words)))
        rest = list(new.difference(words))
        known.update(zip(rest, self.encode(rest)))
        for part, pieces in made.items():
            if len(pieces) > 1:
                known[part] = b"".join([known[x] for x in pieces])
        return {*new, *made}

    def of(self, texts: list[str]) -> list[bytes]:
        # A text with the mark itself is odd, as a part with nothing in it.
        cut = [t.replace(" ", "\0 ").split("\0") if "\0" not in t else [""] for t in texts]
        known = self.parts
        new = set().union(*cut).difference(known)
        new = self.learn(new)
        odd = [i for i, parts in enumerate(cut) if not self.odd.isdisjoint(parts)] if self.odd else []
        for i, ids in zip(odd, self.encode([texts[i] for i in odd])):
            cut[i] = ids
        out = [parts if isinstance(parts, bytes) else b"".join(map(known.__getitem__, parts)) for parts in cut]
        if len(known) > REMEMBERED:
            for part in new:  # the parts that came first are the frequent ones
                del known[part]
        return out


def tokens(path: str) -> Tokens:
    return kept(("tokens", path), lambda: Tokens(path))


class Packer:
    """The pool of one task. Placed pieces are (row, start, length, sequence, offset, checksum of the ids)."""

    def __init__(self, limits: tuple[int, int, int], first_sequence: int):
        self.limits = np.array(limits, float)
        self.size = limits[0]
        self.next = first_sequence
        self.rows: list[int] = []
        self.starts: list[int] = []
        self.ids: list[bytes] = []
        # tokens, segments and loss-bearing tokens; the last ones come first in an example, the rest are separators.
        self.amounts = np.zeros((0, 3))
        self.placed: list[tuple[int, int, int, int, int, int]] = []

    def add(self, examples: list[tuple[int, bytes, int]]) -> None:
        """Rows with their ids and number of loss-bearing tokens."""
        new = []
        for row, ids, loss in examples:
            n, start = len(ids) // 4, 0
            while n - start >= self.size and self.limits[2] >= min(loss - start, self.size) and self.limits[1] >= 1:
                self.place(row, start, ids[4 * start : 4 * (start + self.size)], self.next, 0)
                self.next += 1
                start += self.size
            if start < n:
                self.rows.append(row)
                self.starts.append(start)
                self.ids.append(ids[4 * start :])
                new.append((n - start, 1, max(0, loss - start)))
        if new:
            self.amounts = np.concatenate([self.amounts, np.array(new, float)])

    def place(self, row: int, start: int, ids: bytes, sequence: int, offset: int) -> None:
        self.placed.append((row, start, len(ids) // 4, sequence, offset, zlib.crc32(ids)))

    def fill(self, until: int) -> None:
        """Fill sequences while more than so many examples wait."""
        waits = self.amounts[:, 0] > 0
        left = len(waits)
        shares = self.amounts / self.limits
        while left > until:
            room, offset, pieces = self.limits.copy(), 0, []
            while left and room[0] >= 1 and room[1] >= 1:
                worth = np.where(waits, shares @ (room / self.limits), -1.0)
                fits = np.where((self.amounts <= room).all(1), worth, -1.0)
                at = int(fits.argmax())
                length = int(self.amounts[at, 0])
                if fits[at] < 0:
                    at = int(worth.argmax())  # nothing fits whole, so this one is cut
                    length = min(length - 1, int(room[0]), int(room[2]) if self.amounts[at, 2] > room[2] else length)
                    if length < 1:
                        break
                ids = self.ids[at][: 4 * length]
                loss = min(self.amounts[at, 2], length)
                pieces.append((self.rows[at], self.starts[at], ids, offset))
                offset += length
                room -= (length, 1, loss)
                if length == self.amounts[at, 0]:
                    waits[at] = False
                    self.ids[at] = b""
                    left -= 1
                else:
                    self.ids[at] = self.ids[at][4 * length :]
                    self.starts[at] += length
                    self.amounts[at] -= (length, 0, loss)
                    shares[at] = self.amounts[at] / self.limits
            self.close(pieces, offset, last=left == 0)
        keep = np.flatnonzero(waits)
        self.rows, self.starts, self.ids = ([x[i] for i in keep] for x in (self.rows, self.starts, self.ids))
        self.amounts = self.amounts[keep]

    def close(self, pieces: list[tuple[int, int, bytes, int]], length: int, last: bool) -> None:
        """Number a sequence. One that is not full and the task's last is cut at powers of two."""
        if not last or length >= self.size:
            for row, start, ids, offset in pieces:
                self.place(row, start, ids, self.next, offset)
            self.next += 1
            return
        begin = 0
        while begin < length:
            end = begin + (1 << ((length - begin).bit_length() - 1))
            for row, start, ids, offset in pieces:
                a, z = max(offset, begin), min(offset + len(ids) // 4, end)
                if a < z:
                    self.place(row, start + a - offset, ids[4 * (a - offset) : 4 * (z - offset)], self.next, a - begin)
            self.next += 1
            begin = end


PIECES = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, sequence_tokens bigint"


def pack(
    documents: DataFrame, tokenizer: str, text: str = "text", limits: tuple[int, int, int] = (1024, 64, 1024), separator: int = 0, loss: str | None = None
) -> DataFrame:
    """One row for each piece: the other columns of its row, PIECES.

    ``limits``: tokens, segments and loss-bearing tokens of a sequence. ``loss`` names a column with the
    number of loss-bearing tokens, counted from the example's first; without it, all but separators bear loss.
    ``sequence_tokens`` is the length of the piece's sequence before padding.
    """
    prepare(documents.sparkSession)
    own = {part.split()[0] for part in PIECES.split(", ")}
    others = [c for c in documents.columns if c != text and c not in own]
    bearing = F.lit(None) if loss is None else F.col(f"`{loss}`")
    rows = documents.select(
        row_of(others),
        F.col(f"`{text}`").cast("string").alias("_text"), bearing.cast("long").alias("_loss"),
    )
    kinds = [pa.int64()] * 7
    names = ["_row", *[part.split()[0] for part in PIECES.split(", ")]]
    end = np.array([separator], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = Packer(limits, TaskContext.get().partitionId() << 40)
        held: dict[int, tuple[pa.RecordBatch, int, int]] = {}  # rows that still wait: their batch, place and tokens
        number = 0

        def pieces() -> Iterator[pa.RecordBatch]:
            placed, packer.placed = packer.placed, []
            if not placed:
                return
            lengths: dict[int, int] = {}
            for _, _, length, sequence, _, _ in placed:
                lengths[sequence] = lengths.get(sequence, 0) + length
            by_batch: dict[int, list] = {}
            for piece in placed:
                by_batch.setdefault(id(held[piece[0]][0]), []).append(piece)
            for some in by_batch.values():
                batch = held[some[0][0]][0]
                around = batch.column(0).take(pa.array([held[p[0]][1] for p in some]))
                values = [(s, n, crc, held[r][2], q, o, lengths[q]) for r, s, n, q, o, crc in some]
                yield pa.RecordBatch.from_arrays([around, *[pa.array(c, k) for c, k in zip(zip(*values), kinds)]], names=names)
            waiting = set(packer.rows)
            for row in [r for r in held if r not in waiting]:
                del held[row]

        for batch in batches:
            for at in range(0, batch.num_rows, POOL // 2):
                some = batch.slice(at, POOL // 2)
                texts = [x or "" for x in some.column(1).to_pylist()]
                thin = some.select([0])
                examples = []
                for i, (ids, n) in enumerate(zip(tokens(tokenizer).of(texts), some.column(2).to_pylist())):
                    ids += end
                    whole = len(ids) // 4
                    held[number] = (thin, i, whole)
                    examples.append((number, ids, whole - 1 if n is None else max(0, min(n, whole))))
                    number += 1
                packer.add(examples)
                if len(packer.rows) >= POOL:
                    packer.fill(POOL // 2)
                yield from pieces()
        packer.fill(0)
        yield from pieces()

    return rows.mapInArrow(run, with_row(rows, PIECES)).select(*columns_of(others), *names[1:])
