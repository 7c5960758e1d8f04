"""Helpers that several operators share: workers' import path, Arrow batches, and hashes of words."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The bytes that separate words.
SPACES = bytes([0x20, *range(0x09, 0x0E)])

_IS_WORD = np.ones(256, bool)
_IS_WORD[list(SPACES)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_KEYS = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
#: Bytes that are hashed together; the arrays need about 40 bytes for each.
CHUNK_BYTES = 1 << 20
#: Rows and bytes that are worked on together, of the thousands of rows in an Arrow batch.
ROWS = 512
SLICE_BYTES = 4 << 20

_kept: tuple[object, object] = (None, None)


def kept(key: object, make: Callable[[], object]) -> object:
    """What a worker keeps from task to task: the tables of one operator, the last that it worked for."""
    global _kept
    if _kept[0] != key:
        if _kept[1] is not None:
            _kept = (None, None)  # before the new ones are made
            give_back()
        _kept = (key, make())
    return _kept[1]


def give_back() -> None:
    """Return what a worker has let go of to the system, which others on its node may need; where the C library can."""
    gc.collect()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def prepare(spark: SparkSession) -> None:
    """Let Python workers of a local session import this package wherever the driver was started.

    On a cluster the package is installed on the nodes, as with any Python dependency.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{root}:{paths}".rstrip(":")


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in slices of at most ROWS rows and about SLICE_BYTES; a larger row is a slice of its own."""
    first = 0
    while first < batch.num_rows:
        rows = min(ROWS, batch.num_rows - first)
        while rows > 1 and batch.slice(first, rows).nbytes > SLICE_BYTES:
            rows //= 2
        yield batch.slice(first, rows)
        first += rows


class Memory:
    """What a worker remembers: the last ``size`` to twice as many entries that were asked for, in two generations."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        """The value or None. An older entry that is asked for is young again."""
        value = self.young.get(key)
        if value is None and (value := self.old.get(key)) is not None:
            self.put(key, value)
        return value

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value


def map_batches(
    df: DataFrame, work: Callable[[pa.RecordBatch], dict | None], schema: str | T.StructType, keeps: bool = False
) -> DataFrame:
    """``work`` turns an Arrow batch into columns by name; the rows stay in their partition.

    Unless it ``keeps`` tables itself, the worker lets go of those of the operator before.
    """
    prepare(df.sparkSession)
    names = [part.split()[0] for part in schema.split(", ")] if isinstance(schema, str) else schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not keeps:
            kept(None, lambda: None)
        for batch in batches:
            for part in slices(batch):
                if (out := work(part)) is not None:
                    yield pa.RecordBatch.from_arrays([out[n] for n in names], names=names)
            pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def with_row(rows: DataFrame, added: str) -> T.StructType:
    """The schema of the rows' ``_row``, which holds the caller's columns whatever their names, and further columns."""
    return T.StructType([rows.schema["_row"], *T.StructType.fromDDL(added).fields])


def row_of(columns: list[str]) -> Column:
    """The caller's columns as ``_row``."""
    # A struct needs a field; the placeholder stands alone, so that it clashes with no name.
    return F.struct(*[F.col(f"`{c}`") for c in columns] or [F.lit(0).alias("_none")]).alias("_row")


def columns_of(columns: list[str]) -> list[Column]:
    """The caller's columns out of ``_row``."""
    return [F.col("_row").getField(c).alias(c) for c in columns]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of unsigned 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_chunks(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of rows of about CHUNK_BYTES: first row, row after the last, their bytes, and where each text begins and ends.

    A null counts as empty. A longer text is a chunk of its own.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def words_of(data: np.ndarray, bounds: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of a chunk: the 64-bit hash of each word, where it begins, and the first word of each text (with the end).

    ``lower`` folds A to Z. Words are runs of bytes other than SPACES and never reach over the end of a text.
    """
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = _IS_WORD[data]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    opens[edges] = inside[edges]
    starts = np.flatnonzero(opens)
    first_words = np.searchsorted(starts, bounds)
    if len(starts) == 0:
        return np.empty(0, np.uint64), starts, first_words
    letters = data[inside[:-1]]
    if lower:
        letters = _LOWER[letters]
    in_letters = np.cumsum(inside[:-1])[starts] - 1
    lengths = np.diff(np.append(in_letters, len(letters)))
    powers = np.full(int(lengths.max()), _BASE)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    place = np.arange(len(letters)) - np.repeat(in_letters, lengths)
    sums = np.add.reduceat(_BYTE_KEYS[letters] * powers[place], in_letters)
    return mix(sums ^ (lengths.astype(np.uint64) * _BASE)), starts, first_words


def shingles_of(words: np.ndarray, size: int) -> np.ndarray:
    """The distinct hashes of all runs of ``size`` words, in order; a shorter text is one shingle as a whole."""
    if len(words) == 0:
        return np.empty(0, np.uint64)
    span = min(size, len(words))
    keys = np.cumprod(np.full(span, _BASE | np.uint64(1)), dtype=np.uint64)
    runs = np.lib.stride_tricks.sliding_window_view(words, span) if len(words) > span else words[None, :]
    total = np.zeros(len(runs), np.uint64)
    for i in range(span):
        total += mix(runs[:, i] + np.uint64(i + 1)) * keys[i]
    return np.unique(mix(total + np.uint64(span)))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
