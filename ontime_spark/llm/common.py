"""Helpers shared by the operators: reading the tables, and numpy views of Arrow text columns.

Inside Arrow tasks texts are handled as one UTF-8 byte array with document offsets, in chunks of
bounded size, so that lower-casing, word cutting and hashing are array operations without a
Python object per word."""

from __future__ import annotations

import ctypes
import inspect
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

#: Bytes of text that one array step handles at most (a single longer document is one step).
CHUNK_BYTES = 2 << 20

#: Bytes of text for which a task holds results at a time.
PART_BYTES = 8 << 20

#: White space of the contracts: [\x20\x09-\x0D].
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Lower-case A-Z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240917)
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the data folder, whole."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def mix64(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (a bijection with full avalanche)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_powers = np.ones(1, np.uint64)


def powers(n: int) -> np.ndarray:
    """1, p, p^2, ... modulo 2^64, at least ``n`` of them."""
    global _powers
    if len(_powers) < n:
        _powers = np.concatenate([np.ones(1, np.uint64),
                                  np.cumprod(np.full(max(n, 1 << 16), _BASE, np.uint64))])
    return _powers


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty. Document i is
    ``data[offsets[i]:offsets[i + 1]]``."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks)
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = column.buffers()
    offsets = np.frombuffer(off, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Memory that Arrow and the C library hold for later use goes back to the system: a worker
    outlives the stage that needed it."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim is not None:
        trim(0)


def giving_back(fn: Callable) -> Callable:
    """``fn`` of a group's table, or of a cogroup's two, which gives memory back after each group."""
    def then(*tables):
        try:
            return fn(*tables)
        finally:
            give_back()

    if len(inspect.signature(fn).parameters) == 1:
        return lambda table: then(table)
    return lambda left, right: then(left, right)


def chunks(offsets: np.ndarray, limit: int = CHUNK_BYTES, rows: int | None = None) -> Iterator[tuple[int, int]]:
    """Ranges of at most ``rows`` documents whose texts together have at most ``limit`` bytes (or
    are one)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n, n if rows is None else i + rows)
        yield i, j
        i = j


def parts(batch: pa.RecordBatch, at: int) -> Iterator[pa.RecordBatch]:
    """``batch`` in slices whose texts, or lists of numbers (column ``at``), together have at most
    ``PART_BYTES``."""
    if batch.num_rows:
        column = batch.column(at)
        if pa.types.is_list(column.type):
            sizes = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) * 8
            offsets = np.concatenate([[0], np.cumsum(sizes)])
        else:
            offsets = utf8(column)[1]
        for i, j in chunks(offsets, PART_BYTES):
            yield batch.slice(i, j - i)


def words(data: np.ndarray, offsets: np.ndarray, is_space: np.ndarray = SPACE):
    """(starts, ends, document) of every word: maximal runs of bytes that ``is_space`` does not
    hold for, cut at document bounds."""
    inside = ~is_space[data]
    if not len(inside):
        z = np.zeros(0, np.int64)
        return z, z, z
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    bounds = offsets[1:-1]
    bounds = bounds[(bounds > 0) & (bounds < len(data))]
    first[bounds] = inside[bounds]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    last[bounds - 1] = inside[bounds - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    doc = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, doc


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes (the same word has the same hash everywhere)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    lengths = ends - starts
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    total = int(lengths.sum())
    place = np.arange(total, dtype=np.int64) - np.repeat(first, lengths)
    codes = _BYTE_CODE[data[np.repeat(starts, lengths) + place]]
    return mix64(np.add.reduceat(codes * powers(int(lengths.max()))[place], first))


_SHINGLE = [np.uint64(x) for x in _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2)
            + np.uint64(1)]


def shingles(hashes: np.ndarray, doc: np.ndarray, n_docs: int, k: int):
    """Distinct k-word shingles of each document: (hashes, offsets), ordered inside a document.
    A document of fewer words has its whole sequence as one shingle, one without words none."""
    counts = np.bincount(doc, minlength=n_docs)
    first = np.concatenate([[0], np.cumsum(counts)])
    n = len(hashes)
    if n >= k:
        h = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            h += hashes[i:n - k + 1 + i] * _SHINGLE[i]
        h = mix64(h)
        same = doc[:n - k + 1] == doc[k - 1:]
        h, owner = h[same], doc[:n - k + 1][same]
    else:
        h, owner = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        extra = np.zeros(len(short), np.uint64)
        for i in range(k - 1):
            has = counts[short] > i
            extra[has] += hashes[first[short[has]] + i] * _SHINGLE[i + 1 + k]
        h, owner = np.concatenate([h, mix64(extra)]), np.concatenate([owner, short])
    order = np.lexsort((h, owner))
    h, owner = h[order], owner[order]
    if len(h):
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
        h, owner = h[new], owner[new]
    return h, np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n_docs))]).astype(np.int64)


def fresh(columns: list[str], name: str) -> str:
    """``name``, lengthened until no column has it."""
    while name.lower() in {c.lower() for c in columns}:
        name += "_"
    return name


def with_result(docs: DataFrame, text_col: str, fields: str, fn,
                name: str = "_result") -> tuple[DataFrame, str]:
    """(``docs`` plus a struct column of ``fields``, its name), computed by ``fn(texts)`` from
    the text column, a part of an Arrow batch of ``PART_BYTES`` at a time; ``fn`` returns one array
    per field. All other columns pass through as they are. The result column gets a name that no
    column has."""
    name = fresh(docs.columns, name)
    at = docs.columns.index(text_col)
    schema = StructType(list(docs.schema.fields)).add(name, StructType.fromDDL(fields))
    names = [f.name for f in schema[name].dataType.fields]

    def run(batches):
        for batch in batches:
            for part in parts(batch, at):
                struct = pa.StructArray.from_arrays(fn(part.column(at)), names)
                yield pa.RecordBatch.from_arrays([*part.columns, struct], [*part.schema.names, name])
            give_back()

    return docs.mapInArrow(run, schema), name
