"""Helpers shared by the training-data operators: reading, checkpoints, byte slices, hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_root, read_table

#: Words as the contracts define them: runs of anything but space, \t, \n, \v, \f, \r.
WORD_PATTERN = "[^\\x20\\x09-\\x0D]+"

#: Bytes of text that one vectorised step works on; its arrays take about 60 times that.
SLICE_BYTES = 2 << 20


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget how it was made."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def word_count(text) -> F.Column:
    """Number of words in a text column; null counts as none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def uniform(seed: int, *cols) -> F.Column:
    """A repeatable number strictly between 0 and 1 from the hash of ``cols``."""
    h = F.xxhash64(F.lit(seed), *cols)
    return (F.shiftrightunsigned(h, 12).cast("double") + 0.5) / F.lit(float(1 << 52))


def byte_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES
                ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut a batch into runs of rows of about ``limit`` bytes of text.

    Yields (first row, end row, bytes of these rows one after the other, offsets from 0).
    A single longer text is a run of its own; null texts are empty.
    """
    arr = batch.column(batch.schema.get_field_index(column))
    arr = arr.cast(pa.large_binary() if pa.types.is_binary(arr.type) else pa.large_string())
    if arr.null_count:
        arr = arr.fill_null(b"" if pa.types.is_large_binary(arr.type) else "")
    n = len(arr)
    if not n:
        return
    _, off_buf, data_buf = arr.buffers()
    offsets = np.frombuffer(off_buf, np.int64, n + 1, arr.offset * 8)
    data = np.frombuffer(data_buf, np.uint8) if data_buf is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        j = min(j, n)
        yield i, j, data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
        i = j


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over a uint64 (splitmix64's constants)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PrefixHash:
    """Prefix polynomial hashes of a symbol array, modulo 2**64.

    ``of(start, length)`` hashes any substring in constant time, so the length of the
    common extension of two positions is found by binary search over substring hashes.
    """

    BASE = 0x9E3779B97F4A7C15 | 1
    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, symbols: np.ndarray, base: int | None = None):
        base = (base or self.BASE) | 1
        n = len(symbols)
        self.power, self.inverse = self._tables(base, n + 1)
        terms = (symbols.astype(np.uint64) + np.uint64(0x1F123BB5)) * self.power[:n]
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(terms, out=self.prefix[1:])

    @classmethod
    def _tables(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        have = cls._powers.get(base)
        if have is None or len(have[0]) < n:
            size = max(n, 1 << 16)
            inv = pow(base, -1, 1 << 64)
            have = tuple(cls._geometric(b, size) for b in (base, inv))
            if size <= 2 * SLICE_BYTES:
                cls._powers[base] = have
        return have

    @staticmethod
    def _geometric(base: int, n: int) -> np.ndarray:
        out = np.ones(n, np.uint64)
        out[1:] = np.uint64(base)
        return np.cumprod(out, dtype=np.uint64)

    def of(self, start, length) -> np.ndarray:
        """Hash of symbols[start:start+length] (arrays or numbers); equal text, equal hash."""
        return (self.prefix[start + length] - self.prefix[start]) * self.inverse[start]

    def windows(self, length: int) -> np.ndarray:
        """Hash of every window of ``length`` symbols, by start."""
        n = len(self.prefix) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.prefix[length:] - self.prefix[:n]) * self.inverse[:n]
