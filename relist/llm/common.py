"""Helpers of the text operators: tables, slices of Arrow columns, word hashes in numpy."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that one numpy pass takes at a time; a longer text makes a pass of its own.
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(docs: DataFrame, name: str) -> str:
    """`name`, or with underscores in front, so that `docs` has no such column (names are compared without case)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def one_row_each(rows: DataFrame, keys: Sequence[Column], times: DataFrame, same: Callable[[DataFrame, DataFrame], Column]) -> DataFrame:
    """`rows`, but of those that `times` (a frame of the keys that several rows share) matches, one for each key.

    A key that many rows share is reduced in each task before anything is moved; all others pass as they are.
    """
    several = rows.join(times, same(rows, times), "left_semi")
    whole = unused(rows, "__row")
    named = [k.alias(f"{whole}{i}") for i, k in enumerate(keys)]
    one = several.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias(whole), *named).groupBy(*[f"{whole}{i}" for i in range(len(keys))]).agg(
        F.any_value(whole).alias(whole))
    return rows.join(times, same(rows, times), "left_anti").unionByName(one.select(f"{whole}.*"))


def slices(texts: pa.Array, limit: int = SLICE_BYTES, rows: int = 1 << 14) -> Iterator[tuple[int, int]]:
    """Row ranges that cover `texts`, each of at most `rows` rows and `limit` bytes of text, or of one row."""
    if not len(texts):
        return
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(size):
        before = size[start - 1] if start else 0
        end = min(start + rows, max(start + 1, int(np.searchsorted(size, before + limit, side="right"))))
        yield start, end
        start = end


_SPACE = re.compile(rb"[\t-\r ]")


def pieces(text: bytes, size: int = SLICE_BYTES) -> Iterator[bytes]:
    """A long text in parts that end between words."""
    start = 0
    while len(text) - start > size:
        gap = _SPACE.search(text, start + size)
        end = gap.start() if gap else len(text)
        yield text[start:end]
        start = end
    yield text[start:] if start else text


def cut(text: bytes, start: int, size: int = SLICE_BYTES) -> int:
    """The end of a part of `text` from `start`: behind its last line within `size` bytes, or between words of a longer line."""
    if len(text) - start <= size:
        return len(text)
    if end := text.rfind(b"\n", start, start + size) + 1:
        return end
    gap = _SPACE.search(text, start + size)
    return len(text) if not gap else gap.end() if gap[0] == b"\n" else gap.start()


def texts_of(texts: pa.Array, start: int, end: int) -> list[bytes]:
    """The UTF-8 bytes of rows start to end; null counts as empty."""
    part = pc.fill_null(texts.slice(start, end - start).cast(pa.large_binary()), b"")
    return part.to_pylist()


_MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)


class Powers:
    """Powers of an odd multiplier and of its inverse modulo 2^64, grown as longer input needs them."""

    def __init__(self, which: int):
        self.base = _MULTIPLIERS[which]
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n >= len(self.up):
            size = max(2 * len(self.up), n + 1, 1 << 16)
            self.up, self.down = (self._table(b, size) for b in (self.base, self.inverse))
        return self.up, self.down

    @staticmethod
    def _table(base: int, size: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)


@cache
def powers(which: int) -> Powers:
    """The table of a multiplier, shared within a Python worker."""
    return Powers(which)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit sums, whose low bits alone are weak."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: Powers) -> np.ndarray:
    """A 64-bit hash of every byte span [starts, ends) of `buf`."""
    up, down = table.upto(len(buf))
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[:len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def gram_hashes(words: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: Powers) -> np.ndarray:
    """A 64-bit hash of every run [starts, ends) of word hashes."""
    up, down = table.upto(len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up[:len(words)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` consecutive values the position of its rightmost smallest one."""
    low, at, covered = values, np.arange(len(values)), 1
    while covered < width:
        step = min(covered, width - covered)
        left, right = low[:max(0, len(low) - step)], low[step:]
        later = right <= left
        low, at = np.where(later, right, left), np.where(later, at[step:], at[:max(0, len(at) - step)])
        covered += step
    return at


def runs_to_mask(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Which of n positions lie in any of the runs [starts, ends)."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, ends, -1)
    return np.cumsum(edge[:n]) > 0


_LETTERS = bytes((b + 32 if 65 <= b <= 90 else b) if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def clean(text: bytes) -> bytes:
    """ASCII letters lower-cased, everything between words made spaces."""
    return text.translate(_LETTERS)


def words_of(texts: list[bytes], table: Powers) -> tuple[bytes, np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The joined texts, a hash of every word, and (start, end, text number) of every word."""
    joined = b" ".join(texts)
    buf = np.frombuffer(joined, np.uint8)
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = buf != 32
    edges = np.flatnonzero(np.diff(inside))
    starts, ends = edges[::2], edges[1::2]
    offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
    return joined, word_hashes(buf, starts, ends, table), (starts, ends, np.searchsorted(offsets, starts, side="right") - 1)
