"""Periodic runs of words, found by seeds on diagonals.

A run is a stretch of consecutive words of one text with smallest period q and at least max(LEAST, 2 q) words that no
neighbouring word extends. On the diagonal of lag q (each word against the one q further on) it is an unbroken line of at
least max(LEAST - q, q) equal places, so a gram as long as the least of these guaranteed overlaps starts on every line.

Index: the places of every gram that occurs again in its text. Pairs: places of one gram whose lag lies in the class at
hand, [c, 2 c). A line of a higher class has at least c places, so its grams are c / 2 words long and one place in c / 2 is
enough as the left end of a pair: every line holds one of these, and a class enumerates no more pairs than about four times
the words, whatever repeats. Extension: pairs go by lag and place; the furthest place that the seeds of a
lag have covered suppresses those that follow on the same line, the first one of a line is extended both ways to its
ends. A seed within a run already known, at a multiple of its period, can only find that run again and is left out: so a
text of one word repeated is one line, not one for each lag.

Grams and extensions compare hashes of word ranges; equal words always agree, and every line long enough for a run is
compared word by word before it counts, so a collision costs time only.

Memory and time are linear in a text (but for a logarithm); a text is held by one task, short texts are taken
together in slices.

Defined cases: null, empty and blank texts have no words and no runs; repeated rows and extra columns are kept as they
are, the result is one more column (a column of its name is replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist.llm.common import mix, powers, runs_to_mask, slices, texts_of

LEAST = 12
#: Pairs taken at a time.
PAIRS = 1 << 20

RESULT = "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,collapsed:string>"


class Tape:
    """The words of several texts in a row: numbers (equal words, equal numbers), the text of each, its bounds."""

    def __init__(self, texts: list[list[bytes]]):
        numbers: dict[bytes, int] = {}
        self.counts = np.array([len(t) for t in texts], np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.counts)])
        n = int(self.bounds[-1])
        self.ids = np.fromiter(map(numbers.setdefault, (w for t in texts for w in t), count()), np.int64, n)
        self.owner = np.repeat(np.arange(len(texts)), self.counts)
        self.up, self.down = powers(0).upto(n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(mix(self.ids.astype(np.uint64) + np.uint64(1)) * self.up[:n], out=self.sums[1:])

    def hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * self.down[start]

    def low(self, at: np.ndarray) -> np.ndarray:
        return self.bounds[self.owner[at]]

    def high(self, at: np.ndarray) -> np.ndarray:
        return self.bounds[self.owner[at] + 1]


class Index:
    """Places of the grams of `size` words that occur again in their text, by gram, then place."""

    def __init__(self, tape: Tape, places: np.ndarray, size: int):
        places = places[places + size <= tape.high(places)]
        key = mix(tape.hash(places, places + size)) + tape.owner[places].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        order = np.argsort(key, kind="stable")
        key, places = key[order], places[order]
        first = np.ones(len(key), bool)
        first[1:] = key[1:] != key[:-1]
        last = np.append(first[1:], True) if len(first) else first
        again = ~(first & last)
        self.size, self.places = size, places[again]
        self.width = len(tape.ids) + 1
        self.group = np.cumsum(first)[again]
        self.order = self.group * self.width + self.places

    def grown(self, tape: Tape) -> Index:
        """The index of grams of twice the size: both halves of such a gram occur again."""
        places = np.sort(self.places)
        at = np.searchsorted(places, places + self.size)
        whole = places[np.minimum(at, len(places) - 1)] == places + self.size if len(places) else np.zeros(0, bool)
        return Index(tape, places[whole], 2 * self.size)

    def pairs(self, low: int, high: int, step: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(place, lag) of two places of a gram with a lag in [low, high), the left one a multiple of `step`."""
        left = np.flatnonzero(self.places % step == 0)
        begin = np.searchsorted(self.order, self.order[left] + low)
        end = np.searchsorted(self.order, np.minimum(self.order[left] + high, (self.group[left] + 1) * self.width))
        sizes = np.maximum(end - begin, 0)
        total = np.cumsum(sizes)
        start = 0
        while start < len(left):
            before = total[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(total, before + PAIRS, side="right")))
            some = sizes[start:stop]
            offset = np.arange(some.sum()) - np.repeat(np.cumsum(some) - some, some)
            right = self.places[np.repeat(begin[start:stop], some) + offset]
            place = np.repeat(self.places[left[start:stop]], some)
            yield place, right - place
            start = stop


class Known:
    """The runs found so far, looked up by the stretch they cover."""

    def __init__(self):
        self.runs = np.zeros((0, 3), np.int64)
        self._sort()

    def _sort(self) -> None:
        self.runs = self.runs[np.argsort(self.runs[:, 0], kind="stable")]
        self.reach = np.maximum.accumulate(self.runs[:, 1])
        self.by = np.maximum.accumulate(np.where(self.runs[:, 1] == self.reach, np.arange(len(self.runs)), 0))

    def add(self, runs: np.ndarray) -> None:
        self.runs = np.concatenate([self.runs, runs])
        self._sort()

    def period(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """The period of the run over [start, end), 0 if there is none.

        For stretches of at least q words and runs of periods up to q / 2 there is at most one: two runs
        share fewer words than both periods together.
        """
        if not len(self.runs):
            return np.zeros(len(start), np.int64)
        at = np.searchsorted(self.runs[:, 0], start, side="right") - 1
        over = (at >= 0) & (self.reach[at] >= end)
        return np.where(over, self.runs[self.by[at], 2], 0)


def _longest(most: np.ndarray, same) -> np.ndarray:
    """The greatest length up to `most` for which `same` holds, by halving."""
    low, high = np.zeros_like(most), most.copy()
    while (low < high).any():
        middle = (low + high + 1) >> 1
        equal = same(middle)
        low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
    return low


def _compared(ids: np.ndarray, start: int, stop: int, lag: int, low: int, high: int) -> list[tuple[int, int]]:
    """The stretches of words equal to those `lag` further on that meet [start, stop): that one itself, unless a hash collided.

    After a collision the whole text, [low, high), is compared at this lag.
    """
    if (ids[start:stop] == ids[start + lag:stop + lag]).all():
        return [(start, stop)]
    equal = ids[low:high - lag] == ids[low + lag:high]
    edges = (np.flatnonzero(np.diff(np.concatenate([[0], equal.astype(np.int8), [0]]))) + low).tolist()
    return [(a, b) for a, b in zip(edges[::2], edges[1::2]) if a < stop and b > start]


def _lines(tape: Tape, place: np.ndarray, lag: np.ndarray, size: int, least: int) -> np.ndarray:
    """(start, end, period) of the lines through these seeds that are long enough for a run."""
    order = np.lexsort((place, lag))
    place, lag = place[order], lag[order]
    # What the seeds of a lag have covered: the next seed within reach, in the same text, is on the same line.
    fresh = np.ones(len(place), bool)
    fresh[1:] = (lag[1:] != lag[:-1]) | (place[1:] > place[:-1] + size) | (tape.owner[place[1:]] != tape.owner[place[:-1]])
    covered = place[np.append(fresh[1:], True)] + size if len(place) else place
    place, lag = place[fresh], lag[fresh]
    other, beyond = place + lag, covered + lag
    low, high = tape.low(place), tape.high(place)
    back = _longest(place - low, lambda k: tape.hash(place - k, place) == tape.hash(other - k, other))
    on = _longest(high - beyond, lambda k: tape.hash(covered, covered + k) == tape.hash(beyond, beyond + k))
    start, end = place - back, covered + on
    enough = end - start >= np.maximum(least - lag, lag)
    found = {(a, b, q) for s, e, q, x, y in np.stack([start, end, lag, low, high], 1)[enough].tolist()
             for a, b in _compared(tape.ids, s, e, q, x, y) if b - a >= max(least - q, q)}
    return np.array([(a, b + q, q) for a, b, q in sorted(found)], np.int64).reshape(-1, 3)


def classes(least: int, longest: int) -> Iterator[tuple[int, int, int]]:
    """(low, high, step) of the lags that texts of `longest` words can have; grams have max(step, least / 2) words."""
    base, low = (least + 1) // 2, 1
    while 2 * low <= longest:
        high = min(2 * low, 2 * base) if low < 2 * base else 2 * low
        yield low, high, 1 if low < 2 * base else low // 2
        low = high


def find_runs(texts: list[list[bytes]], least: int = LEAST) -> tuple[Tape, np.ndarray]:
    """The words, and (start, end, period) of all runs by start and period; places count over all texts."""
    tape, known = Tape(texts), Known()
    index = Index(tape, np.arange(len(tape.ids)), (least + 1) // 2)
    for low, high, step in classes(least, int(tape.counts.max(initial=0))):
        while index.size < step:
            index = index.grown(tape)
        if not len(index.places):
            break
        found = [np.zeros((0, 3), np.int64)]
        for place, lag in index.pairs(low, high, step):
            period = known.period(place, place + lag + index.size)
            new = (period == 0) | (lag % np.maximum(period, 1) != 0)
            found.append(_lines(tape, place[new], lag[new], index.size, least))
        runs = np.unique(np.concatenate(found), axis=0)
        known.add(runs[known.period(runs[:, 0], runs[:, 1]) == 0])
    return tape, known.runs[np.lexsort((known.runs[:, 2], known.runs[:, 0]))]


def _found(texts: list[bytes], least: int) -> pa.Array:
    words = [t.split() for t in texts]
    tape, runs = find_runs(words, least)
    gone = runs_to_mask(len(tape.ids), runs[:, 0] + runs[:, 2], runs[:, 1])
    kept = []
    for k, (a, b) in enumerate(zip(tape.bounds[:-1].tolist(), tape.bounds[1:].tolist())):
        lost = gone[a:b]
        kept.append(b" ".join([words[k][i] for i in np.flatnonzero(~lost).tolist()] if lost.any() else words[k]))
    owner = tape.owner[runs[:, 0]]
    rows = [runs[:, 0] - tape.bounds[owner], runs[:, 1] - runs[:, 0], runs[:, 2]]
    offsets = np.searchsorted(owner, np.arange(len(texts) + 1)).astype(np.int32)
    listed = pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays([pa.array(x) for x in rows], ["start", "length", "period"]))
    return pa.StructArray.from_arrays([pa.array(tape.counts), listed, pa.array(kept, pa.binary()).cast(pa.string())], ["n_words", "runs", "collapsed"])


def with_runs(docs: DataFrame, text: str = "text", column: str = "periodic", least: int = LEAST) -> DataFrame:
    """`docs` with the runs of each text.

    The column holds n_words; runs by start, then period, each with start (number of its first word), length and
    period; collapsed, the text without the words that a run holds behind its first period, joined by one space.
    """
    def read(texts: pa.Array) -> pa.Array:
        parts = [_found(texts_of(texts, a, b), least) for a, b in slices(texts)]
        return pa.concat_arrays(parts) if parts else _found([], least)

    return docs.withColumn(column, F.arrow_udf(read, RESULT).asNondeterministic()(F.col(text).cast("string")))
