"""Benchmark decontamination by winnowing: fingerprints are joined, hits extended to whole windows.

ASCII letters are lower-cased and words are runs of ASCII letters, digits and all characters beyond
ASCII. A benchmark window is WINDOW consecutive words of an item; an item of fewer words, but not none,
is one window. In every run of WINDOW words the smallest hash of its GRAM-word grams is kept (the
rightmost of equal ones), on both sides alike, so a shared window always shares a fingerprint.
Document fingerprints that occur among the benchmark's are extended to every window around them and
compared word by word. Shorter windows are their own single gram and are looked up by length.

The documents are scanned where they are: no shuffle. The fingerprints of the benchmark are sent to
the executors in blocks of at most `block` windows; a benchmark with more windows takes one scan for
each block, whose hits are added to the ones found so far.

Defined cases: null and word-less texts have no words and are clean; an item without words has no
window; an item without id marks words as hit but is not listed; items that repeat an id count once.
Repeated document rows each get the same result. Extra columns of the documents are returned
unchanged, except that a column named like the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist.llm.common import Powers, clean, gram_hashes, powers, runs_to_mask, slices, texts_of, unused, window_minima, words_of
from relist.session import materialize

WINDOW, GRAM = 10, 5
BLOCK_WINDOWS = 200_000
FOUND = "struct<n_words:bigint,n_hit:bigint,items:array<string>,spans:array<struct<start:bigint,end:bigint>>>"

def windows_of(text: bytes) -> list[tuple[bytes, int]]:
    words = clean(text).split()
    size = min(WINDOW, len(words))
    return [(b" ".join(words[p:p + size]), size) for p in range(len(words) - size + 1)] if size else []


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, texts = batch.column(0).to_pylist(), texts_of(batch.column(1), 0, len(batch))
        found = sorted({(i, *w) for i, t in zip(ids, texts) for w in windows_of(t)}, key=lambda x: (x[1], str(x[0])))
        yield pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.binary()), pa.array([f[2] for f in found], pa.int32())],
            ["item_id", "window", "size"])


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """One row per distinct window: window (its words, space-joined), size, items (ids, sorted)."""
    rows = benchmark.select(F.col(item_id).cast("string").alias("item_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _window_rows, "item_id string, window binary, size int")
    return rows.groupBy("window", "size").agg(F.array_sort(F.collect_set("item_id")).alias("items"))


class Fingerprints:
    """What a scan needs of one block of benchmark windows."""

    def __init__(self, rows: list):
        self.items = {bytes(r["window"]): r["items"] for r in rows}
        self.lookup: dict[int, np.ndarray] = {}
        sizes = np.array([r["size"] for r in rows], np.int64)
        for size in sorted(set(sizes.tolist())):
            words, whole = self._hashes([w for w, s in zip(self.items, sizes) if s == size], size)
            self.lookup[size] = np.unique(whole)
            if size == WINDOW:
                starts = np.arange(len(whole))[:, None] * size + np.arange(WINDOW - GRAM + 1)
                grams = gram_hashes(words, starts.ravel(), starts.ravel() + GRAM, powers(1))
                self.grams = np.unique(grams.reshape(starts.shape).min(axis=1))

    @staticmethod
    def _hashes(windows: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
        _, words, _ = words_of(windows, powers(0))
        starts = np.arange(len(windows)) * size
        return words, gram_hashes(words, starts, starts + size, powers(1))


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    at = np.searchsorted(known, values)
    at[at == len(known)] = 0
    return known[at] == values


def _scan(texts: list[bytes], known: Fingerprints, tables: tuple[Powers, Powers]) -> list[tuple[int, list[tuple[int, int]], set]]:
    """(number of words, occurring windows as (start, end) in words, item ids) of each text."""
    joined, words, (starts, ends, owner) = words_of([clean(t) for t in texts], tables[0])
    counts = np.bincount(owner, minlength=len(texts))
    first = np.concatenate([[0], np.cumsum(counts)])
    spans: list[list] = [[] for _ in texts]
    items: list[set] = [set() for _ in texts]
    for size, whole in known.lookup.items():
        n = len(words) - size + 1
        if n <= 0:
            continue
        if size == WINDOW:
            at = np.arange(len(words) - GRAM + 1)
            grams = gram_hashes(words, at, at + GRAM, tables[1])
            kept = np.unique(window_minima(grams, WINDOW - GRAM + 1))
            hits = kept[_among(grams[kept], known.grams)]
            begin = np.unique((hits[:, None] - np.arange(WINDOW - GRAM + 1)).ravel())
            begin = begin[(begin >= 0) & (begin < n)]
        else:
            begin = np.arange(n)
        begin = begin[owner[begin] == owner[begin + size - 1]]
        begin = begin[_among(gram_hashes(words, begin, begin + size, tables[1]), whole)]
        for p in begin.tolist():
            ids = known.items.get(b" ".join(joined[starts[p]:ends[p + size - 1]].split()))
            if ids is not None:
                k = int(owner[p])
                spans[k].append((p - int(first[k]), p - int(first[k]) + size))
                items[k].update(ids)
    return [(int(c), s, i) for c, s, i in zip(counts, spans, items)]


def _merged(n: int, spans: list[tuple[int, int]], before: dict | None, items: set) -> dict:
    spans = spans + ([(s["start"], s["end"]) for s in before["spans"]] if before else [])
    items = items | set(before["items"] if before else ())
    if not spans:
        return {"n_words": n, "n_hit": 0, "items": [], "spans": []}
    edges = np.array(spans, np.int64)
    hit = np.concatenate([[False], runs_to_mask(n, edges[:, 0], edges[:, 1]), [False]])
    cuts = np.flatnonzero(hit[1:] != hit[:-1])
    return {"n_words": n, "n_hit": int(hit.sum()), "items": sorted(i for i in items if i is not None),
            "spans": [{"start": int(a), "end": int(b)} for a, b in zip(cuts[::2], cuts[1::2])]}


_FOUND_ARROW = pa.struct([("n_words", pa.int64()), ("n_hit", pa.int64()), ("items", pa.list_(pa.string())),
                          ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))])


def _finder(sent):
    def find(texts: pa.Array, before: pa.Array) -> pa.Array:
        tables, out = (powers(0), powers(1)), []
        earlier = before.to_pylist()
        for start, end in slices(texts):
            for k, (n, spans, items) in enumerate(_scan(texts_of(texts, start, end), sent.value, tables)):
                out.append(_merged(n, spans, earlier[start + k], items))
        return pa.array(out, _FOUND_ARROW)

    return F.arrow_udf(find, FOUND).asNondeterministic()


def find_contamination(docs: DataFrame, benchmark: DataFrame, text: str = "text", column: str = "contamination",
                       item_id: str = "item_id", item_text: str = "text", block: int = BLOCK_WINDOWS) -> DataFrame:
    """`docs` with a column of (n_words, n_hit, items, spans): benchmark items found and the word runs they hit."""
    spark = docs.sparkSession
    windows = materialize(benchmark_windows(benchmark, item_id, item_text), "benchmark-windows")
    blocks = max(1, -(-windows.count() // block))
    out = docs.withColumn(column, F.lit(None).cast(FOUND))
    for k in range(blocks):
        part = windows.where(F.pmod(F.xxhash64("window"), F.lit(blocks)) == k).collect()
        sent = spark.sparkContext.broadcast(Fingerprints(part))
        out = out.withColumn(column, _finder(sent)(F.col(text).cast("string"), F.col(column)))
        if k < blocks - 1:
            out = materialize(out, "contamination")
    return out


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` that share no window with the benchmark."""
    found = unused(docs, "__contamination")
    return find_contamination(docs, benchmark, text, found).where(F.col(found)["n_hit"] == 0).drop(found)
