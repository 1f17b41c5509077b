"""Substring dedup by seed and extend on winnowed anchors.

Words are the runs between the bytes 0x20, 0x09-0x0D, unchanged. A window is WINDOW consecutive words of one
document; every word covered by a window whose word sequence also starts anywhere else is removed.

Seed: of every window the rightmost smallest hash of its GRAM-word grams is its anchor, so equal windows have equal anchors
at equal offsets. Extend: all windows that an anchor can belong to lie within its surroundings, the
WINDOW - GRAM words on both sides. Anchors are joined on their gram and their whole surroundings first: where
these occur twice, every window around both anchors is a repeat, and no window is listed. Only if one
gram has several different surroundings, one anchor for each of them lists the windows it is the anchor of;
their hashes are counted, and windows that occur under several surroundings are repeats as well.
Overlapping repeats are united to maximal runs.

Nothing is paired: a passage shared by a third of all documents is a count per map task, then one row.
Equality is by 128 bits: hashes of the gram and the surroundings, or two hashes of the window. The two are made of different
halves of a BLAKE2b hash of each word, so no two words that anyone can find are taken for equal. A row is known by a 64-bit hash
of its id and text.

Memory is bounded by one text; a text is read in one numpy pass if longer than the slices.

Defined cases: null, empty and short texts have no window and keep all their words. Each input row is a document
of its own, so rows that repeat a doc_id with the same text are repeats of each other. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist.llm.common import SLICE_BYTES, Powers, gram_hashes, pieces, powers, runs_to_mask, slices, texts_of, window_minima
from relist.session import materialize

WINDOW, GRAM = 35, 12
SIDE = WINDOW - GRAM

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True


def word_keys(words: list[bytes]) -> np.ndarray:
    """Two 64-bit halves of a BLAKE2b hash of every word, a row each; each different word is hashed once."""
    numbers: dict[bytes, int] = {}
    index = np.fromiter(map(numbers.setdefault, words, count()), np.int64, len(words))
    places = np.fromiter(numbers.values(), np.int64, len(numbers))
    halves = np.frombuffer(b"".join([blake2b(w, digest_size=16).digest() for w in numbers]), np.uint64).reshape(-1, 2)
    return halves[np.searchsorted(places, index)]


class Words:
    """The words of several texts: their places, hashes (two independent ones) and texts."""

    def __init__(self, texts: list[bytes]):
        starts, ends, hashes, before = [], [], [], 0
        for part in pieces(b" ".join(texts), 4 * SLICE_BYTES):
            buf = np.frombuffer(part, np.uint8)
            inside = np.zeros(len(buf) + 2, np.int8)
            inside[1:-1] = ~_SPACES[buf]
            edges = np.flatnonzero(np.diff(inside))
            hashes.append(word_keys(part.split()))
            starts.append(edges[::2] + before)
            ends.append(edges[1::2] + before)
            before += len(part)
        self.starts, self.ends = np.concatenate(starts), np.concatenate(ends)
        self.hashes, self.other = (np.ascontiguousarray(h) for h in np.concatenate(hashes).T)
        offsets = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.owner = np.searchsorted(offsets, self.starts, side="right") - 1
        self.counts = np.bincount(self.owner, minlength=len(texts))
        self.first = np.concatenate([[0], np.cumsum(self.counts)])


class Anchors:
    """Windows of the words, their anchors, and the surroundings of those."""

    def __init__(self, words: Words, tables: list[Powers]):
        self.words, self.tables = words, tables
        n = len(words.hashes)
        at = np.arange(max(0, n - GRAM + 1))
        self.grams = gram_hashes(words.hashes, at, at + GRAM, tables[1])
        begin = np.arange(max(0, n - WINDOW + 1))
        anchor = window_minima(self.grams, SIDE + 1)
        whole = words.owner[begin] == words.owner[begin + WINDOW - 1]
        #: Starts of the windows within one text, and the anchor of each (not falling).
        self.begin, self.anchor = begin[whole], anchor[whole]
        self.at = np.unique(self.anchor)

    def surroundings(self) -> np.ndarray:
        """A hash of the words around each anchor, cut off at the ends of its text, and of where they are cut off."""
        w = self.words
        low, high = w.first[w.owner[self.at]], w.first[w.owner[self.at] + 1]
        start, end = np.maximum(self.at - SIDE, low), np.minimum(self.at + GRAM + SIDE, high)
        cut = (self.at - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return gram_hashes(w.other, start, end, self.tables[2]) ^ cut

    def listed(self, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The windows of these anchors: starts and two hashes."""
        chosen = np.isin(self.anchor, anchors)
        begin = self.begin[chosen]
        pairs = zip((self.words.hashes, self.words.other), self.tables[1:])
        return begin, *(gram_hashes(h, begin, begin + WINDOW, t) for h, t in pairs)


def _tables() -> list[Powers]:
    return [powers(0), powers(1), powers(2)]


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text) -> (gram, around, row, pos)."""
    tables = _tables()
    for batch in batches:
        rows = batch.column(0).to_numpy()
        for start, end in slices(batch.column(1)):
            words = Words(texts_of(batch.column(1), start, end))
            a = Anchors(words, tables)
            owner = words.owner[a.at]
            yield pa.RecordBatch.from_arrays(
                [_signed(a.grams[a.at]), _signed(a.surroundings()), pa.array(rows[start + owner]), pa.array((a.at - words.first[owner]).astype(np.int32))],
                ["gram", "around", "row", "pos"])


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, text, positions of anchors) -> (h1, h2, row, pos) of the windows of these anchors."""
    tables = _tables()
    for batch in batches:
        rows = batch.column(0).to_numpy()
        for start, end in slices(batch.column(1)):
            words = Words(texts_of(batch.column(1), start, end))
            wanted = batch.column(2).slice(start, end - start)
            sizes = np.diff(wanted.offsets.to_numpy())
            flat = wanted.flatten().to_numpy(zero_copy_only=False)
            begin, h1, h2 = Anchors(words, tables).listed(flat + np.repeat(words.first[:-1], sizes))
            owner = words.owner[begin]
            yield pa.RecordBatch.from_arrays(
                [_signed(h1), _signed(h2), pa.array(rows[start + owner]), pa.array((begin - words.first[owner]).astype(np.int32))], ["h1", "h2", "row", "pos"])


def _kept_parts(text: bytes, spans: list[tuple[int, int]]) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    words = Words([text])
    n = len(words.hashes)
    edges = np.array(spans, np.int64).reshape(-1, 2).clip(0, n)
    return n, words.starts, words.ends, runs_to_mask(n, edges[:, 0], edges[:, 1])


def _finished(texts: pa.Array, spans: pa.Array) -> pa.Array:
    """(text, spans) -> (number of words, removed, kept text)."""
    out = []
    for k, found in enumerate(spans.to_pylist()):
        text = texts_of(texts, k, k + 1)[0]
        if found:
            n, starts, ends, gone = _kept_parts(text, [(s["start"], s["end"]) for s in found])
            removed, kept = int(gone.sum()), b" ".join([text[a:b] for a, b in zip(starts[~gone].tolist(), ends[~gone].tolist())])
        else:
            words = text.split()
            n, removed, kept = len(words), 0, b" ".join(words)
        out.append({"n_words": n, "n_removed": removed, "kept": kept.decode()})
    return pa.array(out, pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())]))


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(row, text) -> (row, spans): the runs of words (start, end) that repeats cover; they may overlap."""
    anchors = materialize(rows.mapInArrow(_anchor_rows, "gram bigint, around bigint, row bigint, pos int"), "anchors")
    kinds = anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("times"), F.min("around").alias("low"), F.max("around").alias("high"))
    # Written out, so that the join has a plain exchange on both sides and a hot gram is split.
    shared = materialize(kinds.where("times > 1").select("gram", (F.col("low") != F.col("high")).alias("mixed")), "shared-grams")
    seeds = materialize(anchors.join(shared, "gram"), "seeds")
    mixed = seeds.where("mixed").groupBy("gram", "around").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("row", "pos")).alias("one"))
    mixed = materialize(mixed, "mixed-seeds")
    again = mixed.where("times > 1").select("gram", "around")
    covered = seeds.where("not mixed").select("row", "pos").union(seeds.where("mixed").join(again, ["gram", "around"], "left_semi").select("row", "pos"))
    covered = covered.select("row", F.greatest(F.col("pos") - SIDE, F.lit(0)).alias("start"), (F.col("pos") + GRAM + SIDE).alias("end"))
    wanted = mixed.select("one.row", "one.pos").groupBy("row").agg(F.collect_list("pos").alias("wanted"))
    listed = materialize(rows.join(wanted, "row").select("row", "text", "wanted").mapInArrow(_window_rows, "h1 bigint, h2 bigint, row bigint, pos int"), "windows")
    repeated = materialize(listed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("times")).where("times > 1").select("h1", "h2"), "repeated-windows")
    found = listed.join(repeated, ["h1", "h2"], "left_semi").select("row", F.col("pos").alias("start"), (F.col("pos") + WINDOW).alias("end"))
    return covered.union(found).groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))


def drop_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept (the kept words, joined by one space)."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    rows = rows.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")
    spans = repeated_spans(rows.select("row", "text"))
    done = F.arrow_udf(_finished, "struct<n_words:bigint,n_removed:bigint,kept:string>").asNondeterministic()
    return rows.join(spans, "row", "left").select("doc_id", done("text", "spans").alias("d")).select("doc_id", "d.n_words", "d.n_removed", "d.kept")
