"""SimHash near-duplicates through a byte-position inverted index with count filtering.

Words are the runs between the bytes 0x20, 0x09-0x0D after lower-casing A-Z; the hashes (XXH64, seed 42)
of all SHINGLE-word shingles vote on each of 64 bits, and a bit is 1 if set in over half of them.
Fingerprints link at MAX_BITS or fewer differing bits.

The index lists fingerprints under the bytes at their eight positions. Two that differ in at most four
bits agree in at least 8 - 4 = 4 positional bytes, so postings are keyed by four positions and their
bytes (70 keys for a fingerprint): a pair below the guaranteed number of matches never meets. What meets
is tallied (number of equal positional bytes), kept from four on, and verified by its bit distance.

Only distinct fingerprints are indexed, so copies cost nothing. A posting list of up to LIST_LIMIT
members is compared inside one row of the bucket table, which gives back one link for each member to the
smallest member it reaches there and never the pairs. Members of longer lists are linked exactly without
comparing pairs: any two within four bits share a value that is at most two bits from each, so each
fingerprint is listed under the 2081 values of that kind and all under one value are linked to its
smallest (such a list has at most 2081 members, by construction).

Defined cases: null, empty and white-space texts have no words and fingerprint zero, linked like any
other; fewer than SHINGLE words are one shingle. Rows that repeat a doc_id are each reported; the
component holds the smallest doc_id. A null doc_id is reported and never names a component that has ids.
Extra columns are ignored by `near_groups` and returned unchanged by `drop_near_copies`.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relist.llm.common import one_row_each, pieces, texts_of
from relist.llm.components import smallest_reachable
from relist.session import materialize

SHINGLE, MAX_BITS = 4, 4
LIST_LIMIT = 1024

_ONES = np.uint64(0x0101010101010101)


def _votes(digests: bytes) -> np.ndarray:
    """How many of the 8-byte digests have each bit set, as (byte, bit) counts."""
    words = np.frombuffer(digests, np.uint64)
    cuts = np.arange(0, len(words), 255)
    lanes = [np.add.reduceat((words >> np.uint64(j)) & _ONES, cuts).view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64) for j in range(8)]
    return np.stack(lanes, axis=1)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> bytes:
    """The 64-bit fingerprint of one text, highest byte first."""
    digest, votes, n, tail = xxhash.xxh64_digest, np.zeros((8, 8), np.int64), 0, []
    for piece in pieces(text):
        words = tail + piece.lower().split()
        if len(words) >= shingle:
            joined = b" ".join(words)
            gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
            starts = [0, *(gaps + 1).tolist()][:len(words) - shingle + 1]
            ends = [*gaps.tolist(), len(joined)][shingle - 1:]
            votes += _votes(b"".join([digest(joined[a:b], 42) for a, b in zip(starts, ends)]))
            n += len(starts)
        tail = words[len(words) - min(len(words), shingle - 1):]
    if not n and tail:
        votes, n = _votes(digest(b" ".join(tail), 42)), 1
    return ((2 * votes > n) << np.arange(8)).sum(axis=1).astype(np.uint8).tobytes()


def _fingerprints(texts: pa.Array) -> pa.Array:
    out = [fingerprint(texts_of(texts, k, k + 1)[0]) for k in range(len(texts))]
    return pa.array(np.frombuffer(b"".join(out), ">i8").astype(np.int64))


def with_fingerprint(docs: DataFrame, text: str = "text", column: str = "fingerprint") -> DataFrame:
    """`docs` with the fingerprint of each text as a signed 64-bit number."""
    return docs.withColumn(column, F.arrow_udf(_fingerprints, "bigint").asNondeterministic()(F.col(text).cast("string")))


_SUBSETS = list(combinations(range(8), 8 - MAX_BITS))
_MASKS = [sum(0xFF << (8 * p) for p in s) for s in _SUBSETS]
_SIGNED = [m - (1 << 64) if m >> 63 else m for m in _MASKS]
_NEAR = np.array([0, *(1 << i for i in range(64)), *((1 << i) | (1 << j) for i, j in combinations(range(64), 2))], np.uint64)


def _star(members: np.ndarray) -> list[tuple[int, int]]:
    """Links from each member to the smallest member it reaches within the list."""
    members = np.unique(members)
    rest, out = np.arange(len(members)), []
    bits = members.view(np.uint64)
    while len(rest):
        reached = frontier = rest[:1]
        rest = rest[1:]
        while len(frontier) and len(rest):
            apart = bits[frontier][:, None] ^ bits[rest][None, :]
            equal_bytes = (apart.view(np.uint8).reshape(len(frontier), len(rest), 8) == 0).sum(axis=2)
            near = ((equal_bytes >= 8 - MAX_BITS) & (np.bitwise_count(apart) <= MAX_BITS)).any(axis=0)
            frontier, rest = rest[near], rest[~near]
            reached = np.concatenate([reached, frontier])
        out += [(int(members[k]), int(members[reached[0]])) for k in reached[1:]]
    return out


_LINKS = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))


def _list_links(lists: pa.Array) -> pa.Array:
    return pa.array([[{"a": a, "b": b} for a, b in _star(np.array(x, np.int64))] for x in lists.to_pylist()], _LINKS)


def _near_values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = batch.column(0).to_numpy(zero_copy_only=False)
        for k in range(0, len(own), 64):
            part = own[k:k + 64]
            near = (part.view(np.uint64)[:, None] ^ _NEAR[None, :]).ravel().view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(near), pa.array(np.repeat(part, len(_NEAR)))], ["near", "fp"])


def _crowded_links(fps: DataFrame) -> DataFrame:
    """Links among fingerprints of overfull lists, through the values within two bits of both."""
    around = fps.mapInArrow(_near_values, "near bigint, fp bigint")
    lists = around.groupBy("near").agg(F.min("fp").alias("low"), F.collect_set("fp").alias("fps")).where(F.size("fps") > 1)
    return lists.select(F.explode("fps").alias("a"), F.col("low").alias("b")).where("a <> b")


def near_links(fps: DataFrame, limit: int = LIST_LIMIT) -> DataFrame:
    """Distinct fingerprints (column fp) -> links (a, b) that connect all within MAX_BITS of each other."""
    keys = F.array(*[F.xxhash64(F.lit(k), F.col("fp").bitwiseAND(F.lit(m))) for k, m in enumerate(_SIGNED)])
    postings = fps.select("fp", F.explode(keys).alias("key"))
    shared = postings.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    # Spark sizes the postings by the file of fingerprints, as if a row had one key: below its limit it would broadcast all 70 of each.
    listed = materialize(postings.hint("merge").join(shared, "key"), "postings")
    short = listed.where(F.col("members") <= limit).groupBy("key").agg(F.collect_list("fp").alias("fps"))
    linked = short.select(F.explode(F.arrow_udf(_list_links, "array<struct<a:bigint,b:bigint>>").asNondeterministic()("fps")).alias("l")).select("l.a", "l.b")
    crowded = listed.where(F.col("members") > limit).select("fp").distinct()
    return linked.union(_crowded_links(crowded)).distinct()


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", limit: int = LIST_LIMIT) -> DataFrame:
    """One row per document: doc_id, text_key, fingerprint (16 hex digits), component_id, root (the component's own key)."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = materialize(with_fingerprint(source, "text", "fp").select("doc_id", F.xxhash64("text").alias("text_key"), "fp"), "fingerprints")
    fps = materialize(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = smallest_reachable(near_links(fps, limit))
    rooted = fps.join(roots, fps["fp"] == roots["node"], "left").select("fp", "first_id", F.coalesce("root", "fp").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = rooted.join(smallest, "root").select("fp", "component_id", "root")
    return rows.join(named, "fp").select(
        "doc_id", "text_key", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "root")


def drop_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `docs` for each group of near copies, that with the smallest doc_id, with all its columns.

    Of several rows with this doc_id the one with the smallest text key stays; of rows that repeat id and text, or
    of a group whose rows all have no id, any one.
    """
    grouped = materialize(near_groups(docs, doc_id, text), "near-groups")
    first = grouped.where("doc_id <=> component_id").groupBy("root", "doc_id").agg(F.min("text_key").alias("text_key"), F.count(F.lit(1)).alias("rows"))
    several = materialize(first.where("rows > 1").select("root", F.col("text_key").alias("first_key")), "repeated-ids")
    lost = ~F.col("doc_id").eqNullSafe(F.col("component_id"))
    marked = grouped.join(several, "root", "left")
    gone = marked.where(lost | (F.col("text_key") != F.col("first_key"))).select("doc_id", "text_key").distinct()

    def same(rows: DataFrame, keys: DataFrame) -> Column:
        return rows[doc_id].eqNullSafe(keys["doc_id"]) & F.xxhash64(rows[text].cast("string")).eqNullSafe(keys["text_key"])

    stays = docs.join(gone, same(docs, gone), "left_anti")
    if several.isEmpty():
        return stays
    times = marked.where(~lost & F.col("text_key").eqNullSafe(F.col("first_key"))).select("doc_id", "text_key").distinct()
    return one_row_each(stays, [stays[doc_id], F.xxhash64(stays[text].cast("string"))], times, same)
