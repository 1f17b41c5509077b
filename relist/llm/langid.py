"""Language identification by nearest centroid with distance-based rejection.

A text is a vector of byte trigrams (lower-cased, everything but letters beyond ASCII and a-z made one
space, hashed to BINS), weighted by log(1 + count) * idf and scaled to length one. Document
frequencies are counted over all training rows. Per language, spherical k-means on a bounded sample of its rows
gives up to CENTROIDS centroids. A text gets the language of the centroid of the largest cosine; it is
rejected if it is farther from that centroid than the sample's rows are (their RADIUS quantile and a
margin). Sampling and k-means run per language in Spark; the driver holds one row per bin and centroid.

The bound of the sample is a parameter (`per_language`): it is drawn by a hash from the different texts of a language, one row each.

Defined cases: a null text or one without a letter is `und` with score 0. Equal cosines go to the language with
more training rows, then by name. Without any training row every text is `und`. Repeated rows each
count and each get a result. Extra columns are returned unchanged, except that a column named like the result is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relist.llm.common import pieces, slices, texts_of

BINS, CENTROIDS, PER_LANGUAGE = 4096, 3, 600
RADIUS, MARGIN, STEPS = 0.995, 0.05, 12
UNKNOWN = "und"

_KEPT = np.array([b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256)], np.uint8)


def _counts(text: bytes) -> np.ndarray:
    """Trigram counts of a lower-cased text."""
    out = np.zeros(BINS, np.int64)
    for part in pieces(text):
        buf = _KEPT[np.frombuffer(b" " + part + b" ", np.uint8)]
        gap = buf == 32
        buf = buf[np.concatenate([[True], ~(gap[1:] & gap[:-1])])].astype(np.uint32)
        if len(buf) >= 3:
            grams = buf[:-2] * np.uint32(0x9E3779B1) + buf[1:-1] * np.uint32(0x85EBCA77) + buf[2:] * np.uint32(0xC2B2AE3D)
            out += np.bincount((grams ^ (grams >> np.uint32(15))) % np.uint32(BINS), minlength=BINS)
    return out


def _counted(texts: pa.Array) -> Iterator[np.ndarray]:
    """Counts of runs of rows, as matrices."""
    lowered = pc.utf8_lower(texts)
    for start, end in slices(lowered, rows=256):
        yield np.stack([_counts(t) for t in texts_of(lowered, start, end)])


def _vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    out = (np.log1p(counts) * idf).astype(np.float32)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> (bin, documents that have it); bin -1 counts all documents."""
    total = np.zeros(BINS + 1, np.int64)
    for batch in batches:
        for counts in _counted(batch.column(0)):
            total[1:] += (counts > 0).sum(axis=0)
            total[0] += len(counts)
    yield pa.RecordBatch.from_arrays([pa.array(np.arange(-1, BINS)), pa.array(total)], ["bin", "n"])


def cluster(vectors: np.ndarray, k: int = CENTROIDS, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
    """Spherical k-means from far-apart seeds: unit centroids, and the cosine each keeps its rows within."""
    def unit(x):
        return x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)

    centres = unit(vectors.mean(axis=0, keepdims=True))
    while len(centres) < min(k, len(vectors)):
        centres = np.concatenate([centres, vectors[[int((vectors @ centres.T).max(axis=1).argmin())]]])
    for _ in range(steps):
        own = (vectors @ centres.T).argmax(axis=1)
        centres = np.stack([unit(vectors[own == c].mean(axis=0)) if (own == c).any() else centres[c] for c in range(len(centres))])
    near = vectors @ centres.T
    own = near.argmax(axis=1)
    floors = [np.quantile(near[own == c, c], 1 - RADIUS) - MARGIN if (own == c).any() else 1.0 for c in range(len(centres))]
    return centres, np.array(floors)


class Model:
    def __init__(self, languages: list[str], centres: np.ndarray, floors: np.ndarray, idf: np.ndarray):
        self.languages, self.centres, self.floors, self.idf = languages, centres, floors, idf


def train(docs: DataFrame, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE, centroids: int = CENTROIDS) -> Model:
    """Learn from all rows of `docs` with a text and a language; call with the rows that may be learnt from."""
    rows = docs.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang")).where("text IS NOT NULL AND lang IS NOT NULL")
    rows = rows.withColumn("h", F.xxhash64("text"))
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count_distinct("h").alias("n")).collect()}
    if not sizes:
        return Model([], np.zeros((0, BINS)), np.zeros(0), np.ones(BINS))
    found = dict(rows.select("text").mapInArrow(_frequencies, "bin bigint, n bigint").groupBy("bin").agg(F.sum("n")).collect())
    idf = np.log((1 + found[-1]) / (1 + np.array([found[b] for b in range(BINS)]))) + 1

    def vectors(texts: pa.Array) -> pa.Array:
        return pa.array([v.tobytes() for counts in _counted(texts) for v in _vectors(counts, idf)], pa.binary())

    def centres(key: tuple, part: pa.Table) -> pa.Table:
        x = np.frombuffer(b"".join(part.column("v").to_pylist()), np.float32).reshape(-1, BINS)
        x = x[np.lexsort(x.T[:8])]
        made, floors = cluster(x, centroids)
        return pa.table({"lang": [key[0].as_py()] * len(made), "centre": [c.astype(np.float32).tobytes() for c in made], "floor": floors.astype(float)})

    share = F.element_at(F.create_map(*[F.lit(x) for s in sizes for x in (s, min(1.0, per_language / sizes[s]))]), F.col("lang"))
    # Drawn from the different texts of a language, one row each, so that copies neither use up the draw nor swell it.
    sample = rows.where(F.pmod("h", F.lit(1 << 20)) < share * (1 << 20)).groupBy("lang", "h").agg(F.min("text").alias("text"))
    sample = sample.select("lang", F.arrow_udf(vectors, "binary").asNondeterministic()("text").alias("v"))
    made = sample.groupBy("lang").applyInArrow(centres, "lang string, centre binary, floor double").collect()
    made = sorted(made, key=lambda r: (-sizes[r["lang"]], r["lang"]))
    stacked = np.stack([np.frombuffer(r["centre"], np.float32) for r in made]) if made else np.zeros((0, BINS))
    return Model([r["lang"] for r in made], stacked, np.array([r["floor"] for r in made]), idf)


_RESULT = pa.struct([("lang", pa.string()), ("nearest", pa.string()), ("score", pa.float64()), ("rejected", pa.bool_())])


def with_language(docs: DataFrame, model: Model, text: str = "text", column: str = "language") -> DataFrame:
    """`docs` with (lang, nearest, score, rejected): lang is the nearest language, or `und` where rejected."""
    def predict(texts: pa.Array) -> pa.Array:
        letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_pylist()
        out, k = [], 0
        for counts in _counted(texts):
            if not model.languages:
                letters[k:k + len(counts)] = [False] * len(counts)
            near = _vectors(counts, model.idf) @ model.centres.T if model.languages else np.zeros((len(counts), 1))
            best = near.argmax(axis=1)
            for row, b in enumerate(best.tolist()):
                if letters[k]:
                    cosine = float(np.clip(near[row, b], 0, 1))
                    rejected = bool(cosine < model.floors[b])
                    out.append({"lang": UNKNOWN if rejected else model.languages[b], "nearest": model.languages[b], "score": cosine, "rejected": rejected})
                else:
                    out.append({"lang": UNKNOWN, "nearest": UNKNOWN, "score": 0.0, "rejected": True})
                k += 1
        return pa.array(out, _RESULT)

    returns = "struct<lang:string,nearest:string,score:double,rejected:boolean>"
    return docs.withColumn(column, F.arrow_udf(predict, returns).asNondeterministic()(F.col(text).cast("string")))
