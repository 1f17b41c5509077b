"""Quality scores by Bradley-Terry ranking.

A document's strength is linear in FEATURES of its whole text. Preference pairs (a document labelled 1
over one labelled 0) are drawn from a bounded sample of the labelled rows; the weights minimise the logistic
loss of feature differences with a ridge term, by Newton steps on the few features. The acceptance
threshold is a quantile of the sample's strengths: of the grid of quantile levels the one whose split
loses least, a wrongly refused document counting as much as a wrongly accepted one after both classes
are weighted by their shares. Scores are the strengths on a logistic scale on which the threshold is CUT.

The bounds of the sample are parameters: `per_class` rows of each label, `pairs` preference pairs. Rows are
drawn by a hash of the doc_id, so the same rows train the same model.

Defined cases: null counts as empty; texts without words have all features zero but their length and get
a score like any other. Labels other than 0 and 1, null labels and labels of unknown documents are not
used; a document with several labels gives one row for each. If a class has no row, every score is CUT.
Extra columns are returned unchanged, except that a column named like the score is replaced.
"""

from __future__ import annotations

from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relist.llm.common import pieces, texts_of, unused

FEATURES = ["upper", "symbol", "mark", "digit", "beyond_ascii", "space", "line_end", "distinct", "repeated", "word_length", "length", "pipe", "bang"]
CUT = 0.3
PER_CLASS, PAIRS, RIDGE = 4000, 40_000, 1e-3


def _class(chars: str) -> np.ndarray:
    out = np.zeros(256)
    out[list(chars.encode())] = 1
    return out


_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)], float)
_CLASSES = np.stack([
    np.array([65 <= b <= 90 for b in range(256)], float), _class("#$%&*^~=_+<>{}[]\\@"), _class(".,;:?'\"()-"), _class("0123456789"),
    np.array([b >= 128 for b in range(256)], float), _class(" \t"), _class("\n\r"), _class("|"), _class("!")])


def features(text: bytes) -> np.ndarray:
    """The FEATURES of a text; a long text is read in parts, its words are counted over all of them."""
    counts, n, repeats, seen, last = np.zeros(256), 0, 0, set(), None
    for part in pieces(text):
        counts += np.bincount(np.frombuffer(part, np.uint8), minlength=256)
        words = part.split()
        if words:
            seen.update(words)
            repeats += (words[0] == last) + sum(map(eq, words[1:], words))
            n, last = n + len(words), words[-1]
    size, letters = max(1.0, counts.sum()), counts @ _LETTER
    distinct = np.log1p(len(seen)) / np.log1p(max(1, n))
    shares = _CLASSES @ counts / size
    shares[0] *= size / max(1.0, letters)
    return np.array([*shares[:7], distinct, repeats / max(1, n), np.log1p(letters / max(1, n)), np.log1p(n), shares[7], shares[8]])


class Ranking:
    """Weights of the standardised features and the logistic scale of the scores."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, weights: np.ndarray, threshold: float, slope: float):
        self.mean, self.spread, self.weights, self.threshold, self.slope = mean, spread, weights, threshold, slope

    def strength(self, x: np.ndarray) -> np.ndarray:
        return (x - self.mean) / self.spread @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        z = self.slope * (self.strength(x) - self.threshold) + np.log(CUT / (1 - CUT))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit_ranking(good: np.ndarray, bad: np.ndarray, share_bad: float, pairs: int = PAIRS) -> Ranking:
    """Bradley-Terry weights from preference pairs good over bad, and the quantile threshold."""
    both = np.concatenate([good, bad])
    zero = np.zeros(len(FEATURES))
    if not len(good) or not len(bad):
        return Ranking(zero, zero + 1, zero, 0.0, 1.0)
    mean, spread = both.mean(axis=0), both.std(axis=0) + 1e-9
    rng = np.random.default_rng(7)
    x = (good[rng.integers(0, len(good), pairs)] - bad[rng.integers(0, len(bad), pairs)]) / spread
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(np.clip(x @ w, -30, 30)))
        slope = x.T @ p / pairs - RIDGE * w
        bend = (x * (p * (1 - p))[:, None]).T @ x / pairs + RIDGE * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w = w + step
        if np.abs(step).max() < 1e-6:
            break
    made = Ranking(mean, spread, w, 0.0, 1.0)
    up, down = made.strength(good), made.strength(bad)
    levels = np.unique(np.quantile(np.concatenate([up, down]), np.linspace(0, 1, 401)))
    cuts = (levels[1:] + levels[:-1]) / 2 if len(levels) > 1 else levels
    loss = [(1 - share_bad) * (up < c).mean() + share_bad * (down >= c).mean() for c in cuts]
    least = np.flatnonzero(np.array(loss) <= min(loss) + 1e-12)
    made.threshold = float(cuts[least[len(least) // 2]])
    return made


def _features_column():
    def read(texts: pa.Array) -> pa.Array:
        return pa.array([features(texts_of(texts, k, k + 1)[0]).tolist() for k in range(len(texts))], pa.list_(pa.float64()))

    return F.arrow_udf(read, "array<double>").asNondeterministic()


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          per_class: int = PER_CLASS, pairs: int = PAIRS) -> Ranking:
    """Fit on at most about `per_class` rows of each label; call with the rows that may be learnt from."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where("label IN (0, 1) AND id IS NOT NULL")
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    take = {c: min(1.0, per_class / max(1, sizes.get(c, 0))) for c in (0, 1)}
    def drawn(share: Column) -> Column:
        return F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("sample")), F.lit(1 << 20)) < share * (1 << 20)

    # The draw depends on the id alone, so documents are thinned out and reduced to features before the join.
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).where(drawn(F.lit(max(take.values()))))
    chosen = known.where(drawn(F.when(F.col("label") == 1, take[1]).otherwise(take[0])))
    found = rows.select("id", _features_column()("text").alias("x")).join(chosen, "id").select("label", "x").collect()
    good, bad = (np.array([r["x"] for r in found if r["label"] == c], float).reshape(-1, len(FEATURES)) for c in (1, 0))
    return fit_ranking(good, bad, sizes.get(0, 0) / max(1, sum(sizes.values())), pairs)


def with_score(docs: DataFrame, ranking: Ranking, text: str = "text", column: str = "score") -> DataFrame:
    """`docs` with the quality score of each text."""
    def score(texts: pa.Array) -> pa.Array:
        if not len(texts):
            return pa.array([], pa.float64())
        return pa.array(ranking.score(np.stack([features(texts_of(texts, k, k + 1)[0]) for k in range(len(texts))])))

    return docs.withColumn(column, F.arrow_udf(score, "double").asNondeterministic()(F.col(text).cast("string")))


def drop_refused(docs: DataFrame, ranking: Ranking, text: str = "text") -> DataFrame:
    """The rows of `docs` whose score reaches the threshold, with all their columns."""
    score = unused(docs, "__score")
    return with_score(docs, ranking, text, score).where(F.col(score) >= CUT).drop(score)


def learnable(doc_id: str = "doc_id", parts: int = 5, held_out: int = 0):
    """Whether a row may be learnt from: crc32 of its id as text, modulo `parts`, is not `held_out`."""
    return ~F.coalesce(F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts)) == held_out, F.lit(False))
