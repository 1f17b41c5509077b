"""Quality rules: gradient-boosted trees over statistics of whole documents.

Each text is reduced to counts (words, their code points, symbols, repeated lines, words in repeated 8-word windows) and
to FEATURES made of them and of a few more. A fixed rule refuses texts that are very short or repeat themselves; of the
rest the trees decide. They are grown one after the other on the gradient and curvature of the logistic loss over
binned features, with constraints: P(good) never rises with a feature of sign -1 (share of symbols, of repeated lines, of
repeated words). A split that would break this is not taken, and what lies below a split stays within the bound between
its two sides. All trees have the same depth and are flattened into arrays of features, thresholds and values, so a
batch of rows goes down all trees at once, one level a step.

The model is fitted on a bounded sample: about `per_class` labelled ids of each label, drawn by a hash of the id,
one row each. The counts, the rule and the verdict cover all rows and whole texts.

Defined cases: null counts as empty; a text without words has all counts zero and fails the rule. Labels other than 0
and 1 and labels of unknown documents are not used; an id with several labels gives one row for each, an id
with several texts the row with the smallest features. If a class has no row there are no trees, and the rule
decides alone. Extra columns stay; a column named like the result is replaced.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relist.llm.common import slices, texts_of
from relist.llm.runs import Index, Tape

#: (name, sign of the monotonic constraint).
FEATURES = [
    ("words", 0), ("word_length", 0), ("symbols", -1), ("repeated_lines", -1), ("repeated_words", -1), ("distinct", 0), ("top_word", 0),
    ("upper", 0), ("digits", 0), ("marks", 0), ("one_letter", 0), ("words_a_line", 0), ("ends", 0), ("beyond_ascii", 0), ("stutter", 0),
]
SIGNS = np.array([s for _, s in FEATURES])
SYMBOLS = b"#*$%&|<>"
WINDOW, FEWEST_WORDS, MOST_REPEATED = 8, 20, 30
TREES, DEPTH, BINS, RATE, RIDGE, LEAF, CUT = 60, 3, 32, 0.2, 1.0, 10.0, 0.3
PER_CLASS = 4000
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

_SPACE = bytes([0x20, *range(0x09, 0x0E)])
_CONTINUED = bytes(range(0x80, 0xC0))
_CLASSES = np.stack([[b in c for b in range(256)] for c in (range(65, 91), b"0123456789", b".,;:!?'\"()-", b".!?", range(128, 256), [*range(65, 91), *range(97, 123), *range(128, 256)])]).astype(float)


def repeated_words(tape: Tape, size: int = WINDOW) -> np.ndarray:
    """Which words lie in a window of `size` words that its text has twice or more."""
    found = Index(tape, np.arange(len(tape.ids)), size)
    rows = tape.ids[found.places[:, None] + np.arange(size)]
    same = found.group[1:] == found.group[:-1]
    places = found.places
    if (rows[1:][same] != rows[:-1][same]).any() or (tape.owner[places[1:]] != tape.owner[places[:-1]])[same].any():  # hashes that collided
        _, group, times = np.unique(np.column_stack([tape.owner[places], rows]), axis=0, return_inverse=True, return_counts=True)
        places = places[times[group.ravel()] > 1]
    edge = np.zeros(len(tape.ids) + 1, np.int64)
    np.add.at(edge, places, 1)
    np.add.at(edge, places + size, -1)
    return np.cumsum(edge[:-1]) > 0


def _lines(text: bytes) -> tuple[int, int]:
    """(lines with a word, those equal to an earlier one)."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines), len(lines) - len(set(lines))


def statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """COUNTS and FEATURES of each text."""
    words = [t.split() for t in texts]
    tape = Tape(words)
    k, n = len(texts), tape.counts
    some = np.maximum(n, 1)
    within = lambda flags: np.bincount(tape.owner[flags], minlength=k)
    chars = np.array([len(t.translate(None, _SPACE + _CONTINUED)) for t in texts], np.int64)
    symbols = np.array([len(t) - len(t.translate(None, SYMBOLS)) for t in texts], np.int64)
    lines, again = np.array([_lines(t) for t in texts], np.int64).reshape(-1, 2).T
    repeats = within(repeated_words(tape)) if len(tape.ids) else np.zeros(k, np.int64)
    counts = np.column_stack([n, chars, symbols, again, repeats])

    pairs, times = np.unique(tape.owner * (len(tape.ids) + 1) + tape.ids, return_counts=True)
    whose = pairs // (len(tape.ids) + 1)
    top = np.zeros(k, np.int64)
    np.maximum.at(top, whose, times)
    stutter = np.zeros(len(tape.ids), bool)
    stutter[1:] = (tape.ids[1:] == tape.ids[:-1]) & (tape.owner[1:] == tape.owner[:-1])
    short = np.fromiter((len(w) == 1 for t in words for w in t), bool, len(tape.ids))
    bytes_of = np.stack([np.bincount(np.frombuffer(t, np.uint8), minlength=256) for t in texts]) if k else np.zeros((0, 256))
    upper, digits, marks, ends, beyond, letters = _CLASSES @ bytes_of.T
    size = np.maximum(bytes_of.sum(axis=1), 1)
    return counts, np.column_stack([
        np.log1p(n), chars / some, symbols / np.maximum(chars, 1), again / np.maximum(lines, 1), repeats / some,
        np.log1p(np.bincount(whose, minlength=k)) / np.log1p(some), top / some, upper / np.maximum(letters, 1), digits / size, marks / size,
        within(short) / some, np.log1p(n / np.maximum(lines, 1)), ends / some, beyond / size, within(stutter) / some])


class Trees(NamedTuple):
    """All trees in flat arrays: of each, 2^DEPTH - 1 splits, level by level, and 2^DEPTH values of its leaves."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        splits, leaves = (1 << self.depth) - 1, 1 << self.depth
        first = np.arange(len(self.feature) // splits)[None, :]
        at, rows = np.zeros((len(x), first.size), np.int64), np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = first * splits + at
            at = 2 * at + 1 + (x[rows, self.feature[node]] > self.threshold[node])
        return self.base + self.value[first * leaves + at - splits].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -30, 30)))


class _Grower:
    """Grows one tree on binned features, with gradients and curvatures of the loss."""

    def __init__(self, bins: np.ndarray, cuts: list[np.ndarray], signs: np.ndarray, depth: int):
        self.bins, self.cuts, self.signs, self.depth = bins, cuts, signs, depth

    def grow(self, slope: np.ndarray, bend: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """feature, threshold, values of the leaves, and the leaf of each row."""
        splits = (1 << self.depth) - 1
        feature, threshold, value = np.zeros(splits, np.int64), np.full(splits, np.inf), np.zeros(splits + 1)
        at = np.zeros(len(slope), np.int64)
        bounds = {0: (-np.inf, np.inf)}
        for node in range(2 * splits + 1):
            low, high = bounds[node]
            rows = np.flatnonzero(at == node)
            mean = float(np.clip(slope[rows].sum() / (bend[rows].sum() + RIDGE), low, high)) if len(rows) else 0.0
            if node >= splits:
                value[node - splits] = float(np.clip(mean, low, high))
                continue
            best = self._split(rows, slope, bend, low, high) if len(rows) else None
            bounds[2 * node + 1] = bounds[2 * node + 2] = (low, high)
            if best:
                f, b, left, right = best
                feature[node], threshold[node] = f, self.cuts[f][b]
                if self.signs[f]:
                    middle = (left + right) / 2
                    sides = [(low, middle), (middle, high)] if self.signs[f] > 0 else [(middle, high), (low, middle)]
                    bounds[2 * node + 1], bounds[2 * node + 2] = sides
                at[rows] = 2 * node + 1 + (self.bins[rows, f] > b)
            else:
                at[rows] = 2 * node + 1
        return feature, threshold, value, at - splits

    def _split(self, rows, slope, bend, low, high):
        """The feature and bin whose split lowers the loss most and keeps its sign: (feature, bin, values of both sides)."""
        gain = lambda v, g, h: g * v - (h + RIDGE) * v * v / 2
        whole_g, whole_h = slope[rows].sum(), bend[rows].sum()
        whole = gain(np.clip(whole_g / (whole_h + RIDGE), low, high), whole_g, whole_h)
        best, most = None, 1e-6
        for f, cuts in enumerate(self.cuts):
            if not len(cuts):
                continue
            own = self.bins[rows, f]
            g = np.cumsum(np.bincount(own, slope[rows], len(cuts) + 1))[:-1]
            h = np.cumsum(np.bincount(own, bend[rows], len(cuts) + 1))[:-1]
            left, right = (np.clip(a / (b + RIDGE), low, high) for a, b in ((g, h), (whole_g - g, whole_h - h)))
            gains = gain(left, g, h) + gain(right, whole_g - g, whole_h - h) - whole
            # Curvature is at most 1/4 a row.
            fine = (h >= LEAF / 4) & (whole_h - h >= LEAF / 4) & ((right - left) * self.signs[f] >= 0)
            gains = np.where(fine, gains, 0)
            if gains.max() > most:
                b = int(gains.argmax())
                best, most = (f, b, left[b], right[b]), gains[b]
        return best


def fit_trees(x: np.ndarray, good: np.ndarray, signs: np.ndarray = SIGNS, trees: int = TREES, depth: int = DEPTH) -> Trees | None:
    """Boosted trees for P(good); both classes weigh the same. None if a class has no row."""
    if not good.any() or good.all():
        return None
    cuts = [np.unique(np.quantile(column, np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for column in x.T]
    bins = np.column_stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T)])
    weight = np.where(good, len(good) / 2 / good.sum(), len(good) / 2 / (~good).sum())
    grower, margin, grown = _Grower(bins, cuts, signs, depth), np.zeros(len(x)), []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        feature, threshold, value, leaf = grower.grow(weight * (good - p), weight * p * (1 - p))
        grown.append((feature, threshold, RATE * value))
        margin += RATE * value[leaf]
    return Trees(*(np.concatenate(part) for part in zip(*grown)), depth, 0.0)


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", per_class: int = PER_CLASS) -> Trees | None:
    """Fit on at most about `per_class` ids of each label; call with the labels that may be learnt from."""
    known = labels.select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("label")).where("label IN (0, 1) AND id IS NOT NULL")
    sizes = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = {c: min(1.0, per_class / max(1, sizes.get(c, 0))) for c in (0, 1)}

    def drawn(most: Column) -> Column:
        return F.pmod(F.xxhash64(F.col("id").cast("string"), F.lit("rules")), F.lit(1 << 20)) < most * (1 << 20)

    def read(texts: pa.Array) -> pa.Array:
        parts = [statistics(texts_of(texts, a, b))[1] for a, b in slices(texts)]
        return pa.array([row.tolist() for part in parts for row in part], pa.list_(pa.float64()))

    # The draw depends on the id alone: documents are thinned and reduced to features before the join.
    rows = docs.select(F.col(doc_id).alias("id"), F.col(text).cast("string").alias("text")).where(drawn(F.lit(max(share.values()))))
    chosen = known.where(drawn(F.when(F.col("label") == 1, share[1]).otherwise(share[0]))).distinct()
    features = rows.select("id", F.arrow_udf(read, "array<double>").asNondeterministic()("text").alias("x"))
    one = features.groupBy("id").agg(F.min("x").alias("x"))
    found = sorted(tuple(r) for r in one.join(chosen, "id").select("label", "x").collect())
    x = np.array([r[1] for r in found], float).reshape(-1, len(FEATURES))
    return fit_trees(x, np.array([r[0] == 1 for r in found], bool))


def base_failed(n_words: Column, n_repeat_words: Column) -> Column:
    """The fixed rule: too few words, or too large a share of them in repeated windows."""
    return (n_words < FEWEST_WORDS) | (100 * n_repeat_words > MOST_REPEATED * n_words)


def with_rules(docs: DataFrame, trees: Trees | None, text: str = "text", column: str = "rules", cut: float = CUT) -> DataFrame:
    """`docs` with COUNTS, score, base_failed and kept of each text in one struct column.

    score is P(good) by the trees, 1 without trees; kept is not base_failed and score >= cut.
    """
    def read(texts: pa.Array) -> pa.Array:
        parts = [statistics(texts_of(texts, a, b)) for a, b in slices(texts)] or [statistics([])]
        counts, x = (np.concatenate(part) for part in zip(*parts))
        score = trees.score(x) if trees else np.ones(len(x))
        return pa.StructArray.from_arrays([*(pa.array(c) for c in counts.T.astype(np.int64)), pa.array(score)], [*COUNTS, "score"])

    kind = f"struct<{','.join(f'{c}:bigint' for c in COUNTS)},score:double>"
    found = docs.withColumn(column, F.arrow_udf(read, kind).asNondeterministic()(F.col(text).cast("string")))
    failed = base_failed(F.col(f"`{column}`.n_words"), F.col(f"`{column}`.n_repeat_words"))
    return found.withColumn(column, F.col(f"`{column}`").withField("base_failed", failed).withField("kept", ~failed & (F.col(f"`{column}`.score") >= cut)))
