"""Spelling variants of words, found in frequency-vector tries.

Two words are near if one inserted, deleted or replaced code point turns one into the other. Of such a pair the halves
in front of or behind the change are equal, and the letters of the other halves differ by a surplus of at most one and a
deficit of at most one. So every word is entered under its equal half (a block) and the other half as a vector: how many
of its letters fall into each of GROUPS letter groups (code point modulo GROUPS). The entries of a block form a trie,
one level per letter group, branching by the count. The search goes down it with a surplus and a deficit of one to
spend: at each level to the branch of the same count, to the next higher one for the surplus, then to the next lower one
for the deficit. The surplus comes first, so each pair is met from one side only. What the search reaches at the leaves
are candidates; they are compared code point by code point.

The vocabulary is counted and entered by Spark; a task builds the tries of some blocks at a time from its sorted
entries and searches them depth first, a bounded number of branches at once. A block of more than `limit`
entries is divided further by the first TOP levels of its trie: each entry is stored in its own part and searches all
parts that its budget reaches, so no task needs a whole hot block and no pair is lost or met twice.

The form of a word is its near word of largest count (ties: the smallest in code-point order), if that count is at least
`ratio` times its own; the root follows the forms to the last. Each form occurs `ratio` times as often, so chains are
logarithmic in the largest count and pointer doubling ends after a few joins.

Defined cases: null, empty and blank texts have no words; words shorter than `shortest` or rarer than `rarest` are no
words here. Rows that repeat count as often as they occur. Words of any length are compared whole; very long ones are
held by the task of their block. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relist.session import materialize

LETTERS = r"[A-Za-zÀ-ÿ]"
SHORTEST, RAREST, RATIO = 7, 2, 10
GROUPS, TOP, LIMIT = 16, 8, 4096
#: Entries whose tries a task holds at once (and one block more), and branches it follows at a time.
HELD, BRANCHES = 1 << 16, 1 << 18

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs_of_letters(text: Column, shortest: int = 1) -> Column:
    """The maximal runs of letters of at least `shortest` code points, A-Z lower-cased."""
    return F.regexp_extract_all(F.translate(text.cast("string"), _UPPER, _LOWER), F.lit(f"{LETTERS}{{{shortest},}}"), F.lit(0))


def vocabulary(words: DataFrame, word: str = "word", shortest: int = SHORTEST, rarest: int = RAREST) -> DataFrame:
    """(word, n) of the words that are long and frequent enough."""
    counted = words.select(F.col(word).alias("word")).where(F.length("word") >= shortest).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return counted.where(F.col("n") >= rarest)


def _counts(rest: Column) -> list[Column]:
    """How many letters of `rest` fall into each of the first TOP groups."""
    codes = F.transform(F.regexp_extract_all(rest, F.lit("(?s)."), F.lit(0)), lambda c: F.pmod(F.ascii(c), F.lit(GROUPS)))
    return [_times(codes, g) for g in range(TOP)]


def _times(codes: Column, group: int) -> Column:
    return F.size(F.filter(codes, lambda c: c == group))


def entries(words: DataFrame) -> DataFrame:
    """The places of each word in the tries.

    (block, side, size, rest, word, n): under the front half (side 0) and the back half (side 1), as a word of `size`
    code points that looks for others, and as a longer word that is found by those of one less.
    """
    length = F.length("word")
    places = F.explode(F.array(*[F.struct(F.lit(side).alias("side"), (length - longer).alias("size")) for side in (0, 1) for longer in (0, 1)]))
    front = F.floor(F.col("size") / 2).cast("int")
    placed = words.where(length > 0).select("word", "n", places.alias("p")).select("word", "n", "p.*").where("size > 0")
    placed = placed.withColumn("front", front).withColumn("back", F.col("size") - F.col("front"))
    half = F.when(F.col("side") == 0, F.expr("left(word, front)")).otherwise(F.expr("right(word, back)"))
    rest = F.when(F.col("side") == 0, F.expr("substring(word, front + 1)")).otherwise(F.expr("left(word, length(word) - back)"))
    return placed.select(F.concat_ws(":", "size", "side", half).alias("block"), "side", "size", rest.alias("rest"), "word", "n")


def divided(placed: DataFrame, limit: int = LIMIT) -> DataFrame:
    """The entries with the part of their block (`bucket`) and whether they are `stored` there, only `seek` there, or both."""
    hot = placed.groupBy("block").agg(F.count(F.lit(1)).alias("times")).where(F.col("times") > limit).select("block")
    hot = materialize(hot, "hot-blocks").withColumn("hot", F.lit(True))
    marked = placed.join(hot, "block", "left")
    seeks = F.length("word") == F.col("size")
    plain = marked.where("hot IS NULL").select(F.col("block").alias("bucket"), "side", "size", "word", "n", F.lit(True).alias("stored"), seeks.alias("seek"))
    counted = marked.where("hot").withColumn("c", F.array(*_counts(F.col("rest"))))

    def part(c: Column) -> Column:
        return F.concat_ws(":", "block", F.concat_ws(",", F.transform(c, lambda x: x.cast("string"))))

    own = counted.select(part(F.col("c")).alias("bucket"), "side", "size", "word", "n", F.lit(True).alias("stored"), F.lit(False).alias("seek"))
    # Parts that the budget reaches within the first levels: nothing, a surplus, a surplus and behind it a deficit, or a
    # surplus whose deficit lies further down.
    levels = F.sequence(F.lit(0), F.lit(TOP - 1))
    spent = F.concat(F.array(F.struct(F.lit(-1).alias("more"), F.lit(-1).alias("less"))), F.flatten(F.transform(levels, lambda i: F.transform(
        F.filter(F.sequence(i, F.lit(TOP)), lambda j: (j == TOP) | ((j > i) & (F.get("c", j) > 0))), lambda j: F.struct(i.alias("more"), j.alias("less"))))))
    reached = counted.where(seeks).select("block", "side", "size", "word", "n", "c", F.explode(spent).alias("s"))
    there = F.transform("c", lambda x, k: x + (k == F.col("s.more")).cast("int") - (k == F.col("s.less")).cast("int"))
    visits = reached.select(part(there).alias("bucket"), "side", "size", "word", "n", F.lit(False).alias("stored"), F.lit(True).alias("seek"))
    return plain.unionByName(own).unionByName(visits)


class _Trie:
    """The tries of several blocks in one: below the root a branch for each block, then a level per letter group.

    Of each level the branches are kept as sorted numbers, node above * span + count.
    """

    def __init__(self, block: np.ndarray, vectors: np.ndarray):
        self.span = int(vectors.max(initial=0)) + 3
        node, self.levels = block, []
        for column in vectors.T:
            branches, node = np.unique(node * self.span + column, return_inverse=True)
            self.levels.append(branches)
        self.order = np.argsort(node, kind="stable")
        self.leaves = np.searchsorted(node[self.order], np.arange(len(self.levels[-1]) + 1))

    def search(self, block: np.ndarray, vectors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number of a query, number of an entry) of all entries that a surplus and a deficit of one can reach.

        Depth first: the branches furthest down are followed first, BRANCHES of them at a time.
        """
        waiting = [(0, np.arange(len(block)), block, np.zeros(len(block), np.int8))]
        while waiting:
            level, query, node, spent = waiting.pop()
            if len(query) > BRANCHES:
                waiting.append((level, query[BRANCHES:], node[BRANCHES:], spent[BRANCHES:]))
                query, node, spent = query[:BRANCHES], node[:BRANCHES], spent[:BRANCHES]
            if level == len(self.levels):
                sizes = self.leaves[node + 1] - self.leaves[node]
                offset = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                yield np.repeat(query, sizes), self.order[np.repeat(self.leaves[node], sizes) + offset]
                continue
            count, branches = vectors[query, level], self.levels[level]
            below = []
            for step, allowed in ((0, None), (1, spent == 0), (-1, (spent == 1) & (count > 0))):
                some = slice(None) if allowed is None else np.flatnonzero(allowed)
                wanted = node[some] * self.span + count[some] + step
                at = np.searchsorted(branches, wanted)
                there = np.flatnonzero(branches[np.minimum(at, len(branches) - 1)] == wanted)
                below.append((query[some][there], at[there], spent[some][there] + abs(step)))
            found = [np.concatenate(part) for part in zip(*below)]
            if len(found[0]):
                waiting.append((level + 1, found[0], found[1], found[2].astype(np.int8)))


def _codes(words: pa.Array, length: int) -> np.ndarray:
    """The code points of words of one length, a row each."""
    return np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def _vectors(codes: np.ndarray) -> np.ndarray:
    group = codes % GROUPS
    return np.stack([(group == g).sum(axis=1) for g in range(GROUPS)], axis=1).astype(np.int64)


def _pairs_of_size(batch: pa.Table, block: np.ndarray, side: int, size: int) -> Iterator[pa.RecordBatch]:
    """The near pairs of the blocks of one side and size."""
    long = pc.greater(pc.utf8_length(batch["word"]), size).to_numpy()
    stored, seek = batch["stored"].to_numpy(), batch["seek"].to_numpy() & ~long
    front = size // 2
    rest = (lambda c: c[:, front:]) if side == 0 else (lambda c: c[:, : c.shape[1] - (size - front)])
    word, n = batch["word"].combine_chunks(), batch["n"].to_numpy()
    takes = {}
    for longer in (False, True):
        rows = np.flatnonzero(long == longer)
        codes = _codes(word.take(pa.array(rows)), size + longer) if len(rows) else np.zeros((0, size + longer), np.uint32)
        takes[longer] = rows, codes
    vectors = np.zeros((len(word), GROUPS), np.int64)
    place = np.zeros(len(word), np.int64)
    for rows, codes in takes.values():
        vectors[rows] = _vectors(rest(codes))
        place[rows] = np.arange(len(rows))
    kept, asks = np.flatnonzero(stored), np.flatnonzero(seek)
    if not len(kept) or not len(asks):
        return
    trie = _Trie(block[kept], vectors[kept])
    own, longer_own = takes[False][1], takes[True][1]
    for query, entry in trie.search(block[asks], vectors[asks]):
        a, b = asks[query], kept[entry]
        far = long[b]
        x, y = own[place[a[~far]]], own[place[b[~far]]]
        # One replaced: the pair is met once in a leaf of equal vectors if the smaller word asks.
        changed = (x != y).sum(axis=1) == 1
        equal = (vectors[a[~far]] == vectors[b[~far]]).all(axis=1)
        at = (x != y).argmax(axis=1)
        index = np.arange(len(x))
        near = changed & (~equal | (x[index, at] < y[index, at])) if len(x) else changed
        x, y = own[place[a[far]]], longer_own[place[b[far]]]
        # One inserted: the words agree up to some place, and behind it shifted by one. Seen from both sides, the front one counts.
        ahead = np.cumprod(x == y[:, :-1], axis=1).sum(axis=1)
        behind = np.cumprod((x == y[:, 1:])[:, ::-1], axis=1).sum(axis=1)
        inserted = (ahead + behind >= size) & ((ahead >= front) == (side == 0))
        one, two = (np.concatenate([p[~far][near], p[far][inserted]]) for p in (a, b))
        yield pa.RecordBatch.from_arrays(
            [word.take(pa.array(one)), pa.array(n[one]), word.take(pa.array(two)), pa.array(n[two])], ["word", "n", "near", "near_n"])


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by bucket -> near pairs; whole buckets are taken together."""
    def searched(table: pa.Table) -> Iterator[pa.RecordBatch]:
        block = pc.dictionary_encode(table["bucket"].combine_chunks()).indices.to_numpy().astype(np.int64)
        side, size = table["side"].to_numpy(), table["size"].to_numpy()
        kinds = side.astype(np.int64) * (int(size.max()) + 1) + size
        for kind in np.unique(kinds):
            rows = np.flatnonzero(kinds == kind)
            yield from _pairs_of_size(table.take(pa.array(rows)), block[rows], int(side[rows[0]]), int(size[rows[0]]))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(map(len, held)) >= HELD:
            table = pa.Table.from_batches(held)
            last = table["bucket"][-1].as_py()
            whole = pc.index(table["bucket"], pa.scalar(last, table["bucket"].type)).as_py()
            if whole:
                yield from searched(table.slice(0, whole))
                held = table.slice(whole).combine_chunks().to_batches()
    if held and sum(map(len, held)):
        yield from searched(pa.Table.from_batches(held))


def near_pairs(words: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(word, n, near, near_n): each pair of near words of the vocabulary once."""
    placed = divided(entries(words), limit).repartition("bucket").sortWithinPartitions("bucket")
    return placed.mapInArrow(_pairs, "word string, n bigint, near string, near_n bigint")


def with_forms(words: DataFrame, ratio: int = RATIO, limit: int = LIMIT) -> DataFrame:
    """(word, n, n_near, form, form_n) of every word of the vocabulary."""
    pairs = materialize(near_pairs(words, limit), "near-pairs")
    both = pairs.select("word", "n", F.struct((-F.col("near_n")).alias("n"), F.col("near").alias("word")).alias("best")).unionByName(
        pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.struct((-F.col("n")).alias("n"), F.col("word").alias("word")).alias("best")))
    alone = words.select("word", "n", F.lit(None).cast(both.schema["best"].dataType).alias("best"))
    found = both.unionByName(alone).groupBy("word", "n").agg(F.count("best").alias("n_near"), F.min("best").alias("best"))
    better = -F.col("best.n") >= ratio * F.col("n")
    return found.select("word", "n", "n_near", F.when(better, F.col("best.word")).alias("form"), F.when(better, -F.col("best.n")).alias("form_n"))


def with_roots(formed: DataFrame, ratio: int = RATIO) -> DataFrame:
    """The words with `root`: follow the forms to the last; the word itself if it has none."""
    formed = materialize(formed, "forms")
    links = materialize(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "links")
    most = formed.agg(F.max("n")).first()[0] or 1
    longest = max(1, math.ceil(math.log(most + 1, ratio)))
    for _ in range(max(1, math.ceil(math.log2(longest + 1)))):
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = materialize(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "links")
    return formed.join(links, "word", "left").withColumn("root", F.coalesce("root", "word"))


def spelling_variants(words: DataFrame, ratio: int = RATIO, limit: int = LIMIT) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of a vocabulary (word, n); words are unique."""
    if ratio < 2:
        raise ValueError("ratio must be at least 2, so that forms lead upwards")
    return with_roots(with_forms(materialize(words, "vocabulary"), ratio, limit), ratio)
