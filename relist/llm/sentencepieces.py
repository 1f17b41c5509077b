"""SentencePiece encoding as a max-plus parallel scan, and decoding.

A text is a path through a lattice: nodes are the gaps between its characters, edges the vocabulary's
pieces (and single characters, which fall back to byte pieces if the vocabulary lacks them). A path's
value is the sum of its edges' and joints' weights. For a unigram vocabulary an edge weighs its piece's
score. For a merge (BPE) vocabulary an edge weighs nothing, and a joint weighs nothing if merging the
text of its two pieces gives just these two, else minus infinity: the merge result is then the one path
of finite value, because merges are local to neighbours.

A text of over CHUNK characters is cut into chunks. A state at a cut is a piece that starts before it and ends at or
after it. Each chunk yields its transfer matrix, in which cell (i, j) is the best value from state i
at its start to state j at its end. Matrices combine under (max, +), which is associative: groups of FAN are
combined level by level, and the best states are handed down the same levels, so no task holds more
than FAN matrices of a document. Each chunk is then backtraced alone, between its two states.

Where no piece holds the two characters around a gap side by side, none runs across it, and the paths on
both sides are independent; the words between such gaps are solved once and remembered.

Defined cases: null and empty texts have no tokens and decode to the empty text. Decoding gives
the encoded text back exactly, unless it holds U+2581 (the space sign itself, decoded as a space). Each
input row gives one output row, repeated ids included; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relist.session import materialize

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK, FAN = 1 << 15, 64
SPACE = "▁"
#: Solved words, and pairs of pieces, that a Python worker remembers.
REMEMBERED = 1_000_000

_NONE = float("-inf")


class Vocabulary:
    """Pieces, scores and byte pieces of a model, and what follows from them."""

    def __init__(self, pieces: list[str], scores: list[float], fixed: set[int], byte_ids: list[int], unknown: int, merges: bool = True):
        self.pieces, self.scores, self.byte_ids, self.unknown, self.merges = pieces, scores, byte_ids, unknown, merges
        self.ids = {p: i for i, p in enumerate(pieces) if i not in fixed}
        self.longest = max(map(len, self.ids), default=1)
        #: Which characters stand side by side in a piece, by number of the left and of the right one.
        chars = sorted({c for p in self.ids if len(p) > 1 for c in p})
        self.numbers = np.zeros(0x110000, np.uint16)
        self.numbers[[ord(c) for c in chars]] = np.arange(1, len(chars) + 1)
        self.beside = np.zeros((len(chars) + 1, len(chars) + 1), bool)
        for p in self.ids:
            at = [self.numbers[ord(c)] for c in p]
            self.beside[at[:-1], at[1:]] = True
        self.least = min((scores[i] for i in self.ids.values()), default=0.0) - 10
        self.flat = self.beside.astype(np.int8).ravel()
        #: The two parts whose merge makes a piece, for pieces that merging makes.
        self.halves: dict[str, tuple[str, str]] = {}
        for p in self.ids if merges else ():
            steps: list[tuple[str, str]] = []
            if len(p) > 1 and self.merged(p, steps) == [p]:
                self.halves[p] = steps[-1]
        score = lambda p: self.scores[self.ids[p]] if p in self.ids and len(p) > 1 else 0.0
        #: Merges come in falling order of their scores, as they do in a trained vocabulary.
        self.falling = all(score(p) <= min(score(a), score(b)) for p, (a, b) in self.halves.items())
        #: Every beginning of a piece: 0, or its id + 1 if it is itself a piece that can stand in a path.
        self.beginnings = {p[:k]: 0 for p in self.ids for k in range(1, len(p))}
        self.beginnings |= {p: i + 1 if not merges or len(p) == 1 or p in self.halves else 0 for p, i in self.ids.items()}
        #: The same as a tree: by character, (id + 1 or 0, what may follow).
        self.tree: dict = {}
        for p in sorted(self.beginnings, key=len):
            at = self.tree
            for c in p[:-1]:
                at = at[c][1]
            at[p[-1]] = (self.beginnings[p], {})
        self.singles = {c for c in self.ids if len(c) == 1}
        #: Per piece, which pieces may follow it; the ends of pieces while they are merged; solved words.
        self._joints: dict[int, dict[int, bool]] = {}
        self.counted = 0
        self._edges: tuple[dict, dict] = ({}, {})
        self.words: dict[str, bytes] = {}

    @classmethod
    def load(cls, path: str = MODEL, merges: bool = True) -> Vocabulary:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        fixed = {i for i in range(n) if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if not all(model.is_byte(i) for i in byte_ids):
            byte_ids = []
        return cls([model.id_to_piece(i) for i in range(n)], [model.get_score(i) for i in range(n)], fixed, byte_ids, model.unk_id(), merges)

    def __getstate__(self):
        return self.__dict__ | {"_joints": {}, "counted": 0, "_edges": ({}, {}), "words": {}}

    def merged(self, text: str, steps: list | None = None) -> list[str]:
        """The pieces that merging leaves: the pair of the highest score first, the leftmost of equal ones."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                i = self.ids.get(parts[k] + parts[k + 1])
                if i is not None and (best is None or self.scores[i] > best):
                    best, at = self.scores[i], k
            if at < 0:
                return parts
            if steps is not None:
                steps.append((parts[at], parts[at + 1]))
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def is_edge(self, piece: str) -> bool:
        """Whether a piece can stand in a path."""
        return len(piece) == 1 or self.beginnings.get(piece, 0) > 0

    def weight(self, piece: str) -> float:
        if self.merges:
            return 0.0
        i = self.ids.get(piece)
        return self.least if i is None else self.scores[i]

    def joins(self, left: str, right: str) -> bool:
        """Whether two pieces stay apart when their text is merged."""
        if not self.merges:
            return True
        if self.falling and left in self.beginnings and right in self.beginnings:
            return self._stay_apart(left, right)
        return self.merged(left + right) == [left, right]

    def _edge(self, piece: str, side: int) -> list[tuple[str, float]]:
        """What stands at the right (1) or left (0) end of a piece while it is merged, and the score that ends it."""
        known = self._edges[side].get(piece)
        if known is None:
            known, end, score = [], piece, _NONE
            while True:
                known.append((end, score))
                if end not in self.halves:
                    break
                end, score = self.halves[end][side], self.scores[self.ids[end]]
            known.reverse()
            self._edges[side][piece] = known
        return known

    def _stay_apart(self, left: str, right: str) -> bool:
        """Follow both sides of the gap through their merges: does a merge across it ever come first?

        Of equal scores the leftmost merge comes first: within `left`, then across, then within `right`.
        """
        ends, starts = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            (a, next_left), (b, next_right) = ends[i], starts[j]
            across = self.ids.get(a + b)
            if across is not None and self.scores[across] > next_left and self.scores[across] >= next_right:
                return False
            if next_left == next_right == _NONE:
                return True
            if next_left >= next_right:
                i += 1
            else:
                j += 1


    def ids_of(self, piece: str) -> list[int]:
        i = self.ids.get(piece)
        if i is not None:
            return [i]
        return [self.byte_ids[b] for b in piece.encode()] if self.byte_ids else [self.unknown]

    def forward(self, text: str, starts: list[tuple[int, int]], stop: int) -> list[dict[int, tuple[list[float], list[int]]]]:
        """For each gap up to `stop` and beyond, the pieces that end there, by where they start.

        `starts` are the entry pieces (start, end); each found piece has its best value and the start of the
        piece before it, for each entry. A piece that starts before `stop` may end after it.
        """
        n = len(starts)
        at: list[dict] = [{} for _ in range(len(text) + 1)]
        for k, (a, e) in enumerate(starts):
            values, _ = at[e].setdefault(a, ([_NONE] * n, [-1] * n))
            values[k] = 0.0
        for i in range(min(stop, len(text))):
            here = at[i]
            if not here:
                continue
            if not self.merges and len(here) > 1:
                here = self._best(here, n)
            for length in range(1, min(self.longest, len(text) - i) + 1):
                piece = text[i:i + length]
                if not self.is_edge(piece):
                    continue
                weight = self.weight(piece)
                for a, (values, _) in here.items():
                    if a < i and not self.joins(text[max(a, 0):i], piece):
                        continue
                    there = at[i + length].get(i)
                    if there is None:
                        there = at[i + length][i] = ([_NONE] * n, [-1] * n)
                    for k, v in enumerate(values):
                        if v + weight > there[0][k]:
                            there[0][k], there[1][k] = v + weight, a
        return at

    @staticmethod
    def _best(here: dict, n: int) -> dict:
        """The pieces that are best for some entry, each with the entries it is best for."""
        out: dict = {}
        for k in range(n):
            a = max(here, key=lambda a: here[a][0][k])
            if here[a][0][k] > _NONE:
                out.setdefault(a, ([_NONE] * n, here[a][1]))[0][k] = here[a][0][k]
        return out

    def path(self, text: str, start: tuple[int, int], stop: int, end: tuple[int, int]) -> list[int]:
        """Ids of the pieces on the best path that start after piece `start` and before `stop`, the last being `end`."""
        at = self.forward(text, [start], stop)
        out, (a, e) = [], end
        while (a, e) != start:
            out.append(text[a:e])
            a, e = at[e][a][1][0], a
        return [i for p in reversed(out) for i in self.ids_of(p)]

    def word(self, text: str) -> bytes:
        """Ids of an independent word, as 32-bit numbers."""
        if len(text) == 1:
            ids = self.ids_of(text)
        elif self.merges and self.singles.issuperset(text):
            ids = self._only_path(text)
        else:
            at = self.forward(text, [(0, 0)], len(text))[len(text)]
            last = max(at, key=lambda a: at[a][0][0])
            ids = self.path(text, (0, 0), len(text), (last, len(text)))
        out = array("i", ids).tobytes()
        if len(text) <= 64 and len(self.words) < REMEMBERED // 2:
            self.words[text] = out
        return out

    def _only_path(self, text: str) -> list[int]:
        """`path` through a merge vocabulary from one entry: at most one piece with a finite value ends at each gap."""
        if self.counted > REMEMBERED:
            self.counted = 0
            self._joints.clear()
        n, rows = len(text), self._joints
        came, ids = [-1] * (n + 1), [0] * (n + 1)
        for i in range(n):
            if i:
                if came[i] < 0:
                    continue
                row = rows.get(ids[i])
                if row is None:
                    row = rows[ids[i]] = {}
            after, j = self.tree, i
            for c in text[i:]:
                node = after.get(c)
                if node is None:
                    break
                piece, after = node
                j += 1
                if piece and came[j] < 0:
                    if i:
                        joined = row.get(piece)
                        if joined is None:
                            joined = row[piece] = self.joins(text[came[i]:i], text[i:j])
                            self.counted += 1
                        if not joined:
                            continue
                    came[j], ids[j] = i, piece
        out, e = [], n
        while e:
            out.append(ids[e] - 1)
            e = came[e]
        out.reverse()
        return out

    def gaps(self, text: str) -> np.ndarray:
        """Where no piece runs across, apart from the ends."""
        at = self.numbers[np.frombuffer(text.encode("utf-32-le"), np.uint32)].astype(np.int32)
        return np.flatnonzero(self.flat[at[:-1] * len(self.beside) + at[1:]] == 0) + 1

    def whole(self, text: str) -> bytes:
        """Ids of a text that starts and ends at independent gaps."""
        if not text:
            return b""
        cuts, known, word = self.gaps(text).tolist(), self.words, self.word
        return b"".join([known.get(w) or word(w) for w in [text[a:b] for a, b in zip([0, *cuts], [*cuts, len(text)])]])


def states(vocabulary: Vocabulary, text: str, cut: int) -> list[tuple[int, int]]:
    """The pieces that start before `cut` and end at it or after it."""
    reach = vocabulary.longest
    return [(a, e) for a in range(max(0, cut - reach), cut) for e in range(cut, min(len(text), a + reach) + 1) if vocabulary.is_edge(text[a:e])]


class Chunk:
    """A chunk with enough text on both sides to know the states at its cuts."""

    def __init__(self, vocabulary: Vocabulary, left: str, body: str, right: str):
        self.v, self.text = vocabulary, left + body + right
        self.start, self.stop = len(left), len(left) + len(body)
        self.entries = states(vocabulary, self.text, self.start) if left else [(0, 0)]
        self.exits = states(vocabulary, self.text, self.stop) if right else None
        #: The first and the last independent gap within the chunk.
        gaps = vocabulary.gaps(body)
        self.first, self.last = (self.start + int(gaps[0]), self.start + int(gaps[-1])) if len(gaps) else (None, None)

    def _leave(self, at: list) -> list[list[float]]:
        """Values of the exits, one list for each exit."""
        n = len(next(iter(at[self.stop].values()))[0]) if at[self.stop] else 0
        if self.exits is None:
            return [[max(col) for col in zip(*(v for v, _ in at[self.stop].values()))]] if at[self.stop] else [[]]
        return [at[e][a][0] if a in at[e] else [_NONE] * n for a, e in self.exits]

    def matrix(self) -> list[list[float]]:
        """Best values from each entry state to each exit state."""
        if self.first is None:
            at = self.v.forward(self.text, self.entries, self.stop)
            columns = [c or [_NONE] * len(self.entries) for c in self._leave(at)]
            return [list(row) for row in zip(*columns)]
        head = self.text[:self.first]
        at = self.v.forward(head, self.entries, len(head))[len(head)]
        into = [max((v[k] for v, _ in at.values()), default=_NONE) for k in range(len(self.entries))]
        between = 0.0
        if not self.v.merges:
            ids = np.frombuffer(self.v.whole(self.text[self.first:self.last]), "<i4")
            between = float(sum(self.v.scores[i] for i in ids))
        out = [c[0] if c else _NONE for c in self._tail()]
        return [[a + between + b for b in out] for a in into]

    def _tail(self) -> list[list[float]]:
        chunk = object.__new__(Chunk)
        chunk.v, chunk.text, chunk.stop = self.v, self.text[self.last:], self.stop - self.last
        chunk.exits = None if self.exits is None else [(a - self.last, e - self.last) for a, e in self.exits]
        at = self.v.forward(chunk.text, [(0, 0)], chunk.stop)
        if chunk.exits is None:
            return chunk._leave(at)
        return [at[e][a][0] if a >= 0 and a in at[e] else [_NONE] for a, e in chunk.exits]

    def ids(self, entry: int, exit: int) -> bytes:
        """Ids of the pieces that start within the chunk, on the best path between two states."""
        start = self.entries[entry]
        if self.first is None:
            return self._path(self.text, start, self.stop, None if self.exits is None else self.exits[exit])
        head = self.text[:self.first]
        end = None if self.exits is None else (self.exits[exit][0] - self.last, self.exits[exit][1] - self.last)
        return (self._path(head, start, len(head), None) + self.v.whole(self.text[self.first:self.last])
                + self._path(self.text[self.last:], (0, 0), self.stop - self.last, end))

    def _path(self, text: str, start: tuple[int, int], stop: int, end: tuple[int, int] | None) -> bytes:
        if end is None:
            at = self.v.forward(text, [start], stop)[stop]
            end = (max(at, key=lambda a: at[a][0][0]), stop)
        return np.array(self.v.path(text, start, stop, end), "<i4").tobytes()


def combine(matrices: list[list[list[float]]]) -> list[list[float]]:
    """The (max, +) product."""
    out = np.array(matrices[0], float)
    for m in matrices[1:]:
        out = (out[:, :, None] + np.array(m, float)[None, :, :]).max(axis=1)
    return out.tolist()


def best_states(matrices: list[list[list[float]]], entry: int, exit: int) -> list[tuple[int, int]]:
    """The best (entry, exit) of each matrix in a row, given the outer two."""
    values, back = np.array(matrices[0], float)[entry], []
    for m in matrices[1:]:
        paths = values[:, None] + np.array(m, float)
        back.append(paths.argmax(axis=0))
        values = paths.max(axis=0)
    cuts = [exit]
    for b in reversed(back):
        cuts.append(int(b[cuts[-1]]))
    cuts.append(entry)
    cuts.reverse()
    return list(zip(cuts, cuts[1:]))


def prepare(text: str) -> str:
    """The text as the vocabulary sees it: a space sign in front and for every space."""
    return SPACE + text.replace(" ", SPACE) if text else ""


_IDS, _MATRIX = pa.list_(pa.int32()), pa.list_(pa.list_(pa.float64()))


def _id_lists(parts: Iterable[bytes]) -> pa.Array:
    """Lists of ids from their bytes, row by row."""
    flat, offsets = bytearray(), array("i", [0])
    for p in parts:
        flat += p
        offsets.append(len(flat) // 4)
    values = pa.Array.from_buffers(pa.int32(), len(flat) // 4, [None, pa.py_buffer(flat)])
    return pa.ListArray.from_arrays(pa.Array.from_buffers(pa.int32(), len(offsets), [None, pa.py_buffer(offsets)]), values)


def _text_column(texts: Iterable[bytes]) -> pa.Array:
    """Strings from their UTF-8, row by row."""
    flat, offsets = bytearray(), array("q", [0])
    for t in texts:
        flat += t
        offsets.append(len(flat))
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(flat)).cast(pa.string())


def _strings(column: pa.Array) -> Iterator[str]:
    return (x.as_py() or "" for x in column)


def encode(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", model: str = MODEL, chunk: int = CHUNK) -> DataFrame:
    """(doc_id, ids array<int>) of every row."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(Vocabulary.load(model))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))

    def whole(texts: pa.Array) -> pa.Array:
        return _id_lists(sent.value.whole(prepare(t)) for t in _strings(texts))

    short = rows.where(F.length("text") <= chunk).select("doc_id", F.arrow_udf(whole, "array<int>").asNondeterministic()("text").alias("ids"))
    return short.union(_encode_long(rows.where(F.length("text") > chunk), sent, chunk))


def cut_chunks(seen: Column, chunk: int, reach: int) -> Column:
    """array<struct<left, body, right>>: chunks of `chunk` characters, each with the `reach` characters around it.

    One match after the other cuts the text, so the work is linear in its length; the sides come from the neighbouring chunks alone.
    """
    bodies = F.regexp_extract_all(seen, F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    near = -(-reach // chunk)

    def around(all_: Column) -> Column:
        def at(i: Column) -> Column:
            return F.when((i >= 0) & (i < F.size(all_)), F.get(all_, i)).otherwise("")

        return F.transform(all_, lambda body, i: F.struct(
            F.right(F.concat(*[at(i - d) for d in range(near, 0, -1)]), F.lit(reach)).alias("left"), body.alias("body"),
            F.left(F.concat(*[at(i + d) for d in range(1, near + 1)]), F.lit(reach)).alias("right")))

    # Bound once by a transform over one element, so that the text is not cut again for each use.
    return F.flatten(F.transform(F.array(bodies), around))


def _encode_long(rows: DataFrame, sent, chunk: int) -> DataFrame:
    reach = sent.value.longest

    def matrix(left: pa.Array, body: pa.Array, right: pa.Array) -> pa.Array:
        return pa.array([Chunk(sent.value, *t).matrix() for t in zip(_strings(left), _strings(body), _strings(right))], _MATRIX)

    def backtrace(left: pa.Array, body: pa.Array, right: pa.Array, entry: pa.Array, exit: pa.Array) -> pa.Array:
        texts = zip(_strings(left), _strings(body), _strings(right), entry.to_pylist(), exit.to_pylist())
        return _id_lists(Chunk(sent.value, a, b, c).ids(i, j) for a, b, c, i, j in texts)

    seen = F.concat(F.lit(SPACE), F.replace("text", F.lit(" "), F.lit(SPACE)))
    parts = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", cut_chunks(seen, chunk, reach).alias("parts")).select(
        "row", "doc_id", F.posexplode("parts").alias("k", "p")).select("row", "doc_id", "k", "p.*")
    parts = materialize(parts.repartition(F.col("row"), F.col("k")), "chunks")
    sides = [F.col(c) for c in ("left", "body", "right")]
    matrices = materialize(parts.select("row", "k", F.arrow_udf(matrix, "array<array<double>>").asNondeterministic()(*sides).alias("m")), "matrices")
    chosen = _scan(matrices)
    ids = parts.join(chosen, ["row", "k"]).select(
        "row", "doc_id", "k", F.arrow_udf(backtrace, "array<int>").asNondeterministic()(*sides, F.col("entry"), F.col("exit")).alias("ids"))
    ordered = F.array_sort(F.collect_list(F.struct("k", "ids")))
    return ids.groupBy("row", "doc_id").agg(F.flatten(F.transform(ordered, lambda x: x["ids"])).alias("ids")).select("doc_id", "ids")


def _scan(matrices: DataFrame) -> DataFrame:
    """(row, k, entry, exit): the best states of every chunk, from the matrices of all chunks of its row."""
    def product(groups: pa.Array) -> pa.Array:
        return pa.array([combine([x["m"] for x in g]) for g in groups.to_pylist()], _MATRIX)

    def hand_down(groups: pa.Array, entry: pa.Array, exit: pa.Array) -> pa.Array:
        out = []
        for g, i, j in zip(groups.to_pylist(), entry.to_pylist(), exit.to_pylist()):
            out.append([{"k": x["k"], "entry": a, "exit": b} for x, (a, b) in zip(g, best_states([x["m"] for x in g], i, j))])
        return pa.array(out, pa.list_(pa.struct([("k", pa.int32()), ("entry", pa.int32()), ("exit", pa.int32())])))

    levels, groups = [matrices], []
    most = (matrices.agg(F.max("k")).first()[0] or 0) + 1
    while most > 1:
        grouped = levels[-1].groupBy("row", F.floor(F.col("k") / FAN).cast("int").alias("g")).agg(F.array_sort(F.collect_list(F.struct("k", "m"))).alias("ms"))
        groups.append(materialize(grouped, "scan-groups"))
        levels.append(groups[-1].select("row", F.col("g").alias("k"), F.arrow_udf(product, "array<array<double>>").asNondeterministic()("ms").alias("m")))
        most = -(-most // FAN)
    states_of = levels[-1].select("row", "k", F.lit(0).alias("entry"), F.lit(0).alias("exit"))
    for group in reversed(groups):
        both = group.join(states_of.withColumnRenamed("k", "g"), ["row", "g"])
        down = F.arrow_udf(hand_down, "array<struct<k:int,entry:int,exit:int>>").asNondeterministic()("ms", "entry", "exit")
        states_of = both.select("row", F.explode(down).alias("s")).select("row", "s.k", "s.entry", "s.exit")
    return states_of


def _parts(lists: pa.Array):
    """The ids of each row as a numpy view; none for null."""
    lists = lists if isinstance(lists, pa.ListArray) else lists.cast(_IDS)
    flat = lists.values.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy().tolist()
    return (flat[a:b] if valid else flat[:0] for a, b, valid in zip(offsets[:-1], offsets[1:], lists.is_valid().to_pylist()))


def digest(ids: Column) -> Column:
    """Lowercase SHA-256 of the ids as little-endian 32-bit numbers."""
    def read(lists: pa.Array) -> pa.Array:
        return pa.array([hashlib.sha256(np.ascontiguousarray(x, "<i4")).hexdigest() for x in _parts(lists)], pa.string())

    return F.arrow_udf(read, "string").asNondeterministic()(ids)


def decode(ids: Column, model: str = MODEL) -> Column:
    """The text of an array of ids: space signs become spaces, the one in front goes, byte pieces are joined to UTF-8."""
    v = Vocabulary.load(model)
    table = [p.replace(SPACE, " ").encode() for p in v.pieces]
    for b, i in enumerate(v.byte_ids):
        table[i] = bytes([b])

    def read(lists: pa.Array) -> pa.Array:
        texts = (b"".join([table[i] for i in x.tolist()]) for x in _parts(lists))
        return _text_column((t[1:] if t[:1] == b" " else t).decode(errors="replace").encode() for t in texts)

    return F.arrow_udf(read, "string").asNondeterministic()(ids)
