"""Periodic runs, spelling variants and quality rules against brute force and held-out rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from relist.llm import queries, rules, runs, spelling

SMALL, SF = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def digest(text) -> str:
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def crc(text) -> int:
    return zlib.crc32(str(text).encode())


# Periodic runs

def runs_brute(words, least=12):
    found = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if i > start and length >= max(least, 2 * q):
                run = words[start:start + length]
                if not any(run[p:] == run[:-p] for p in range(1, q)):
                    found.append((start, length, q))
            i += i == start
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {k for start, length, q in found for k in range(start + q, start + length)}
    return b" ".join(w for k, w in enumerate(words) if k not in gone)


def repetitive(rng, alphabet):
    words = []
    for _ in range(rng.randint(0, 6)):
        part = [b"%d" % rng.randint(0, alphabet) for _ in range(rng.randint(1, 30))]
        words += (part * rng.randint(1, 6))[:rng.randint(1, 120)]
    return words * rng.choice([1, 1, 2])


@pytest.mark.parametrize("least, weak", [(12, False), (12, True), (7, False), (2, False)])
def test_runs_of_random_texts(monkeypatch, least, weak):
    """Also with a hash that collides nearly always, which costs time only."""
    if weak:
        monkeypatch.setattr(runs.Tape, "hash", lambda self, start, end: (self.sums[end] - self.sums[start]) * self.down[start] % np.uint64(3))
    monkeypatch.setattr(runs, "PAIRS", 50)
    rng = random.Random(least + weak)
    for _ in range(20 if weak else 60):
        texts = [repetitive(rng, rng.choice([1, 2, 3, 30])) for _ in range(rng.randint(0, 5))]
        tape, found = runs.find_runs(texts, least)
        own = [[] for _ in texts]
        for start, end, q in found.tolist():
            k = tape.owner[start]
            own[k].append((start - int(tape.bounds[k]), end - start, q))
        assert own == [runs_brute(t, least) for t in texts]


def test_runs_of_a_long_text_take_linear_time():
    tape, found = runs.find_runs([[b"again"] * 300_000 + [b"x", b"y"] * 100_000])
    assert found.tolist() == [[0, 300_000, 1], [300_000, 500_000, 2]]


def test_runs_of_odd_rows(odd_docs, odd_rows, no_docs):
    found = runs.with_runs(odd_docs, column="found")
    assert found.columns == odd_docs.columns
    rows = Counter((r.doc_id, r.found.n_words, tuple(tuple(x) for x in r.found.runs), r.found.collapsed) for r in found.collect())
    expected = Counter()
    for i, t in odd_rows:
        words = WORD.findall((t or "").encode())
        own = runs_brute(words) if len(words) < 2000 else []
        expected[i, len(words), tuple(own), collapsed(words, own).decode()] += 1
    assert rows == expected
    assert runs.with_runs(no_docs).count() == 0


def test_op11_against_brute_force(spark):
    out = {r.doc_id: r for r in queries.op11_periodic_runs(spark, SMALL).collect()}
    docs = pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(out) == len(docs)
    planted = 0
    for d in docs:
        words = WORD.findall((d["text"] or "").encode())
        h, n = crc(d["doc_id"]), len(words)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words, planted = words[:a] + [words[a + (i - a) % p] for i in range(a, n)], planted + 1
        if n > 4000:
            continue
        found, r = runs_brute(words), out[d["doc_id"]]
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        assert (r.n_runs, r.start, r.length, r.period) == (len(found), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if found else None)
        assert r.runs_sha256 == digest("".join(f"{s},{m},{q}\n" for s, m, q in found))
        assert r.collapsed_sha256 == digest(collapsed(words, found))
    assert planted > 5


# Spelling variants

def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def variants_brute(counts, ratio=10):
    forms, out = {}, {}
    by_length = {}
    for w in counts:
        by_length.setdefault(len(w), []).append(w)
    close = {w: [x for m in (-1, 0, 1) for x in by_length.get(len(w) + m, []) if x != w and near(w, x)] for w in counts}
    for w, others in close.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        if best is not None and counts[best] >= ratio * counts[w]:
            forms[w] = best
    for w in counts:
        root = w
        while root in forms:
            root = forms[root]
        out[w] = (counts[w], len(close[w]), forms.get(w), counts.get(forms.get(w)), root)
    return out


def variants(spark, counts, **options):
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.spelling_variants(words, **options).collect()}


@pytest.mark.parametrize("limit", [10**9, 3], ids=["whole-blocks", "divided-blocks"])
def test_variants_of_random_words(spark, monkeypatch, limit):
    monkeypatch.setattr(spelling, "BRANCHES", 100)
    rng, counts = random.Random(5), {}
    for _ in range(250):
        word = "".join(rng.choice("abcéq") for _ in range(rng.randint(1, 9)))
        k = rng.randrange(len(word))
        for w in (word, word[:k] + word[k + 1:], word[:k] + rng.choice("abc\U0001F600") + word[k:], word[:k] + "b" + word[k + 1:]):
            if w:
                counts[w] = rng.choice([2, 3, 25, 300, 4000])
    counts["a" * 5000], counts["a" * 5001] = 2, 50
    assert variants(spark, counts, limit=limit) == variants_brute(counts)


def test_variants_of_nothing(spark):
    assert variants(spark, {}) == {}
    assert variants(spark, {"aaaaaaa": 2}) == {"aaaaaaa": (2, 0, None, None, "aaaaaaa")}
    with pytest.raises(ValueError):
        variants(spark, {"a": 1}, ratio=1)


def test_runs_of_letters_of_odd_rows(odd_docs, odd_rows):
    found = Counter(r[0] for r in odd_docs.select(F.explode(spelling.runs_of_letters(F.col("text"), 3))).collect())
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    assert found == Counter(w for _, t in odd_rows for w in re.findall("[A-Za-zÀ-ÿ]+", (t or "").translate(lower)) if len(w) >= 3)


def test_op12_against_brute_force(spark):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts = Counter()
    for d in pq.read_table(f"{SMALL}/documents.parquet", columns=["doc_id", "text"]).to_pylist():
        for w in re.findall("[A-Za-zÀ-ÿ]+", (d["text"] or "").translate(lower)):
            h = crc(f"{d['doc_id']}:{w}")
            if h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                counts[w] += 1
    expected = variants_brute({w: n for w, n in counts.items() if n >= 2})
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in queries.op12_spelling_variants(spark, SMALL).collect()} == expected


# Quality rules

def counts_brute(text):
    words, n = WORD.findall(text), len(WORD.findall(text))
    lines = [x for x in text.split(b"\n") if WORD.search(x)]
    seen = Counter(tuple(words[k:k + 8]) for k in range(n - 7))
    repeated = {j for k in range(n - 7) if seen[tuple(words[k:k + 8])] > 1 for j in range(k, k + 8)}
    return (n, sum(len(w.decode()) for w in words), sum(c in "#*$%&|<>" for c in text.decode()), len(lines) - len(set(lines)), len(repeated))


def test_op13_counts_against_brute_force_and_verdicts_on_held_out_rows(spark):
    out = {r.doc_id: r for r in queries.op13_quality_rules(spark, SF).collect()}
    docs = pq.read_table(f"{SF}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    assert len(out) == len(docs)
    for d in docs:
        r, c = out[d["doc_id"]], counts_brute((d["text"] or "").encode())
        assert tuple(r[k] for k in rules.COUNTS) == c
        assert r.base_failed == (c[0] < 20 or 100 * c[4] > 30 * c[0])
        assert not (r.base_failed and r.kept)
    held_out = [(r["quality"] == 1, out[r["doc_id"]]) for r in pq.read_table(f"{SF}/labels.parquet").to_pylist() if crc(r["doc_id"]) % 5 == 0]
    assert len(held_out) > 40
    right = [(r.score >= rules.CUT) == good for good, r in held_out]
    assert sum(right) / len(right) > 0.95


def test_rules_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    found = rules.with_rules(odd_docs, None, column="found")
    assert found.columns == odd_docs.columns
    rows = Counter((r.doc_id, *[r.found[c] for c in rules.COUNTS], r.found.kept) for r in found.collect())
    expected = Counter()
    for i, t in odd_rows:
        c = counts_brute((t or "").encode())
        expected[(i, *c, not (c[0] < 20 or 100 * c[4] > 30 * c[0]))] += 1
    assert rows == expected
    assert rules.with_rules(no_docs, None).count() == 0
    labels = spark.createDataFrame([(1, 1), (2, 1), (None, 0)], "doc_id bigint, quality int")
    assert rules.train(odd_docs, labels) is None


def test_trees_keep_their_constraints():
    rng = np.random.default_rng(3)
    x = rng.random((3000, len(rules.FEATURES)))
    # The labels pull against the constraint in a part of the range.
    wave = np.sin(9 * x[:, 2]) - 2 * x[:, 3] + x[:, 0] + rng.normal(0, 0.3, 3000)
    model = rules.fit_trees(x, wave > 0)
    assert ((model.score(x) >= 0.5) == (wave > 0)).mean() > 0.75
    free = rules.fit_trees(x, wave > 0, signs=0 * rules.SIGNS)
    probes = x[rng.integers(0, len(x), 400)]
    for f, sign in enumerate(rules.SIGNS):
        steps = []
        for v in np.linspace(0, 1, 40):
            probes[:, f] = v
            steps.append((model.margin(probes), free.margin(probes)))
        rising = np.diff([m for m, _ in steps], axis=0)
        if sign:
            assert (sign * rising >= -1e-9).all()
            if f == 2:
                assert (np.diff([m for _, m in steps], axis=0) > 1e-6).any()


def test_flat_trees_equal_a_walk_from_node_to_node():
    rng = np.random.default_rng(4)
    x = rng.random((200, len(rules.FEATURES)))
    model = rules.fit_trees(x, x[:, 1] + x[:, 4] > 1, trees=7)
    splits = (1 << model.depth) - 1
    for row, margin in zip(x, model.margin(x)):
        total = model.base
        for t in range(7):
            node = 0
            while node < splits:
                node = 2 * node + 1 + (row[model.feature[t * splits + node]] > model.threshold[t * splits + node])
            total += model.value[t * (splits + 1) + node - splits]
        assert total == pytest.approx(margin)


def test_repeated_words_with_colliding_hashes(monkeypatch):
    texts = [b"a b c d e f g h " * 3, b"a b c d e f g i a b c d e f g h", b"", b"x " * 20]
    expected = [counts_brute(t)[4] for t in texts]
    assert rules.statistics(texts)[0][:, 4].tolist() == expected
    monkeypatch.setattr(runs.Tape, "hash", lambda self, start, end: 0 * self.sums[end])
    assert rules.statistics(texts)[0][:, 4].tolist() == expected
