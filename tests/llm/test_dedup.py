"""Exact, near and substring dedup against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from relist.llm import components as links_of
from relist.llm import decontaminate, exact, simhash, substring
from relist.llm.components import smallest_reachable

SF = "/root/testdata/sf0.001"


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def rows_of(df, *columns):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def exact_brute(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[normal(t)].append(i)
    out = Counter()
    for i, t in rows:
        own = groups[normal(t)]
        keep = min((x for x in own if x is not None), default=None)
        out[i, keep, len(own), i == keep, hashlib.sha256(normal(t).encode()).hexdigest()] += 1
    return out


COLUMNS = ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_exact_groups(odd_docs, odd_rows):
    assert rows_of(exact.exact_groups(odd_docs), *COLUMNS) == exact_brute(odd_rows)


def test_exact_with_colliding_chunk_hashes(odd_docs, odd_rows, monkeypatch):
    """Identifiers are verified: a hash that nearly always collides changes no group."""
    monkeypatch.setattr(exact, "MIN_CHUNK", 8)
    monkeypatch.setattr(exact, "MAX_CHUNK", 64)
    weak = exact.exact_groups(odd_docs, chunk_hash=lambda c: F.length(c).cast("long") % 3)
    assert rows_of(weak, *COLUMNS) == exact_brute(odd_rows)


def test_exact_chunks_join_to_the_text(odd_docs):
    made = odd_docs.select(exact.normalise(F.col("text")).alias("t")).select("t", F.concat_ws("", exact.chunks(F.col("t"))).alias("c"))
    assert made.where("t <> c").count() == 0


def test_drop_exact_copies(odd_docs, odd_rows, no_docs):
    kept = exact.drop_exact_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    expected = Counter({(i, digest) for i, _, _, stays, digest in exact_brute(odd_rows) if stays})
    assert Counter((r.doc_id, hashlib.sha256(normal(r.text).encode()).hexdigest()) for r in kept.collect()) == expected
    assert exact.drop_exact_copies(no_docs).count() == 0


def test_one_row_stays_where_ids_repeat_or_are_missing(spark):
    """Groups whose smallest id stands on several rows, with equal and with slightly different texts, and groups without ids."""
    base = " ".join(f"w{k}" for k in range(400))
    near = [base, base + " w400", f"w0 {base}"]
    rows = [(None, "same text"), (None, "same  text"), (7, "other"), (7, "other"), (9, "other"), (None, "other"), (5, base), (5, near[1]), (5, near[1]), (6, near[2]),
            (None, "alone in its group " * 9), (None, "alone in its group " * 9)]
    docs = spark.createDataFrame([(i, t, k, {"a": k}) for k, (i, t) in enumerate(rows)], "doc_id bigint, text string, __row int, times map<string,int>")
    kept = exact.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter([None, 7, 5, 5, 6, None])
    fewer = simhash.drop_near_copies(docs)
    assert fewer.columns == docs.columns
    assert Counter(r.doc_id for r in fewer.collect()) == Counter([None, 7, 5, None])


def simhash_brute(rows):
    prints = []
    for _, t in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        shingles = [b" ".join(words[k:k + 4]) for k in range(len(words) - 3)] or ([b" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
        prints.append(sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)))
    return prints, components(prints)


def components(prints, bits=4):
    root = {p: p for p in prints}
    kinds = sorted(root)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for k, a in enumerate(kinds):
        for b in kinds[k + 1:]:
            if (a ^ b).bit_count() <= bits:
                root[find(b)] = find(a)
    return {p: find(p) for p in kinds}


def test_near_groups(odd_docs, odd_rows, no_docs):
    prints, root = simhash_brute(odd_rows)
    first = {}
    for (i, _), p in zip(odd_rows, prints):
        if i is not None:
            first[root[p]] = min(i, first.get(root[p], i))
    expected = Counter((i, f"{p:016x}", first.get(root[p])) for (i, _), p in zip(odd_rows, prints))
    assert rows_of(simhash.near_groups(odd_docs), "doc_id", "fingerprint", "component_id") == expected
    kept = simhash.drop_near_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    # One row for each component, whatever its ids.
    assert Counter(r.doc_id for r in kept.collect()) == Counter(first.get(r) for r in set(root.values()))
    assert simhash.near_groups(no_docs).count() == simhash.drop_near_copies(no_docs).count() == 0


@pytest.mark.parametrize("limit", [1024, 2])
def test_near_links_connect_what_brute_force_does(spark, limit):
    """Also where nearly every posting list is over the limit, so that links come from the values in between."""
    rng = random.Random(limit)
    prints = {0, (1 << 64) - 1}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(12):
            p = centre
            for b in rng.sample(range(64), rng.randint(0, 5)):
                p ^= 1 << b
            prints.add(p)
    signed = {p: p - (1 << 64) if p >> 63 else p for p in prints}
    links = simhash.near_links(spark.createDataFrame([(s,) for s in signed.values()], "fp bigint"), limit)
    for a, b in links.collect():
        assert ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 4 * len(prints)
    root = {r.node: r.root for r in smallest_reachable(links).collect()}
    brute = components(sorted(prints))
    found, expected = defaultdict(set), defaultdict(set)
    for p, s in signed.items():
        found[root.get(s, s)].add(p)
        expected[brute[p]].add(p)
    assert sorted(map(sorted, found.values())) == sorted(map(sorted, expected.values()))


def test_fingerprint_of_a_long_text_in_parts(monkeypatch):
    text = " ".join(f"w{k % 997}" for k in range(3000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "pieces", lambda t: _parts(t, 700))
    assert simhash.fingerprint(text) == whole


def _parts(text, size):
    from relist.llm.common import pieces

    return pieces(text, size)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501), (501, 500), (7, 7)], "a bigint, b bigint")
    found = {r.node: r.root for r in smallest_reachable(links).collect()}
    assert found == {k: 0 for k in range(1, 201)} | {501: 500}


def substring_brute(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[p:p + 35]) for w in words for p in range(len(w) - 34))
    out = Counter()
    for (i, _), w in zip(rows, words):
        gone = {q for p in range(len(w) - 34) if seen[tuple(w[p:p + 35])] > 1 for q in range(p, p + 35)}
        out[i, len(w), len(gone), " ".join(x for q, x in enumerate(w) if q not in gone)] += 1
    return out


def test_substring_dedup(odd_docs, odd_rows, no_docs):
    assert rows_of(substring.drop_repeats(odd_docs), "doc_id", "n_words", "n_removed", "kept") == substring_brute(odd_rows)
    assert substring.drop_repeats(no_docs).count() == 0


def test_substring_dedup_of_random_overlaps(spark):
    """Few words and copied stretches of all lengths around the window, so that repeats begin and end everywhere."""
    rng = random.Random(2)
    base = [rng.choice("abc") for _ in range(600)]
    rows = []
    for k in range(60):
        words = [rng.choice("abc") for _ in range(rng.randint(0, 40))]
        for _ in range(rng.randint(0, 3)):
            a = rng.randint(0, 560)
            words += base[a:a + rng.randint(20, 60)] + [rng.choice("abcd") for _ in range(rng.randint(0, 5))]
        rows.append((k, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert rows_of(substring.drop_repeats(docs), "doc_id", "n_words", "n_removed", "kept") == substring_brute(rows)


def test_window_minima():
    from relist.llm.common import window_minima

    rng = np.random.default_rng(1)
    for width in (1, 2, 3, 6, 24):
        x = rng.integers(0, 6, 100).astype(np.uint64)
        expected = [k + width - 1 - int(np.argmin(x[k:k + width][::-1])) for k in range(len(x) - width + 1)]
        assert window_minima(x, width).tolist() == expected
        assert not len(window_minima(x[:width - 1], width))


def test_words_made_to_collide_are_different_words(spark):
    """Two words of 1,024 letters whose sums of letters times powers of any odd number agree modulo 2^64 (as the signs alternate
    like the bits of a number are odd or even) in the middle of two else equal documents."""
    signs = [bin(k).count("1") % 2 for k in range(1024)]
    one, two = ("".join("ab"[s ^ flip] for s in signs) for flip in (0, 1))
    rows = [(k, " ".join([f"w{j}" for j in range(17)] + [word] + [f"w{j}" for j in range(18, 35)])) for k, word in enumerate((one, two))]
    done = substring.drop_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"))
    assert [r.n_removed for r in done.collect()] == [0, 0]
    assert len(np.unique(substring.word_keys([one.encode(), two.encode(), one.encode()]), axis=0)) == 2


def explodes_broadcast(frame):
    """Whether the plan of a frame broadcasts what an explode gives, which Spark sizes as if each row stayed one."""
    plan = frame._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = [len(re.match(r"[\s:|+-]*", line)[0]) for line in plan]
    for at, line in enumerate(plan):
        if "BroadcastExchange" in line:
            below = [x for x, d in zip(plan[at + 1:], depth[at + 1:])][:next((k for k, d in enumerate(depth[at + 1:]) if d <= depth[at]), None)]
            if any("Generate explode" in x for x in below):
                return True
    return False


def written_plans(monkeypatch, *modules):
    frames = []
    for m in modules:
        monkeypatch.setattr(m, "materialize", lambda df, name, write=m.materialize: (frames.append((name, df)), write(df, name))[1])
    return frames


def test_postings_are_not_broadcast(spark, monkeypatch):
    """The file of the fingerprints is far below the limit of a broadcast, the postings made of it need not be."""
    frames = written_plans(monkeypatch, simhash)
    simhash.near_links(simhash.materialize(spark.range(2000).select(F.xxhash64("id").alias("fp")), "fps"))
    assert "postings" in dict(frames) and not any(explodes_broadcast(df) for _, df in frames)


def test_the_pipeline_broadcasts_nothing_it_has_exploded(spark, monkeypatch):
    frames = written_plans(monkeypatch, corpus_pipeline, links_of, decontaminate, exact, simhash)
    out = corpus_pipeline.run(spark, SF)
    assert {"postings", *[name for name, _ in corpus_pipeline.STAGES[:-1]]} <= {name for name, _ in frames}
    assert not any(explodes_broadcast(df) for df in (*[df for _, df in frames], out))
