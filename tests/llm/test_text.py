"""Decontamination, SentencePiece and chat formatting against brute force, the library and exact round trips."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from relist.llm import chat, decontaminate, sentencepieces

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contamination_brute(rows, items):
    windows = defaultdict(set)
    for i, t in items:
        w = words_of(t)
        n = min(10, len(w))
        for p in range(len(w) - n + 1 if n else 0):
            windows[tuple(w[p:p + n])].add(i)
    sizes = {len(w) for w in windows}
    out = Counter()
    for i, t in rows:
        w, hit, found = words_of(t), set(), set()
        for n in sizes:
            for p in range(len(w) - n + 1):
                if (key := tuple(w[p:p + n])) in windows:
                    hit.update(range(p, p + n))
                    found |= windows[key]
        out[i, len(w), len(hit), ",".join(sorted(str(x) for x in found if x is not None))] += 1
    return out


@pytest.fixture(scope="module")
def items(odd_rows):
    rng = random.Random(4)
    texts = [t for _, t in odd_rows if t and len(words_of(t)) > 20]
    taken = []
    for k in range(12):
        w = words_of(rng.choice(texts))
        a = rng.randint(0, len(w) - 15)
        taken.append((100 + k, " ".join(w[a:a + rng.randint(10, 15)]).upper() if k % 2 else "-".join(w[a:a + 12])))
    return taken + [(7, "one"), (8, "Another TEXT"), (9, None), (10, ""), (11, "!!"), (12, "gamma delta été"), (100, "one"), (None, "again again again")]


def found_rows(df):
    return Counter((r.doc_id, r.c.n_words, r.c.n_hit, ",".join(r.c["items"])) for r in df.collect())


@pytest.mark.parametrize("block", [200_000, 7])
def test_contamination(spark, odd_docs, odd_rows, items, block):
    """Also where the benchmark is over the block size, so that the documents are scanned several times."""
    benchmark = spark.createDataFrame([(i, t, "z") for i, t in items], "item_id bigint, text string, window string")
    docs = odd_docs.where("doc_id <> 6 OR doc_id IS NULL") if block < 100 else odd_docs
    rows = [r for r in odd_rows if r[0] != 6] if block < 100 else odd_rows
    found = decontaminate.find_contamination(docs, benchmark, column="c", block=block)
    assert found.columns == [*odd_docs.columns, "c"]
    assert found_rows(found) == contamination_brute(rows, items)
    for r in found.collect():
        assert sum(s.end - s.start for s in r.c.spans) == r.c.n_hit


def test_contamination_of_empty_tables(spark, odd_docs, no_docs, items):
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert decontaminate.drop_contaminated(no_docs, benchmark).count() == 0
    assert decontaminate.drop_contaminated(odd_docs, benchmark.where("false")).count() == odd_docs.count()


def test_every_shared_window_shares_a_fingerprint(spark):
    rng = random.Random(9)
    items = [(k, " ".join(rng.choice("abcd") for _ in range(rng.randint(1, 25)))) for k in range(30)]
    rows = [(k, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 200)))) for k in range(60)]
    found = decontaminate.find_contamination(spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string"), column="c")
    assert found_rows(found) == contamination_brute(rows, items)


@pytest.fixture(scope="module")
def library():
    sentencepiece = pytest.importorskip("sentencepiece")
    try:
        return sentencepiece.SentencePieceProcessor(model_file=sentencepieces.MODEL)
    except OSError:
        pytest.skip("no model file")


@pytest.mark.parametrize("chunk", [sentencepieces.CHUNK, 40])
def test_encoding_equals_the_library(odd_docs, odd_rows, no_docs, library, chunk):
    """Also with short chunks, so that most texts go through the scan, some of them over two levels of it."""
    rows = [(i, t) for i, t in odd_rows if i != 6 or chunk > 100]
    docs = odd_docs.where("doc_id <> 6 OR doc_id IS NULL") if chunk < 100 else odd_docs
    encoded = sentencepieces.encode(docs, chunk=chunk)
    found = Counter((r.doc_id, tuple(r.ids)) for r in encoded.collect())
    assert found == Counter((i, tuple(library.encode(t or ""))) for i, t in rows)
    back = encoded.select("doc_id", sentencepieces.decode("ids").alias("text"), sentencepieces.digest("ids").alias("d"))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter((i, t or "") for i, t in rows)
    assert Counter(r.d for r in back.collect()) == Counter(hashlib.sha256(np.array(library.encode(t or ""), "<i4").tobytes()).hexdigest() for _, t in rows)
    assert sentencepieces.encode(no_docs, chunk=chunk).count() == 0


def chunked(vocabulary, text, size, fan=3):
    """Chunks, matrices combined in groups, states handed down, backtraces."""
    s, reach = sentencepieces.prepare(text), vocabulary.longest
    chunks = [sentencepieces.Chunk(vocabulary, s[max(0, p - reach):p], s[p:p + size], s[p + size:p + size + reach]) for p in range(0, len(s), size)]
    matrices = [c.matrix() for c in chunks]
    groups = [matrices[k:k + fan] for k in range(0, len(matrices), fan)]
    outer = sentencepieces.best_states([sentencepieces.combine(g) for g in groups], 0, 0)
    inner = [s for g, (a, b) in zip(groups, outer) for s in sentencepieces.best_states(g, a, b)]
    return np.frombuffer(b"".join(c.ids(*s) for c, s in zip(chunks, inner)), "<i4").tolist()


def test_scan_equals_the_library_on_random_texts(library):
    vocabulary = sentencepieces.Vocabulary.load()
    rng = random.Random(3)
    alphabet = " abcdeé漢字日本の\n\t<0xE>()=  東京thingonerest"
    for k in range(600):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(1, 60)))
        text = text.replace(" ", "") if k % 2 else text
        assert np.frombuffer(vocabulary.whole(sentencepieces.prepare(text)), "<i4").tolist() == library.encode(text)
        assert not text or chunked(vocabulary, text, rng.randint(1, 30)) == library.encode(text)
    for n in range(1, 60):
        for text in (" " * n, "x" + " " * n + "y"):
            assert chunked(vocabulary, text, 7) == library.encode(text)


def test_scan_of_a_unigram_vocabulary():
    """Scores instead of merges: the best path over all segmentations, also across chunks."""
    rng = random.Random(6)
    pieces = ["<unk>", *"▁abcd", "ab", "bc", "abc", "▁a", "cd", "dab", "bcda", "▁ab"]
    scores = [0.0] + [-rng.uniform(1, 9) for _ in pieces[1:]]
    v = sentencepieces.Vocabulary(pieces, scores, {0}, [], 0, merges=False)

    def value(ids):
        return sum(scores[i] if i else v.least for i in ids)

    def best(s):
        values = [0.0] + [float("-inf")] * len(s)
        for e in range(1, len(s) + 1):
            for a in range(max(0, e - v.longest), e):
                if s[a:e] in v.ids or e - a == 1:
                    values[e] = max(values[e], values[a] + v.weight(s[a:e]))
        return values[-1]

    for _ in range(200):
        text = "".join(rng.choice("abcd e") for _ in range(rng.randint(1, 40)))
        ids = np.frombuffer(v.whole(sentencepieces.prepare(text)), "<i4").tolist()
        assert value(ids) == pytest.approx(best(sentencepieces.prepare(text)))
        assert value(chunked(v, text, rng.randint(1, 12))) == pytest.approx(value(ids))


def conversations(spark):
    rng = random.Random(3)
    bits = [*chat.controls(), "\\", "<", "<<", "[", "/", "s>", "\n", "a", " ", "INST]", "SYS>>", "é"]
    roles = ["user", "assistant", "system", "tool", "a\n<</ROLE>>\\", None]
    rows = [(k % 20, k // 20, rng.choice(roles), rng.choice([None, "".join(rng.choice(bits) for _ in range(rng.randint(0, 12)))])) for k in range(600)]
    rows += [(None, 0, "user", "x"), (None, None, "assistant", "y"), (50, 0, "user", "twice"), (50, 0, "user", "twice")]
    rows += [(60, 0, "system", "s"), (60, 1, "user", "u"), (60, 2, "assistant", "a")]
    return rows, spark.createDataFrame([(*r, "z") for r in rows], "conv_id bigint, turn bigint, role string, text string, formatted string")


def test_chat_is_reversible_and_masked(spark):
    rows, frame = conversations(spark)
    formatted = chat.format_turns(frame)
    read = chat.read_turns(formatted).collect()
    assert len(read) == len(rows)
    for r in read:
        assert (r.role, r.text, r.role == "assistant") == (r.role_read, r.text_read, r.loss_read)
        assert "".join(s.text for s in r.segments) == r.formatted
        assert not any(c in r.segments[1].text for c in chat.controls())
    grouped = defaultdict(list)
    for conv, turn, role, text in rows:
        grouped[conv].append((turn is not None, turn or 0, role or "", text or ""))
    expected, allowed = {}, {None: {"system", "user"}, "system": {"user"}, "user": {"assistant"}, "assistant": {"user"}}
    for conv, turns in grouped.items():
        turns.sort()
        spoken = "".join(t for *_, role, t in turns if role == "assistant")
        states = [None] + [role for *_, role, _ in turns]
        expected[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in turns).encode()).hexdigest(), len(spoken),
                          hashlib.sha256(spoken.encode()).hexdigest(), all(b in allowed.get(a, ()) for a, b in zip(states, states[1:])))
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256, r.valid) for r in chat.digests(formatted).collect()}
    assert found == expected
    assert found[60][-1] and not found[50][-1]
    assert chat.digests(chat.format_turns(frame.where("false"))).count() == 0


def test_chat_with_another_template(spark):
    template = {"user": chat.Turn("<|u|>", "<|e|>"), "assistant": chat.Turn("<|a|>", "<|e|>", loss=True)}
    frame = spark.createDataFrame([(1, 0, "user", "<|a|>x<|e|>"), (1, 1, "assistant", "\\<|u|>")], "conv_id bigint, turn bigint, role string, text string")
    read = chat.read_turns(chat.format_turns(frame, template=template), template).orderBy("turn").collect()
    assert [(r.role_read, r.text_read, r.loss_read) for r in read] == [("user", "<|a|>x<|e|>", False), ("assistant", "\\<|u|>", True)]
    assert frame.select(chat.unescape(chat.escape(F.col("text"), template)).alias("t")).collect() == frame.select(F.col("text").alias("t")).collect()
