"""Classifiers by held-out accuracy, pseudonyms by their formats and their way back, the pipeline stage by stage."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter
from datetime import date, datetime, timedelta
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from relist.llm import decontaminate, langid, licences, pii, quality, queries
from relist.llm.common import pieces
from relist.session import materialize

SF = "/root/testdata/sf0.01"
given_tables = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


def test_permutations():
    p = pii.Permutation(b"key")
    for size in (1, 2, 3, 10, 97, 1000):
        assert sorted(p.forward("x", size, k) for k in range(size)) == list(range(size))
    for size in (10**15, 1 << 32, 73_049):
        values = random.Random(size).sample(range(size), 200)
        mapped = [p.forward("x", size, v) for v in values]
        assert len(set(mapped)) == 200 and all(0 <= m < size for m in mapped) and [p.backward("x", size, m) for m in mapped] == values
    assert p.forward("x", 10**9, 5) != pii.Permutation(b"other").forward("x", 10**9, 5)


PRIVATE = ("Card 4111 1111 1111 1111, 4111111111111112, ssn 123-45-6789 000-12-1234, ip 10.0.0.300 10.1.2.3, 2024-02-30 2024-02-29 29.2.2024 02/29/2024, "
           "+1 (017) 555-7713 97.51.17.173, DE89 3704 0044 0532 0130 00 a.b@c.de token=04dbebab91ab85687d33eeaaf9ac699e1188f962. 12345678-1234 v1.2.3.4.5")


def test_pseudonyms_keep_format_and_link():
    p = pii.Permutation(b"key")
    new, spans = pii.pseudonymise(PRIVATE, p.forward)
    assert [s["kind"] for s in spans] == ["card", "ssn", "ip", "date", "date", "date", "phone", "ip", "iban", "email", "secret"]
    assert re.sub("[0-9]", "0", new[:24]) == re.sub("[0-9]", "0", PRIVATE[:24])
    assert "4111111111111112" in new and "000-12-1234" in new and "10.0.0.300" in new and "2024-02-30" in new
    at = {s["kind"]: new[s["start"]:s["end"]] for s in spans}
    card = re.sub(" ", "", at["card"])
    assert pii._luhn(card[:-1]) == int(card[-1])
    days = [new[s["start"]:s["end"]] for s in spans if s["kind"] == "date"]
    assert days[0] == "-".join(f"{int(x):02d}" for x in reversed(days[1].split("."))) and days[2].split("/")[2] == days[0][:4]
    assert pii.pseudonymise("x 4111111111111111", p.forward)[0].endswith(card)
    assert pii.pseudonymise(new, p.backward)[0] == PRIVATE


def test_pseudonyms_behind_a_failed_candidate():
    p = pii.Permutation(b"key")
    card, iban = "4111 1111 1111 1111", "BE68 5390 0754 7034"
    for text, value, kind in ((f"order 1234 {card}", card, "card"), (f"1234-{card.replace(' ', '-')}", card.replace(" ", "-"), "card"), (f"0000 1234 {card}.", card, "card"),
                              (f"{iban} PAID", iban, "iban"), (f"{iban} IS PAID NOW OK", iban, "iban"), (f"AB13 {iban} {iban}", iban, "iban"),
                              (f"{iban.replace(' ', '')} PAID", iban.replace(" ", ""), "iban"), ("+44 2079 4609 5812 3412", "+44 2079 4609 5812 3412", "phone")):
        new, spans = pii.pseudonymise(text, p.forward)
        assert {s["kind"] for s in spans} == {kind} and value not in new and pii.pseudonymise(new, p.backward)[0] == text
        assert len({new[s["start"]:s["end"]] for s in spans}) == 1
    for text in ("12345678-1234", "v1.2.3.4.5", "10.0.0.300", "000-12-1234", "BE68 5390 0754 7035 PAID", "1234 1234 1234 1234 1234"):
        assert pii.pseudonymise(text, p.forward) == (text, [])


def test_phone_forms_are_linked():
    p = pii.Permutation(b"key")
    for forms in (["+15551234567", "+1 555 123 4567", "+1 (555) 123-4567", "+1-555-123-4567", "+1.555.123.4567"],
                  ["+442079460958", "+44 20 7946 0958", "+44 (0)20 7946 0958", "+44-20-7946-0958"], ["+35312345678", "+353 1234 5678", "+353-12-34-56-78"], ["+74951234567", "+7 495 123 4567"]):
        done = [pii.pseudonymise(f"call {f} now", p.forward) for f in forms]
        assert all([s["kind"] for s in spans] == ["phone"] for _, spans in done)
        made = [new[5:-4] for new, _ in done]
        assert len({re.sub(r"[^+0-9]", "", m.replace("(0)", "")) for m in made}) == 1
        assert [re.sub("[0-9]", "0", m) for m in made] == [re.sub("[0-9]", "0", f) for f in forms] and made[0][:2] == forms[0][:2] and made[0] != forms[0]
        assert [pii.pseudonymise(new, p.backward)[0] for new, _ in done] == [f"call {f} now" for f in forms]


#: Forms that hold a value, with the kind, and the form of the same value whose pseudonym must be the same.
FORMS = [
    ("25/12/2023", "date", "2023-12-25"), ("31-12-1999", "date", "31.12.1999"), ("12-31-1999", "date", "12/31/1999"), ("1999/12/31", "date", "1999-12-31"),
    ("3 March 1999", "date", "1999-03-03"), ("March 3, 1999", "date", "3 Mar 1999"), ("May 9 2001", "date", "9 May 2001"), ("05 Sep 1987", "date", "1987-09-05"), ("5.9.1987", "date", "05.09.1987"), ("5/13/1987", "date", "1987-05-13"),
    ("(555) 123-4567", "phone", "+1 555 123 4567"), ("555-123-4567", "phone", "+15551234567"), ("123 45 6789", "ssn", "123-45-6789"),
    ("be68 5390 0754 7034", "iban", "BE68 5390 0754 7034"), ("2001:db8::1", "ip", "2001:0DB8:0:0:0:0:0:1"), ("fe80::1ff:fe23:4567:890a", "ip", "fe80:0:0:0:1ff:fe23:4567:890a")]


@pytest.mark.parametrize("value, kind, other", FORMS)
def test_forms_of_one_value_are_linked(value, kind, other):
    p = pii.Permutation(b"key")
    text = f"see {value} there"
    new, spans = pii.pseudonymise(text, p.forward)
    assert [s["kind"] for s in spans] == [kind] and value not in new
    assert pii.pseudonymise(new, p.backward)[0] == text
    # Back again, in the other form: the pseudonym of the other form holds the same value.
    hidden, _ = pii.pseudonymise(other, p.forward)
    shown = new[4:-6]
    if kind == "date":
        read = lambda x: next(d for d in written_days(x))
        assert read(shown) == read(hidden)
    elif kind == "ip":
        assert shown.lower() == hidden.lower()
    else:
        digits = lambda x: re.sub(r"\W", "", x).lower()
        assert digits(hidden).endswith(digits(shown))


def written_days(text):
    for form in ("%Y-%m-%d", "%Y/%m/%d", "%d.%m.%Y", "%m/%d/%Y", "%d/%m/%Y", "%d-%m-%Y", "%m-%d-%Y", "%d %B %Y", "%d %b %Y", "%B %d, %Y", "%B %d %Y"):
        try:
            yield datetime.strptime(text, form).date()
        except ValueError:
            pass


@pytest.mark.parametrize("text", [
    "31/31/2023", "2023/13/01", "2023-12/01", "000 12 3456", "123 45-6789", "std::vector a::b ::1 12:30:45 beef::cafe", "42 March 1999", "3 Marching 1999",
    "be68 5390 0754 7035", "in12 word that then", "1555-123-4567", "555-123-45678"])
def test_what_is_no_value_stays(text):
    assert pii.pseudonymise(text, pii.Permutation(b"key").forward) == (text, [])


def test_days_are_permuted_among_those_that_look_the_same():
    p, days = pii.Permutation(b"key"), [date(1900, 1, 1), date(2099, 12, 31), date(2000, 2, 29), date(1999, 6, 12), date(1999, 6, 13)]
    days += [date(2010, 1, 1) + timedelta(k) for k in range(400)]
    new = [pii._other_day(d, p.forward) for d in days]
    assert len(set(new)) == len(days)
    assert [pii._look(n) for n in new] == [pii._look(d) for d in days]
    assert min(len(x) for x in pii._days()[0].values()) == 1800
    assert [pii._other_day(n, p.backward) for n in new] == days


def test_pseudonyms_of_odd_rows(odd_docs, odd_rows, no_docs):
    done = pii.with_pseudonyms(odd_docs, b"key")
    assert done.columns == [*odd_docs.columns, "private"]
    assert Counter((r.doc_id, r.private.text) for r in done.collect()) == Counter(odd_rows)
    assert pii.with_pseudonyms(no_docs, b"key").count() == 0


def test_language_of_odd_rows(odd_docs, odd_rows, no_docs):
    done = langid.with_language(odd_docs, langid.train(odd_docs)).collect()
    assert len(done) == len(odd_rows)
    for r in done:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.language.nearest == "und") == (not letters) and 0 <= r.language.score <= 1
    assert {r.language.nearest for r in langid.with_language(odd_docs, langid.train(no_docs)).collect()} == {"und"}
    assert langid.with_language(no_docs, langid.train(odd_docs)).count() == 0


def test_far_texts_are_rejected(spark):
    rng = random.Random(1)
    def text(letters):
        return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(80))
    docs = spark.createDataFrame([(text("aeioust"), "x") for _ in range(40)] + [(text("bcdfghk"), "y") for _ in range(40)], "text string, lang string")
    model = langid.train(docs)
    probe = spark.createDataFrame([("x", text("aeioust")), ("y", text("bcdfghk")), ("und", text("zqwjvпрст"))], "want string, text string")
    assert [r.language.lang for r in langid.with_language(probe, model).collect()] == ["x", "y", "und"]


@given_tables
def test_language_held_out(spark):
    known = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect())
    rows = queries.op2_language_id(spark, SF).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert {r.doc_id for r in rows if r.held_out} == {r.doc_id for r in held}
    assert np.mean([r.lang_pred == known[r.doc_id] for r in held]) > 0.97


@given_tables
def test_quality_held_out(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = queries.op6_quality_ranking(spark, SF).collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    assert {r.doc_id for r in rows if r.held_out} == {r.doc_id for r in held}
    right = [(r.predicted == labels[r.doc_id]) for r in held if r.doc_id in labels]
    assert len(right) > 40 and np.mean(right) > 0.97
    assert all((r.score >= 0.3) == bool(r.predicted) and 0 <= r.score <= 1 for r in rows)


def test_quality_of_odd_rows(spark, odd_docs, odd_rows, no_docs):
    labels = spark.createDataFrame([(k, k % 2) for k in range(10, 50)] + [(10, None), (10, 5), (None, 1), (999, 1)], "doc_id bigint, quality int")
    model = quality.train(odd_docs, labels)
    scored = quality.with_score(odd_docs, model)
    assert scored.columns == [*odd_docs.columns, "score"] and scored.where("score BETWEEN 0 AND 1").count() == len(odd_rows)
    assert quality.drop_refused(odd_docs, model).columns == odd_docs.columns
    none = quality.train(odd_docs, labels.where("false"))
    assert [r.score for r in quality.with_score(odd_docs, none).collect()] == pytest.approx([quality.CUT] * len(odd_rows))
    assert quality.with_score(no_docs, model).count() == 0


def test_features_of_a_long_text_in_parts(monkeypatch):
    text = ("Some words, some MORE words.\n" * 400).encode()
    whole = quality.features(text)
    monkeypatch.setattr(quality, "pieces", lambda t: [t[:5800], t[5800:]])
    assert np.abs(quality.features(text) - whole)[[k for k, n in enumerate(quality.FEATURES) if n not in ("distinct", "repeated")]].max() < 1e-9


def test_all_features_of_a_long_text_in_parts(monkeypatch):
    """Repetition too is that of the whole text, however its parts are cut; one word more moves it by that word."""
    for words in ("Some words, some MORE words.\n", "junk junk 漢字 ", " again"):
        text = (words * 300).encode()
        whole = quality.features(text)
        for size in (1, 40, 1000, len(text) - 3):
            with monkeypatch.context() as m:
                m.setattr(quality, "pieces", lambda t, n=size: pieces(t, n))
                assert np.abs(quality.features(text) - whole).max() < 1e-9
    long = b"junk " * ((1 << 20) // 5 + 1)
    assert np.abs(quality.features(long + b"end") - quality.features(long)).max() < 0.05


@given_tables
def test_licences_of_given_rows(spark):
    """Every notice in the given texts is found, as a plain search for its words finds it."""
    notices = {f: [" ".join(licences.clean(n.encode()).decode().split()) for n in ns] for f, ns in licences.NOTICES.items()}
    texts = dict(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect())
    for r in queries.op10_licence_scan(spark, SF).collect():
        words = " " + " ".join(licences.clean(texts[r.doc_id].encode()).decode().split()) + " "
        assert set(r.families.split(",")) - {""} == {f for f, ns in notices.items() if any(f" {n} " in words for n in ns)}


def test_licences_of_odd_rows(spark, odd_docs, no_docs):
    model = licences.train(odd_docs)
    notice = "Licensed under the Apache License, Version 2.0."
    rows = [(1, None, 0, []), (2, "", 0, []), (3, "\n \n", 0, []), (4, notice, 1, ["apache-2.0"]), (5, f"alpha beta\n\n{notice}\n{notice.upper()}", 3, ["apache-2.0"] * 2),
            (6, "alpha gamma delta " * 200 + notice + " beta gamma" * 300, 1, ["apache-2.0"]), (7, "Released under the MIT License. " + notice, 1, None)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    for r, (_, _, paragraphs, families) in zip(licences.with_licences(docs, model).orderBy("doc_id").collect(), rows):
        assert r.licences.paragraphs == paragraphs
        if families is not None:
            assert [f.family for f in r.licences.finds if f.confirmed] == families
    assert not any(f.confirmed for r in licences.with_licences(odd_docs, model).collect() for f in r.licences.finds)
    assert licences.with_licences(no_docs, licences.train(no_docs)).count() == 0


def test_licences_of_a_long_text_in_parts():
    """Parts of any size give what the whole text gives, also where a notice or a line goes over a cut."""
    rng = random.Random(2)
    words = ["alpha", "beta", "gamma", "delta", "--", "eps"]
    def filler(n):
        return " ".join(rng.choice(words) for _ in range(n))
    model = licences.fit([filler(30).encode() for _ in range(60)])
    notice = licences.NOTICES["apache-2.0"][1].encode()
    for cut in ((1 << 20) - 60, (1 << 20) - 90):
        for end in (b" ", b"\n"):
            text = b"alpha beta gamma delta " * (cut // 23 + 1)
            n, found = licences.scan(text[:cut - 3] + end + notice + b" " + text[:2300] + b"\nbeta", model)
            assert n == 2 + (end == b"\n") and [(f["paragraph"], f["family"], f["confirmed"]) for f in found if f["confirmed"]] == [(n - 2, "apache-2.0", True)]
    notices = [n for ns in licences.NOTICES.values() for n in ns]
    total = 0
    for _ in range(12):
        bits = [x for _ in range(rng.randint(1, 9)) for x in (filler(rng.randint(0, 150)), rng.choice(notices), filler(rng.randint(0, 60)), rng.choice([" ", "\n", " \n", "\n\n", "   ...   " * 40]))]
        text = " ".join(bits).encode()
        paragraphs, finds = licences.scan(text, model)
        assert paragraphs == sum(bool(licences.clean(x).split()) for x in text.split(b"\n"))
        total += len(finds)
        for size in (1, 7, 100, 300, 1000, 3000):
            n, found = licences.scan(text, model, size)
            assert n == paragraphs and [(f["paragraph"], f["family"], f["confirmed"]) for f in found] == [(f["paragraph"], f["family"], f["confirmed"]) for f in finds]
    assert total > 10


def test_licences_of_two_families_in_a_line():
    model = licences.fit([b"alpha beta gamma delta epsilon"] * 20)
    def families(text):
        return sorted(f["family"] for f in licences.scan(text.encode(), model)[1] if f["confirmed"])
    apache = "Licensed under the Apache License, Version 2.0."
    assert families("Released under the MIT License. " + apache) == ["apache-2.0", "mit"] == families(apache + " Released under the MIT License.")
    for family, notices in licences.NOTICES.items():
        for notice in notices:
            assert families(notice) == [family]
    gpl = "This work is licensed under the GNU General Public License, version "
    assert families(gpl + "2. " + gpl + "3.") == ["gpl-2.0", "gpl-3.0"]
    assert len(families(gpl)) == 1


@given_tables
def test_pipeline_stage_by_stage(spark):
    """Each stage keeps exactly what its operator's own result says, with the columns of documents."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality_ranking", "exact_dedup", "simhash_dedup", "benchmark_decontamination", "sentencepiece_tokens"]
    ids = {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, before, SF), "stage")
        ids[name] = {r.doc_id for r in after.select("doc_id").collect()}
        if name != "sentencepiece_tokens":
            assert after.columns == columns
            before = after
    refused = {r.doc_id for r in queries.op6_quality_ranking(spark, SF).where("predicted = 0").collect()}
    assert ids["quality_ranking"] == {r.doc_id for r in docs.collect()} - refused
    kept = {}
    texts = {r.doc_id: r.text for r in docs.collect()}
    for i in sorted(ids["quality_ranking"]):
        kept.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    assert ids["exact_dedup"] == set(kept.values())
    from test_dedup import simhash_brute
    rows = sorted((i, texts[i]) for i in ids["exact_dedup"])
    prints, root = simhash_brute(rows)
    first = {}
    for (i, _), p in zip(rows, prints):
        first.setdefault(root[p], i)
    assert ids["simhash_dedup"] == set(first.values())
    from test_text import contamination_brute
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hits = contamination_brute([(i, texts[i]) for i in ids["simhash_dedup"]], items)
    assert ids["benchmark_decontamination"] == {i for i, _, n_hit, _ in hits if not n_hit} == ids["sentencepiece_tokens"]


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.createDataFrame([(1, "some words here", 1.5, 2, "x"), (2, None, None, None, None)], "doc_id bigint, text string, __score double, __Contamination int, _score string")
    model = quality.fit_ranking(np.zeros((0, len(quality.FEATURES))), np.zeros((0, len(quality.FEATURES))), 0.0)
    benchmark = spark.createDataFrame([(1, "nothing of it")], "item_id bigint, text string")
    for kept in (quality.drop_refused(docs, model), decontaminate.drop_contaminated(docs, benchmark)):
        assert kept.columns == docs.columns
        assert sorted(map(str, kept.collect())) == sorted(map(str, docs.collect()))


def test_a_language_of_copies_keeps_its_centroid(spark):
    """Eight languages of one text each, copied 2,000 times, and one of many texts: every one is learnt, from one row a text."""
    words = ["alpha beta", "gamma delta", "один два", "τρία τέσσερα", "fünf sechs", "sept huit", "nove dez", "tien elf"]
    rows = spark.range(2000).select(F.explode(F.array(*[F.struct(F.lit(f"l{k}").alias("lang"), F.lit(f"{w} " * 9).alias("text")) for k, w in enumerate(words)])).alias("r")).select("r.*")
    many = spark.range(3000).select(F.lit("many").alias("lang"), F.concat(F.lit("zz yy xx ww "), F.col("id").cast("string")).alias("text"))
    model = langid.train(rows.unionByName(many), per_language=100)
    assert set(model.languages) == {*(f"l{k}" for k in range(8)), "many"}
    found = langid.with_language(rows.distinct(), model, column="found").select("lang", "found.nearest").collect()
    assert all(r.lang == r.nearest for r in found) and len(found) == 8


def test_pipeline_of_no_documents(spark, no_docs, tmp_path):
    for name, rows, schema in (("labels", [], "doc_id bigint, quality int, toxic int"), ("benchmark", [], "item_id bigint, text string")):
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    no_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_of_odd_rows(spark, odd_docs, tmp_path):
    spark.createDataFrame([(k, k % 2, 0) for k in range(10, 50)], "doc_id bigint, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "one")], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    odd_docs.write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).columns == ["doc_id", "ids", "n_tokens"]
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0
