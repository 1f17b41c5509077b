"""One query per operator over its whole table, and the SQL it must agree with where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relist.llm import chat, decontaminate, exact, langid, licences, pii, quality, rules, runs, sentencepieces, simhash, spelling, substring
from relist.llm.common import table

#: The key of the pseudonyms in the query; a user passes their own.
KEY = b"relist"


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, table(spark, sf_dir, "benchmark"), column="found")
    return found.select(
        "doc_id", F.col("found.n_words").alias("n_words"), F.col("found.n_hit").alias("n_hit"), F.size("found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "found.items"), 256).alias("items_sha256"), (F.col("found.n_hit") > 0).alias("contaminated"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(table(spark, sf_dir, "documents")).drop("n_chunks")


def op6_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(quality.learnable())
    scored = quality.with_score(docs, quality.train(docs, labels))
    return scored.select("doc_id", (~quality.learnable()).alias("held_out"), "score", (F.col("score") >= quality.CUT).cast("int").alias("predicted"))


def op7_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents")).drop("text_key", "root")


def op8_sentencepiece_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = sentencepieces.encode(table(spark, sf_dir, "documents"))
    read = encoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), sentencepieces.digest("ids").alias("ids_sha256"), sentencepieces.decode("ids").alias("text"))
    return read.select("doc_id", "n_tokens", "ids_sha256", F.length("text").cast("long").alias("decoded_chars"), F.sha2("text", 256).alias("decoded_sha256"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = substring.drop_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
    model = langid.train(docs.where(~held_out).select("text", "lang"))
    found = langid.with_language(docs.select("doc_id", "text"), model, column="found")
    return found.select("doc_id", held_out.alias("held_out"), F.col("found.nearest").alias("lang_pred"), F.col("found.score").alias("score"), F.col("found.rejected").alias("rejected"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(probe)
    return chat.digests(chat.format_turns(turns))


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = pii.with_pseudonyms(table(spark, sf_dir, "documents").select("doc_id", "text"), KEY, column="private")
    count = lambda kind: F.size(F.filter("private.spans", lambda s: s["kind"] == kind)).cast("long")
    return done.select("doc_id", F.size("private.spans").cast("long").alias("n_found"), *[count(k).alias(f"n_{k}") for k in ("card", "phone", "ip", "email", "secret")],
                       F.col("private.text").alias("text"))


def op10_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licences.with_licences(docs, licences.train(docs), column="found")
    sure = F.filter("found.finds", lambda x: x["confirmed"])
    families = F.array_sort(F.array_distinct(F.transform(sure, lambda x: x["family"])))
    return found.select(
        "doc_id", F.col("found.paragraphs").alias("n_paragraphs"), F.concat_ws(",", families).alias("families"), F.size(sure).cast("long").alias("n_confirmed"),
        (F.size("found.finds") - F.size(sure)).cast("long").alias("n_unconfirmed"))


def with_planted_period(docs: DataFrame) -> DataFrame:
    """(doc_id, text): the words from a on of every tenth document by crc32 become a repetition of the p words from there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = docs.select("doc_id", "text", h.alias("h")).withColumn(
        "words", F.when(F.col("h") % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))))
    g, n = F.floor(F.col("h") / 10), F.size("words")
    placed = words.withColumn("a", F.when(n > 0, g % n).cast("int"))
    placed = placed.withColumn("p", (1 + F.floor((n - F.col("a")) / (3 + g % 8))).cast("int"))
    changed = F.expr("array_join(transform(words, (w, i) -> if(i >= a, words[a + (i - a) % p], w)), ' ')")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), changed).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.with_runs(with_planted_period(table(spark, sf_dir, "documents")), column="periodic").select("doc_id", "periodic.runs", "periodic.collapsed")
    longest = F.array_sort(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    listed = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise("")
    best = found.withColumn("best", F.get(longest, F.lit(0))).withColumn("listed", listed)
    length = -F.col("best.l")
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.s").alias("start"), length.alias("length"), F.col("best.p").alias("period"),
        F.floor(1000 * length / F.col("best.p")).alias("exponent_milli"), F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")
    # One letter is deleted at most, so runs shorter than the shortest word cannot become one.
    found = docs.select("id", F.explode(spelling.runs_of_letters(F.col("text"), spelling.SHORTEST)).alias("run"))
    h = found.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")))
    at = (F.col("h") % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = h.select(F.when(F.col("h") % 31 == 0, less).otherwise(F.col("run")).alias("word"))
    return spelling.spelling_variants(spelling.vocabulary(words)).select("word", "form", "root", "n", "n_near", "form_n")


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = rules.train(docs, table(spark, sf_dir, "labels").where(quality.learnable()))
    found = rules.with_rules(docs, trees, column="found")
    return found.select("doc_id", *[F.col(f"found.{c}").alias(c) for c in [*rules.COUNTS, "base_failed", "kept", "score"]])


QUERIES = {
    "op11_periodic_runs": op11_periodic_runs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_quality_rules": op13_quality_rules,
    "op10_licence_scan": op10_licence_scan,
    "op1_pii_pseudonyms": op1_pii_pseudonyms,
    "op9_chat_format": op9_chat_format,
    "op2_language_id": op2_language_id,
    "op3_substring_dedup": op3_substring_dedup,
    "op8_sentencepiece_scan": op8_sentencepiece_scan,
    "op6_quality_ranking": op6_quality_ranking,
    "op7_simhash_near_dedup": op7_simhash_near_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_exact_dedup": op5_exact_dedup,
}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLE = {
    "op4_benchmark_decontamination": rf"""
        WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        iw AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS k
               FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM (SELECT item_id, w, least(len(w), 10) AS n FROM i WHERE len(w) > 0))),
        dw AS (SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS k
               FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
        hits AS (SELECT doc_id, p, dw.n, item_id FROM dw JOIN iw USING (n, k)),
        words AS (SELECT doc_id, count(DISTINCT q) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM hits) GROUP BY doc_id),
        items AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
                  FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op5_exact_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM d JOIN g USING (t)""",
    "op3_substring_dedup": r"""
        WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
        g AS (SELECT doc_id, p, array_to_string(w[p:p + 34], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35)),
        r AS (SELECT k FROM g GROUP BY k HAVING count(*) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS q FROM g WHERE k IN (SELECT k FROM r)),
        lost AS (SELECT doc_id, list(q) AS qs FROM gone GROUP BY doc_id),
        kept AS (SELECT doc_id, list(x ORDER BY q) AS ks FROM (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS q FROM d)
                 WHERE (doc_id, q) NOT IN (SELECT doc_id, q FROM gone) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(len(qs), 0) AS BIGINT) AS n_removed,
               sha256(coalesce(array_to_string(ks, ' '), '')) AS kept_sha256
        FROM d LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op9_chat_format": r"""
        WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
        e AS (SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS last,
                     length(regexp_replace(replace(text, '\', '\\'), '(<)(<SYS>>|</SYS>>|<ROLE>>|</ROLE>>|<END>>|s>|/s>)|(\[)(INST\]|/INST\])', '\1\3\\\2\4', 'g'))
                     + CASE role WHEN 'system' THEN 8 + 10 WHEN 'user' THEN 7 + 9 WHEN 'assistant' THEN 3 + 5 ELSE 8 + 9 + 8 + length(role) END AS size
              FROM t)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
               CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
               CAST(sum(size) AS BIGINT) AS formatted_chars,
               bool_and(CASE WHEN last IS NULL THEN role IN ('system', 'user') WHEN last IN ('system', 'assistant') THEN role = 'user'
                             WHEN last = 'user' THEN role = 'assistant' ELSE false END) AS valid
        FROM e GROUP BY conv_id""",
}
