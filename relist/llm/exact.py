"""Exact dedup by content-defined chunk recipes, in DataFrame operations only.

A text is normalised (every run of the bytes 0x20, 0x09-0x0D becomes one space) and cut into chunks
where its content says so: after at least MIN_CHUNK characters, behind the next match of CUT,
at MAX_CHUNK at the latest (also where a script never matches CUT). A chunk's identifier is its 64-bit hash, verified by comparing the texts
of all chunks that share it: text moves once, chunk by chunk, after a map-side merge of equal hashes.
Where two texts share a hash, ordinals tell them apart. Texts are equal if their ordered identifier
lists are equal, so documents are grouped by those short lists and never move as a whole.

Cuts depend on the text alone, hence equal texts have equal lists; verified identifiers make equal
lists mean equal texts.

Defined cases: null counts as empty; all empty texts form one group (empty list). A text of white
space alone becomes one space and equals others like it, not the empty text. Rows that repeat a
doc_id and text are the same document: they count in group_size and `kept` marks all of them, but
`drop_exact_copies` leaves one row of each group. A null doc_id is kept only if no other row of the group has an
id. Extra columns are ignored by `exact_groups` and returned unchanged by `drop_exact_copies`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relist.llm.common import one_row_each
from relist.session import materialize

#: Runs that are not one space already.
SPACE = r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+"
MIN_CHUNK, MAX_CHUNK = 512, 8192
CUT, CUT_LENGTH = "[ae][nrt][ d-h][a-m][ei]", 5


def normalise(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), SPACE, " ")


def chunks(text: Column) -> Column:
    pattern = f"(?s).{{{MIN_CHUNK},{MAX_CHUNK - CUT_LENGTH}}}?{CUT}|.{{1,{MAX_CHUNK}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def _chunked(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), normalise(F.col(text)).alias("text")).select(
        "doc_id", F.sha2("text", 256).alias("text_sha256"), chunks(F.col("text")).alias("chunks"))


def _ordinals(chunked: DataFrame, spark_hash: Callable[[Column], Column]) -> DataFrame | None:
    """Per document the ordinals of its chunks whose hash several chunk texts share; None if no hash is shared."""
    rows = chunked.select("doc_id", "text_sha256", F.posexplode("chunks").alias("pos", "chunk")).withColumn("h", spark_hash(F.col("chunk")))
    shared = materialize(rows.groupBy("h").agg(F.min("chunk").alias("low"), F.max("chunk").alias("high")).where("low <> high").select("h"), "shared-hashes")
    if shared.isEmpty():
        return None
    texts = rows.join(shared, "h", "left_semi").select("h", "chunk").distinct()
    ranked = texts.select("h", "chunk", F.sha2("chunk", 256).alias("ordinal"))
    found = rows.join(ranked, ["h", "chunk"]).groupBy("doc_id", "text_sha256")
    return found.agg(F.array_sort(F.collect_set(F.struct("pos", "ordinal"))).alias("ordinals"))


def recipes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """(doc_id, text_sha256, recipe, ordinals): the ordered list of verified chunk identifiers of each row."""
    chunked = _chunked(docs, doc_id, text)
    out = chunked.select("doc_id", "text_sha256", F.transform("chunks", lambda c: chunk_hash(c)).alias("recipe"))
    ordinals = _ordinals(chunked, chunk_hash)
    if ordinals is None:
        return materialize(out.withColumn("ordinals", F.lit(None).cast("array<struct<pos:int,ordinal:string>>")), "recipes")
    same = out["doc_id"].eqNullSafe(ordinals["doc_id"]) & (out["text_sha256"] == ordinals["text_sha256"])
    return materialize(out.join(ordinals, same, "left").select(out["*"], "ordinals"), "recipes")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", chunk_hash: Callable[[Column], Column] = F.xxhash64) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256, n_chunks.

    keep_id is the smallest doc_id of the documents with an equal text; kept marks that one.
    """
    made = recipes(docs, doc_id, text, chunk_hash).withColumn("ordinals", F.coalesce("ordinals", F.array().cast("array<struct<pos:int,ordinal:string>>")))
    groups = made.groupBy("recipe", "ordinals").agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    # Only groups with copies, written out: the join has a plain exchange on both sides and a hot group is split.
    copied = materialize(groups.where("group_size > 1"), "groups")
    size = F.coalesce("group_size", F.lit(1).cast("long"))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return made.join(copied, ["recipe", "ordinals"], "left").withColumns({"keep_id": keep, "group_size": size}).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", F.size("recipe").cast("long").alias("n_chunks"))


def drop_exact_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of `docs` for each text, that with the smallest doc_id, with all its columns.

    Of several rows that repeat this doc_id, or of a text whose rows all have none, any one stays.
    """
    grouped = exact_groups(docs, doc_id, text)
    gone = grouped.where("not kept").select("doc_id", "text_sha256").distinct()
    times = grouped.where("kept and group_size > 1").groupBy("doc_id", "text_sha256").agg(F.count(F.lit(1)).alias("times")).where("times > 1")

    def same(rows: DataFrame, keys: DataFrame) -> Column:
        return rows[doc_id].eqNullSafe(keys["doc_id"]) & (F.sha2(normalise(rows[text]), 256) == keys["text_sha256"])

    times = materialize(times.select("doc_id", "text_sha256"), "repeated-ids")
    stays = docs.join(gone, same(docs, gone), "left_anti")
    if times.isEmpty():
        return stays
    return one_row_each(stays, [stays[doc_id], F.sha2(normalise(stays[text]), 256)], times, same)
