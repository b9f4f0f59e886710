"""A training corpus from ``documents``: five stages, each a table of its own.

Every stage gets all that its predecessor kept; its result is written as
Parquet and read again as the next stage's input.  All but the last return the
columns of ``documents``; the last returns packed pieces.

A document's rows are named by doc_id.  Repeated rows are gone after exact
dedup; of rows with one doc_id and several texts, later stages drop all or
none.  Rows without a doc_id are named by their text: stages 3 and 4 number
them above all doc_ids, so of near duplicates one with a doc_id stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlumen.llm import decontamination, exact_dedup, language, packing, simhash_dedup
from adlumen.llm.common import lower_ascii, read, remainder, small_side
from adlumen.session import materialize

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Share of its n-grams that the best language must know; running text has 0.3 to 1.
LANGUAGE_SCORE = 0.2


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without letters, and those whose n-grams hardly any language knows."""
    rows = docs.select(*COLUMNS)
    filters = language.learn(rows.where(remainder("doc_id", 4) != 2))
    named = language.identify(rows, filters, list(COLUMNS))
    return named.where((F.col("lang_pred") != language.UND) & (F.col("score") >= LANGUAGE_SCORE)).select(*COLUMNS)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, keep the row with the largest doc_id."""
    rows = docs.select(*COLUMNS)
    marks, _, _ = materialize(exact_dedup.exact_duplicates(rows), "exact")
    by_row = marks.groupBy("doc_id", F.xxhash64("text_sha256").alias("key"), "text_sha256").agg(
        F.max("kept").alias("kept"), F.count(F.lit(1)).alias("n"))
    key = [F.coalesce(F.col("doc_id"), F.lit(-1)).alias("k1"), F.col("doc_id").isNull().alias("k2"), "text_sha256"]
    gone = small_side(by_row.where("not kept").select(*key), "exact-gone")
    twice = small_side(by_row.where("kept and n > 1").select(*key), "exact-twice")
    sha = F.sha2(lower_ascii(F.coalesce("text", F.lit(""))).cast("binary"), 256)
    keyed = rows.withColumns({"k1": F.coalesce(F.col("doc_id"), F.lit(-1)), "k2": F.col("doc_id").isNull(),
                              "text_sha256": sha})
    on = ["k1", "k2", "text_sha256"]
    left = keyed.join(gone, on, "left_anti")
    once = left.join(twice, on, "left_anti")
    repeated = left.join(twice, on, "left_semi").dropDuplicates(on)
    return once.unionByName(repeated).select(*COLUMNS)


def _named(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a column ``row``: doc_id, or the number of the text where that is null."""
    rows = docs.select(*COLUMNS)
    seen = rows.agg(F.coalesce(F.max("doc_id"), F.lit(0)).cast("bigint").alias("top"),
                    F.count_if(F.col("doc_id").isNull()).alias("bare")).first()
    if not seen.bare:
        return rows.withColumn("row", F.col("doc_id").cast("bigint"))
    sha = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    bare = rows.where(F.col("doc_id").isNull()).withColumn("sha", sha)
    texts = bare.select("sha").distinct().select("sha", (F.monotonically_increasing_id() + max(seen.top, 0) + 1).alias("row"))
    numbers, _, _ = materialize(texts, name)
    return rows.where(F.col("doc_id").isNotNull()).withColumn("row", F.col("doc_id").cast("bigint")).unionByName(
        bare.join(numbers, "sha").drop("sha"))


def _without(named: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    gone = small_side(rows.select(F.col("doc_id").alias("row")).distinct(), name)
    return named.join(gone, "row", "left_anti").select(*COLUMNS)


def _by_row(named: DataFrame) -> DataFrame:
    return named.select(F.col("row").alias("doc_id"), "text")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates keep the document with the smallest doc_id."""
    named = _named(docs, "near-rows")
    marks, _, _ = materialize(simhash_dedup.near_duplicates(_by_row(named), shingle=4, max_distance=4), "near")
    heads = marks.where(F.col("doc_id") == F.col("component_id")).select("doc_id").distinct()
    gone = marks.where(F.col("doc_id") != F.col("component_id")).select("doc_id").join(heads, "doc_id", "left_anti")
    return _without(named, gone, "near-gone")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    named = _named(docs, "leak-rows")
    found = decontamination.contaminated(_by_row(named), read(spark, sf_dir, "benchmark"))
    return _without(named, found, "leaks")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, packing.Capacity(tokens=2048), end_id=0)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact),
    ("simhash_near_dedup", near),
    ("benchmark_decontamination", decontaminate),
    ("best_fit_packing", pack),
]

#: Language ID, fingerprints and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs, _, _ = materialize(docs, f"pipeline-{name}")
    return docs
