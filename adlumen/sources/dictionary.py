"""App dictionary (tab-separated text) and stop-word list readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlumen.functions.strings import split_drop_trailing, split_keep_trailing

KEY_FIELD = 4     # app id
VALUE_FIELD = 1   # app name
MIN_FIELDS = 5


#: Where a line stands: file, start of its split, line within the split.
FILE_ORDER = "__at"


def lines_in_order(spark: SparkSession, path: str) -> DataFrame:
    """Text lines with ``FILE_ORDER``, a column that orders them by file path and
    then by place in the file, however the files are split into tasks.

    A split is read by one task from its start, so within a split the task's
    running row number rises with the line; no sort and no shuffle is needed.
    """
    return spark.read.text(path).select("value", F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line")).alias(FILE_ORDER))


def parse_app_dictionary(lines: DataFrame, *, strict: bool = False,
                         value_col: str = "value", order: str | None = None) -> DataFrame:
    """TSV lines -> ``(key, value)``, unique on key.

    A line needs at least five fields.  ``strict=False`` counts trailing
    empty fields; ``strict=True`` does not (so ``a\\tb\\tc\\td\\t`` is dropped).
    Duplicate keys keep the smallest value, or with ``order`` (a column that
    orders the lines) the value of the last line; neither depends on how the
    lines are partitioned.  Grouping is a partial + final aggregate.
    """
    fields = split_keep_trailing(F.col(value_col), "\t")
    arity = F.size(split_drop_trailing(F.col(value_col), "\t")) if strict else F.size(fields)
    pairs = lines.where(arity >= MIN_FIELDS).select(
        fields.getItem(KEY_FIELD).alias("key"), fields.getItem(VALUE_FIELD).alias("value"),
        *([F.col(order).alias("at")] if order else []))
    return pairs.groupBy("key").agg((F.max_by("value", "at") if order else F.min("value")).alias("value"))


def read_app_dictionary(spark: SparkSession, path: str, *, strict: bool = False,
                        duplicates: str = "smallest") -> DataFrame:
    """Dictionary files -> ``(key, value)``; of a repeated key the ``smallest``
    value stays, or the ``last`` one (files by path, lines as they stand)."""
    if duplicates not in ("smallest", "last"):
        raise ValueError(f"duplicates: smallest or last, not {duplicates}")
    if duplicates == "last":
        return parse_app_dictionary(lines_in_order(spark, path), strict=strict, order=FILE_ORDER)
    return parse_app_dictionary(spark.read.text(path), strict=strict)


def read_stopwords(spark: SparkSession, path: str) -> DataFrame:
    """One word per line -> distinct ``value`` column."""
    return spark.read.text(path).distinct()
