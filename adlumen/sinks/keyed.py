"""Keyed tables with upserts: a base, deltas by batch number, merged on read.

Keys and values are strings, as in the key/value store these tables stand for.
A table is a folder of Parquet files::

    path/buckets=<n>/base/upto=<batch>/bucket=<b>/...     all keys up to a batch
    path/buckets=<n>/delta/batch=<batch>/bucket=<b>/...   keys set by a batch

Every part is dealt to buckets by a hash of the key, sorted on it and written
with a Parquet Bloom filter, so a list of keys reads only its buckets' folders,
and there only the row groups that may hold one of them.

A part counts once its write is complete (``_SUCCESS``): a write that failed
leaves nothing that readers see.  Running a batch again replaces that batch,
which is out of sight until then.  ``compact`` writes a new base beside the old
one and its deltas; these stay, for readers that began with them, until the next
compaction.  Where it fails they stand as they were, and it can be run again.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The most keys that a list may name; more come as a DataFrame.
MOST_KEYS = 10_000


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def _numbered(spark: SparkSession, path: str, name: str, complete: bool = True) -> list[int]:
    """Numbers n of the folders ``path/name=n``, ascending; ``complete``: with a finished write."""
    fs, top, make = _fs(spark, path)
    found = []
    for status in (fs.globStatus(make(top, f"{name}=*")) or []):
        folder = status.getPath()
        m = re.fullmatch(rf"{name}=(\d+)", folder.getName())
        if m and (not complete or fs.exists(make(folder, "_SUCCESS"))):
            found.append(int(m.group(1)))
    return sorted(found)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p, _ = _fs(spark, path)
    fs.delete(p, True)


def _bucket(key: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _root(spark: SparkSession, path: str) -> tuple[str, int]:
    found = _numbered(spark, path, "buckets", complete=False)
    if len(found) != 1:
        raise ValueError(f"no keyed table at {path}" if not found else f"several bucket counts at {path}")
    return f"{path.rstrip('/')}/buckets={found[0]}", found[0]


def _write(df: DataFrame, path: str, key: str, value: str, n: int) -> None:
    """(key, value), unique on key -> one folder per bucket, sorted, with Bloom filters."""
    rows = df.select(*(F.col(c).cast("string").alias(c) for c in (key, value))).withColumn(
        "bucket", _bucket(F.col(key), n))
    (rows.repartition(n, "bucket").sortWithinPartitions("bucket", key)
         .write.mode("overwrite").partitionBy("bucket")
         .option(f"parquet.bloom.filter.enabled#{key}", "true").parquet(path))


def put(df: DataFrame, path: str, batch: int, *, key: str = "key", value: str = "value",
        order: str | None = None, buckets: int = 64) -> None:
    """Set the keys of ``df`` to its values, as batch number ``batch`` (positive).

    Of keys that repeat in ``df`` the smallest value is taken, or the last by the
    column ``order``.  Later batches win over earlier ones; a batch that is run
    again replaces itself.  Null keys are ignored.  ``buckets`` is fixed by the
    first batch: some tens of MB of keys and values each.
    """
    spark = df.sparkSession
    known = _numbered(spark, path, "buckets", complete=False)
    n = known[0] if known else buckets
    root = f"{path.rstrip('/')}/buckets={n}"
    if batch <= 0 or batch <= max(_numbered(spark, f"{root}/base", "upto"), default=0):
        raise ValueError(f"batch {batch} is not positive, or is in the base already")
    pick = F.max_by(value, order) if order else F.min(value)
    _write(df.where(F.col(key).isNotNull()).groupBy(key).agg(pick.alias(value)), f"{root}/delta/batch={batch}",
           key, value, n)


def _parts(spark: SparkSession, root: str) -> tuple[int, list[tuple[int, str]]]:
    """(last batch of the newest base, (batch, path) of that base and the deltas after it)."""
    upto = max(_numbered(spark, f"{root}/base", "upto"), default=0)
    parts = [(upto, f"{root}/base/upto={upto}")] if upto else []
    return upto, parts + [(b, f"{root}/delta/batch={b}") for b in _numbered(spark, f"{root}/delta", "batch") if b > upto]


def read(spark: SparkSession, path: str, *, key: str = "key", value: str = "value",
         keys: Sequence[str] | DataFrame | None = None, upto: int | None = None) -> DataFrame:
    """``(key, value)`` as of the last batch, or of batch ``upto`` if the base is not beyond it.

    ``keys`` (a list of at most ``MOST_KEYS``, or a DataFrame with the column
    ``key``) reads those alone: the condition reaches each part's scan, so
    other buckets' files are never opened.  Values of later batches win; the
    merge is a partial + final aggregate.
    """
    root, n = _root(spark, path)
    base, parts = _parts(spark, root)
    if upto is not None:
        if upto < base:
            raise ValueError(f"the base holds batches up to {base} already")
        parts = [p for p in parts if p[0] <= upto]
    if isinstance(keys, DataFrame):
        wanted = keys.select(F.col(key).cast("string").alias(key)).distinct().withColumn("bucket", _bucket(F.col(key), n))
    elif keys is not None:
        if len(keys) > MOST_KEYS:
            raise ValueError(f"over {MOST_KEYS} keys: give a DataFrame")
        names = sorted(set(keys))
        found = spark.createDataFrame([(k,) for k in names], f"{key} string").select(
            _bucket(F.col(key), n).alias("b")).distinct().collect() if names else []
        wanted = F.col("bucket").isin([r.b for r in found]) & F.col(key).isin(names)
    out = None
    for batch, part in parts:
        rows = spark.read.schema(f"`{key}` string, `{value}` string, bucket int").parquet(part)
        if isinstance(keys, DataFrame):
            rows = rows.join(wanted, ["bucket", key], "left_semi")
        elif keys is not None:
            rows = rows.where(wanted)
        rows = rows.select(key, value, F.lit(batch).alias("batch"))
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        raise ValueError(f"no batch at {path}")
    if len(parts) == 1:
        return out.select(key, value)
    return out.groupBy(key).agg(F.max_by(value, "batch").alias(value))


def compact(spark: SparkSession, path: str, *, key: str = "key", value: str = "value") -> int:
    """Base and deltas -> a new base; returns its last batch."""
    root, n = _root(spark, path)
    upto, parts = _parts(spark, root)
    if not parts:
        raise ValueError(f"no batch at {path}")
    last = parts[-1][0]
    if last > upto:
        _write(read(spark, path, key=key, value=value), f"{root}/base/upto={last}", key, value, n)
    for b in _numbered(spark, f"{root}/delta", "batch", complete=False):
        if b <= upto:                   # taken in by the base before, so no reader needs it
            _delete(spark, f"{root}/delta/batch={b}")
    for b in _numbered(spark, f"{root}/base", "upto", complete=False):
        if b < upto:
            _delete(spark, f"{root}/base/upto={b}")
    return last
