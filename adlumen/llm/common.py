"""Helpers shared by the training-data operators.

Python work runs in ``mapInArrow`` tasks that see a few hundred rows at a time,
so a task's memory does not depend on its partition's size.  Tables that are
read more than once are written under ``spark.checkpoint.dir``
(``adlumen.session.materialize``), so a lost executor costs a re-read only.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

from adlumen.session import materialize

#: Rows handed to Python at once, and characters after which a step ends early.
STEP_ROWS, STEP_CHARS = 256, 1_000_000
#: Rows of fixed-width keys that may be broadcast (some 16 to 48 bytes each).
BROADCAST_ROWS = 500_000
#: Rows of binary partial sums added in one task.
FAN_IN = 16


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def remainder(doc_id: Column | str, modulus: int) -> Column:
    """crc32(doc_id as text) mod ``modulus``; a null doc_id counts as empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(c.cast("string"), F.lit(""))) % modulus


def lower_ascii(c: Column) -> Column:
    """``c`` with A-Z lower-cased and nothing else changed."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def steps(batches: Iterable[pa.RecordBatch], text: str | None = None) -> Iterator[dict]:
    """Column lists of a few rows at a time; a step ends early after long texts."""
    for b in batches:
        at = 0
        while at < b.num_rows:
            n = min(STEP_ROWS, b.num_rows - at)
            if text is not None:
                col = b.column(b.schema.get_field_index(text))
                size = 0
                for k in range(n):
                    size += len(col[at + k].as_buffer() or b"") if col[at + k].is_valid else 0
                    if size > STEP_CHARS:
                        n = k + 1
                        break
            part = b.slice(at, n)
            yield {name: part.column(i).to_pylist() for i, name in enumerate(part.schema.names)}
            at += n


def arrow_map(df: DataFrame, schema: str, make: Callable[[], Callable[[dict], dict | None]],
              text: str | None = "text", finish: bool = False) -> DataFrame:
    """Map column lists to column lists in Arrow batches.

    ``make()`` runs once in each task and returns the step function; with
    ``finish`` that function is called with None at the end, for running sums.
    """
    spec = _parse_datatype_string(schema)
    assert isinstance(spec, StructType)
    arrow = to_arrow_schema(spec)

    def run(batches):
        f = make()
        for cols in steps(batches, text):
            out = f(cols)
            if out is not None:
                yield pa.RecordBatch.from_pydict(out, schema=arrow)
        if finish and (out := f(None)) is not None:
            yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return df.mapInArrow(run, spec)


def small_side(df: DataFrame, name: str, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` written as a table; broadcast only if its counted rows are few.

    For fixed-width columns, so that the row bound bounds the bytes.  Beyond
    the bound the table is joined by a shuffle, whose hot keys Spark can split.
    """
    table, _, seen = materialize(df, name, [F.count(F.lit(1)).alias("n")])
    return F.broadcast(table) if seen["n"] <= max_rows else table


def tree_sum(df: DataFrame, dtype: str = "float64") -> np.ndarray | None:
    """Sum equally long binary vectors (column ``v``) in a tree of tasks.

    A task adds at most about ``FAN_IN`` vectors at a time (streamed, so one
    sum is held), and the driver receives FAN_IN vectors, however many
    partitions there were.
    """
    def add(batches):
        total = None
        for b in batches:
            for x in b.column(0):
                y = np.frombuffer(x.as_buffer(), dtype=dtype)
                total = y.copy() if total is None else np.add(total, y, out=total)
        if total is not None:
            yield pa.RecordBatch.from_pydict({"v": [total.tobytes()]},
                                             schema=pa.schema([("v", pa.binary())]))

    table, _, seen = materialize(df.select("v"), "sums", [F.count(F.lit(1)).alias("n")])
    n = seen["n"]
    while n > FAN_IN:
        parts = math.ceil(n / FAN_IN)
        table, _, seen = materialize(
            table.repartition(parts).mapInArrow(add, "v binary"), "sums",
            [F.count(F.lit(1)).alias("n")])
        n = seen["n"]
    rows = [np.frombuffer(r.v, dtype=dtype) for r in table.collect()]
    return np.sum(rows, axis=0) if rows else None


class Cache(dict):
    """Values by key, computed when missing; emptied when it holds ``most`` keys."""

    def __init__(self, compute, most: int = 300_000):
        super().__init__()
        self.compute, self.most = compute, most

    def __missing__(self, key):
        if len(self) >= self.most:
            self.clear()
        value = self[key] = self.compute(key)
        return value


def tag(prefix: str) -> str:
    return f"{prefix}_{uuid.uuid4().hex[:8]}"
