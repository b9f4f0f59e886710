"""Asking a remote service for what a stored lookup does not know yet.

A resolver is opened and closed once per partition and asked for one point at a
time, with a bounded number of calls in flight; a call that fails keeps its
point and reason apart, so that the next run asks again for those only.  Which
points are asked for is a Spark plan: distinct in-box places whose geohash the
stored lookup lacks (an anti join), one place to a geohash.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StringType, StructField, StructType

from adlumen.operators.geo import _boxed_geohash
from adlumen.operators.lookup import lookup_join


class Resolver(Protocol):
    """What a connector offers; ``resolve`` may be called from several threads."""

    def open(self) -> None: ...

    def resolve(self, point: Mapping) -> str | None:
        """Response text for a point (its columns by name); raises if the call failed."""

    def close(self) -> None: ...


class CapturedResolver:
    """Answers with a response captured before, in the point's own column ``response``."""

    def open(self) -> None:
        pass

    def resolve(self, point: Mapping) -> str | None:
        if point["response"] is None:
            raise LookupError("no response captured")
        return point["response"]

    def close(self) -> None:
        pass


def unknown_points(points: DataFrame, lookup: DataFrame, *, lng: str = "long", lat: str = "lat",
                   precision: int = 8) -> DataFrame:
    """In-box points whose geohash ``lookup`` (column ``geohash``) lacks: one to a
    geohash (the smallest by its coordinates), with ``geohash`` and the other columns."""
    keyed = _boxed_geohash(points, lng, lat, precision, "geohash").where(F.col("geohash").isNotNull())
    fresh = lookup_join(keyed, lookup.select(F.col("geohash").alias("__known")).distinct(), "geohash", "__known", "left_anti")
    others = [c for c in points.columns if c not in (lng, lat)]
    first = F.min(F.struct(lng, lat, *others)).alias("p")
    return fresh.groupBy("geohash").agg(first).select("geohash", "p.*")


def resolve_points(points: DataFrame, make: Callable[[], Resolver], *, in_flight: int = 8,
                   partitions: int | None = None) -> DataFrame:
    """``points`` with ``response`` (null if none) and ``error`` (null unless the call failed).

    ``make()`` builds a resolver in every task; at most ``in_flight`` calls of
    a task are under way, so ``partitions`` times that is the load on the
    service.  A task that is run again asks again: write the result once
    (``session.materialize``) before using it twice.
    """
    names = points.columns
    result = StructType([f for f in points.schema.fields if f.name != "response"]
                        + [StructField("response", StringType()), StructField("error", StringType())])
    schema = to_arrow_schema(result)
    kept = [f.name for f in result.fields[:-2]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        resolver, pool, waiting = None, None, deque()

        def take():
            point, call = waiting.popleft()
            try:
                return point, call.result(), None
            except Exception as e:  # noqa: BLE001 - any failure of a call keeps its point for the next run
                return point, None, f"{type(e).__name__}: {e}"

        try:
            for batch in batches:
                if not batch.num_rows:
                    continue
                if resolver is None:
                    resolver = make()
                    resolver.open()
                    pool = ThreadPoolExecutor(in_flight)
                found = []
                for point in batch.to_pylist():
                    if len(waiting) >= in_flight:
                        found.append(take())
                    waiting.append((point, pool.submit(resolver.resolve, point)))
                while waiting:
                    found.append(take())
                out = {c: [p[c] for p, _, _ in found] for c in kept}
                out |= {"response": [r for _, r, _ in found], "error": [e for _, _, e in found]}
                yield pa.RecordBatch.from_pydict(out, schema=schema)
        finally:
            if pool is not None:
                pool.shutdown()
            if resolver is not None:
                resolver.close()

    dealt = points.select(*names)
    return (dealt.repartition(partitions) if partitions else dealt).mapInArrow(run, result)
