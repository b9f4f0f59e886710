"""Device-id handling: id filter, first id, all ids, id edges, person profiles."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from adlumen.functions.strings import not_blank
from adlumen.operators.geo import in_bbox
from adlumen.schema import ALL_ID_SPEC, COARSE_BBOX, FIRST_ID_SPEC, ID_COLUMNS


def has_any_id(cols: Sequence[str] = ID_COLUMNS) -> Column:
    """At least one id column is a non-empty string (pushable to Parquet)."""
    return reduce(lambda x, y: x | y, [F.col(c) != F.lit("") for c in cols])


def has_any_id_in_bbox(cols: Sequence[str] = ID_COLUMNS, lng: str = "long", lat: str = "lat",
                       box=COARSE_BBOX) -> Column:
    return in_bbox(lng, lat, box) & has_any_id(cols)


def has_usable_id(spec: Sequence[tuple[str, str]] = ALL_ID_SPEC) -> Column:
    """Some id column is non-blank (whitespace-only ids do not count)."""
    return reduce(lambda x, y: x | y, [not_blank(c) for c, _ in spec])


def head_id(spec: Sequence[tuple[str, str]] = ALL_ID_SPEC) -> Column:
    """First element of ``all_ids(spec)`` without building the array."""
    return first_id(spec)


def first_id(spec: Sequence[tuple[str, str]] = FIRST_ID_SPEC) -> Column:
    """Prefix + first non-blank id in ``spec`` order; null when none."""
    return F.coalesce(*[F.when(not_blank(c), F.concat(F.lit(p), F.col(c))) for c, p in spec])


def all_ids(spec: Sequence[tuple[str, str]] = ALL_ID_SPEC) -> Column:
    """Array of prefix + id for every non-blank id, in ``spec`` order.

    Nulls are removed with ``array_except(arr, [null])`` (generated code, keeps
    order); it would also drop repeats, which cannot occur since every
    element carries its own column prefix.
    """
    arr = F.array(*[F.when(not_blank(c), F.concat(F.lit(p), F.col(c))) for c, p in spec])
    return F.array_except(arr, F.array(F.lit(None).cast("string")))


def id_edges(rows: DataFrame, ids: str = "ids") -> DataFrame:
    """Star edges ``(src, dst)``: a row's first id -> each of its ids (self loop
    included, so single-id rows are vertices too); distinct."""
    arr = F.col(ids)
    # get() is null for an empty array, whose explode yields no row anyway
    return rows.select(F.get(arr, 0).alias("src"), F.explode(arr).alias("dst")).distinct()
