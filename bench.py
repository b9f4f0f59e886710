"""Benchmark: headline log workflows at $BENCH_SF_DIR on local[$BENCH_CPUS].

Inputs are first materialised the way a deployment holds them (typed log as
Parquet, raw log lines and the app dictionary as text, captured geocoder
responses as Parquet) in a fresh scratch folder; then every query runs from
those files into Spark's ``noop`` sink: one warm-up, then the median of
$BENCH_RUNS runs.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


from adlumen.operators.geo import build_business_lookup  # noqa: E402
from adlumen.operators.graph import connected_components  # noqa: E402
from adlumen.plans import profiles, reports  # noqa: E402
from adlumen.session import local_session  # noqa: E402
from adlumen.sources import bindings as B  # noqa: E402
from adlumen.sources.dictionary import read_app_dictionary  # noqa: E402
from adlumen.sources.logs import parse_log, read_log, read_raw_lines  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def _sf(path: str) -> float | str:
    name = os.path.basename(os.path.normpath(path))
    try:
        return float(name.replace("sf", ""))
    except ValueError:
        return name


def prepare(spark, scratch):
    paths = {k: os.path.join(scratch, k) for k in ("log", "lines", "dict", "responses", "stop")}
    B.ad_log(spark, SF_DIR).write.mode("overwrite").parquet(paths["log"])
    B.raw_log_lines(spark, SF_DIR).write.mode("overwrite").text(paths["lines"])
    B.app_dictionary_lines(spark, SF_DIR).write.mode("overwrite").text(paths["dict"])
    B.geo_responses(spark, SF_DIR).write.mode("overwrite").parquet(paths["responses"])
    B.stopwords(spark).write.mode("overwrite").text(paths["stop"])
    return paths


def build_queries(spark, p):
    log = lambda: read_log(spark, p["log"])
    dic = lambda: read_app_dictionary(spark, p["dict"])
    stop = lambda: spark.read.text(p["stop"])
    return {
        "funnel_location_cumulative": lambda: reports.location_report(log(), "cumulative"),
        "funnel_location_exclusive": lambda: reports.location_report(log(), "exclusive"),
        "row_counts_by_location": lambda: reports.row_counts(log()),
        "funnel_app_dictionary": lambda: reports.app_report(log(), dic(), default="unknow"),
        "etl_parse_log": lambda: parse_log(read_raw_lines(spark, p["lines"]))[0],
        "user_tags": lambda: profiles.user_tags(log(), dictionary=dic(), stopwords=stop()),
        "connected_components": lambda: connected_components(
            profiles.id_edge_list(log())),
        "person_profiles": lambda: profiles.person_profiles(log(), dictionary=dic(), stopwords=stop()),
        "business_lookup": lambda: build_business_lookup(
            log().select("long", "lat"), spark.read.parquet(p["responses"])),
    }


def run(df_fn):
    t = time.perf_counter()
    df_fn().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t


def main():
    spark = local_session(cores=CPUS, shuffle_partitions=max(8, 2 * CPUS), driver_memory="16g")
    scratch = tempfile.mkdtemp(prefix="adlumen-bench-")
    t0 = time.perf_counter()
    paths = prepare(spark, scratch)
    prep = time.perf_counter() - t0
    times, rows, errors = {}, {}, {}
    for name, fn in build_queries(spark, paths).items():
        try:
            run(fn)  # warm-up
            times[name] = round(statistics.median(run(fn) for _ in range(RUNS)), 3)
            rows[name] = fn().count()
        except Exception as e:  # report the failure, keep timing the rest
            errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
    out = {
        "metric": "sum_median_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "rows": rows, "prepare_sec": round(prep, 3), "sf": _sf(SF_DIR),
        "cpus": CPUS, "runs": RUNS,
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
