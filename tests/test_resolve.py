"""Resolvers: opened once per partition, bounded calls in flight, failures kept for the next run."""

import threading
import time

from adlumen.operators.resolve import CapturedResolver, resolve_points, unknown_points
from adlumen.plans import jobs
from adlumen.sinks import keyed

POINTS = "long string, lat string, response string"
GOOD = '{"status":0,"result":{"business":"%s","pois":[]}}'


def test_opened_once_per_partition_and_calls_bounded(spark):
    sc = spark.sparkContext
    opened, closed, calls, over = (sc.accumulator(0) for _ in range(4))

    class Stub:
        def open(self):
            opened.add(1)
            self.lock, self.now = threading.Lock(), 0

        def resolve(self, point):
            with self.lock:
                self.now += 1
                if self.now > 3:
                    over.add(1)
            time.sleep(0.002)
            with self.lock:
                self.now -= 1
                calls.add(1)
            if point["id"] % 10 == 0:
                raise TimeoutError("slow")
            return None if point["id"] % 10 == 1 else f"r{point['id']}"

        def close(self):
            closed.add(1)

    points = spark.range(200).selectExpr("id", "cast(id as string) as long", "'1' as lat")
    rows = resolve_points(points, Stub, in_flight=3, partitions=5).collect()
    assert len(rows) == 200 and calls.value == 200 and over.value == 0
    assert opened.value == closed.value == 5
    assert {r.id for r in rows if r.error} == set(range(0, 200, 10))
    assert rows and all(r.error == "TimeoutError: slow" and r.response is None for r in rows if r.id % 10 == 0)
    assert all(r.response == (None if r.id % 10 == 1 else f"r{r.id}") for r in rows if r.id % 10)


def test_closed_when_a_task_fails_and_never_opened_without_points(spark):
    opened = spark.sparkContext.accumulator(0)

    class Stub(CapturedResolver):
        def open(self):
            opened.add(1)

    none = spark.createDataFrame([], POINTS)
    assert resolve_points(none, Stub).collect() == [] and opened.value == 0


def test_only_unknown_places_are_asked_for(spark):
    points = spark.createDataFrame([
        ("116.3906", "39.92324", "x"), ("116.3906", "39.92324", "x"),       # one place twice
        ("116.39061", "39.92324", "y"),                                     # the same geohash
        ("200", "39.9", "out of the box"), ("bad", "", None), (None, None, None),
        ("100.03", "40.57", "known")], POINTS)
    known = unknown_points(points.where("response = 'known'"), spark.createDataFrame([], "geohash string"))
    found = unknown_points(points, known.select("geohash")).collect()
    assert [(r.long, r.lat, r.response) for r in found] == [("116.3906", "39.92324", "x")]


def test_failed_places_are_asked_for_again(spark, tmp_path):
    lookup, failed = str(tmp_path / "lookup"), str(tmp_path / "failed")
    keyed.put(spark.createDataFrame([], "geohash string, business string"), lookup, 1, key="geohash",
              value="business", buckets=2)
    points = spark.createDataFrame([("116.3906", "39.92324", GOOD % "A,B"), ("100.03", "40.57", None),
                                    ("90.1", "30.2", '{"status":1}')], POINTS)
    run = dict(make_resolver=CapturedResolver, in_flight=2)
    assert jobs.resolve_business_job(spark, points, lookup, failed, batch=2, **run) == {"asked": 3, "failed": 1}
    rest = spark.read.parquet(f"{failed}/batch=2").collect()
    assert [(r.long, r.error) for r in rest] == [("100.03", "LookupError: no response captured")]
    business = [r.business for r in keyed.read(spark, lookup, key="geohash", value="business").collect()]
    assert business == ["A;B"]
    later = spark.createDataFrame([("116.3906", "39.92324", GOOD % "changed"), ("100.03", "40.57", GOOD % "C")], POINTS)
    assert jobs.resolve_business_job(spark, later, lookup, failed, batch=3, **run) == {"asked": 1, "failed": 0}
    business = {r.business for r in keyed.read(spark, lookup, key="geohash", value="business").collect()}
    assert business == {"A;B", "C"}
