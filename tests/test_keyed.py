"""Keyed tables: upserts by batch, failed and finished compactions, pruned point reads."""

import os

import pytest

from adlumen.plans import jobs
from adlumen.sinks import keyed
from adlumen.sources.dictionary import read_app_dictionary

KV = "key string, value string"


def put(spark, path, batch, rows, **options):
    keyed.put(spark.createDataFrame(rows, KV), path, batch, **options)


def content(spark, path, **options):
    return {r.key: r.value for r in keyed.read(spark, path, **options).collect()}


def test_later_batches_win_and_a_batch_replaces_itself(spark, tmp_path):
    p = str(tmp_path / "t")
    put(spark, p, 1, [("a", "1"), ("b", "1"), ("b", "0"), (None, "x")], buckets=4)
    put(spark, p, 2, [("b", "2"), ("c", "2")])
    assert content(spark, p) == {"a": "1", "b": "2", "c": "2"}
    assert content(spark, p, upto=1) == {"a": "1", "b": "0"}    # the smallest of a batch's repeats
    put(spark, p, 2, [("c", "3")])                              # batch 2 again, without b
    assert content(spark, p) == {"a": "1", "b": "0", "c": "3"}
    ordered = spark.createDataFrame([("d", "first", 1), ("d", "a later one", 2), ("d", "z", 0)], KV + ", at int")
    keyed.put(ordered, p, 3, order="at")
    assert content(spark, p)["d"] == "a later one"


def test_compaction_keeps_the_content(spark, tmp_path):
    p = str(tmp_path / "t")
    put(spark, p, 1, [(str(i), "old") for i in range(50)], buckets=4)
    put(spark, p, 5, [(str(i), "new") for i in range(0, 50, 3)])
    before = content(spark, p)
    old_reader = keyed.read(spark, p)
    assert keyed.compact(spark, p) == 5 and content(spark, p) == before
    assert {r.key: r.value for r in old_reader.collect()} == before     # began before the compaction
    for late in (0, 3, 5):
        with pytest.raises(ValueError, match="in the base"):
            put(spark, p, late, [("1", "x")])
    with pytest.raises(ValueError, match="up to 5"):
        keyed.read(spark, p, upto=3)
    put(spark, p, 6, [("1", "newest")])
    assert keyed.compact(spark, p) == 6 and keyed.compact(spark, p) == 6
    assert content(spark, p) == before | {"1": "newest"}
    root = f"{p}/buckets=4"
    assert os.listdir(f"{root}/base") == ["upto=6"] and not os.listdir(f"{root}/delta")


def test_a_failed_compaction_or_write_loses_nothing(spark, tmp_path, monkeypatch):
    p = str(tmp_path / "t")
    put(spark, p, 1, [("a", "1"), ("b", "1")], buckets=2)
    put(spark, p, 2, [("b", "2")])
    # the write of the new base dies half-way: files, but no mark of success
    broken = tmp_path / "t" / "buckets=2" / "base" / "upto=2" / "bucket=0"
    broken.mkdir(parents=True)
    spark.createDataFrame([("a", "wrong")], KV).coalesce(1).write.mode("overwrite").parquet(str(broken))
    os.remove(broken / "_SUCCESS")
    assert content(spark, p) == {"a": "1", "b": "2"}

    def dies(*_):
        raise OSError("executor lost")

    with monkeypatch.context() as m:
        m.setattr(keyed, "_write", dies)
        with pytest.raises(OSError):
            keyed.compact(spark, p)
        with pytest.raises(OSError):
            put(spark, p, 3, [("a", "3")])
    assert content(spark, p) == {"a": "1", "b": "2"}
    assert keyed.compact(spark, p) == 2 and content(spark, p) == {"a": "1", "b": "2"}


def files_read(df):
    """Files that the scans of an executed plan without shuffles opened."""
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numFiles").value() for i in range(leaves.size()))


def test_point_reads_open_their_buckets_only(spark, tmp_path):
    p = str(tmp_path / "t")
    put(spark, p, 1, [(f"k{i}", f"v{i}") for i in range(2000)], buckets=32)
    every = keyed.read(spark, p)
    some = keyed.read(spark, p, keys=["k7", "k1999", "none"])
    assert {r.key: r.value for r in some.collect()} == {"k7": "v7", "k1999": "v1999"}
    assert files_read(every) == 32 and 1 <= files_read(some) <= 3
    assert content(spark, p, keys=[]) == {}
    with pytest.raises(ValueError, match="DataFrame"):
        keyed.read(spark, p, keys=[str(i) for i in range(keyed.MOST_KEYS + 1)])
    named = spark.createDataFrame([("k3",), ("k3",), ("zz",), (None,)], "key string")
    assert content(spark, p, keys=named) == {"k3": "v3"}


def test_parts_are_sorted_and_carry_bloom_filters(spark, tmp_path):
    import pyarrow.parquet as pq

    p = str(tmp_path / "t")
    put(spark, p, 1, [(f"k{i}", "v") for i in range(500)], buckets=2)
    for folder, _, names in os.walk(p):
        for name in names:
            if name.endswith(".parquet"):
                keys = pq.read_table(os.path.join(folder, name), columns=["key"], partitioning=None)["key"].to_pylist()
                assert keys == sorted(keys)
                size = os.path.getsize(os.path.join(folder, name))
                assert size > 100_000       # the filter's blocks: far more than 250 short keys


def test_no_table(spark, tmp_path):
    with pytest.raises(ValueError, match="no keyed table"):
        keyed.read(spark, str(tmp_path / "none"))


# --- dictionary files: the last line wins -----------------------------------------------------


def test_last_line_wins_however_files_are_split(spark, tmp_path):
    for name, start in (("b.txt", 3000), ("a.txt", 0), ("c.txt", 6000)):
        (tmp_path / name).write_text("".join(
            f"1\tname {start + i}\tx\ty\tcom.{i % 40}\n" for i in range(3000)) + "too\tshort\n")
    expected = {f"com.{k}": f"name {6000 + 2960 + k}" for k in range(40)}
    for size in ("2k", "16k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            df = read_app_dictionary(spark, str(tmp_path), duplicates="last")
            assert {r.key: r.value for r in df.collect()} == expected
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    smallest = read_app_dictionary(spark, str(tmp_path)).collect()
    assert {r.key: r.value for r in smallest}["com.0"] == "name 0"
    with pytest.raises(ValueError):
        read_app_dictionary(spark, str(tmp_path), duplicates="first")
    out = str(tmp_path / "lookup")
    jobs.app_dictionary_job(spark, str(tmp_path / "*.txt"), out, duplicates="last")
    assert {r.key: r.value for r in spark.read.parquet(out).collect()} == expected


def test_last_line_needs_one_aggregate_and_no_sort_of_the_lines(spark, tmp_path):
    (tmp_path / "d.txt").write_text("1\tN\tx\ty\tk\n")
    text = read_app_dictionary(spark, str(tmp_path), duplicates="last")._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "rangepartitioning" not in text
    assert "partial_max_by" in text
