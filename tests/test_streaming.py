from adlumen.schema import LOG_COLUMNS
from adlumen.streaming.etl import start_log_etl


def _line(sid):
    f = [""] * len(LOG_COLUMNS)
    f[0] = sid
    f[LOG_COLUMNS.index("requestmode")] = "1"
    return ",".join(f)


def test_incremental_etl_processes_each_file_once(spark, tmp_path):
    src, out, rej, ck = (str(tmp_path / n) for n in ("in", "out", "rej", "ck"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.txt").write_text(_line("a") + "\nbad,line\n")
    for q in start_log_etl(spark, src, out, ck, rejects_dir=rej, available_now=True):
        q.awaitTermination(120)
    assert sorted(r.sessionid for r in spark.read.parquet(out).collect()) == ["a"]
    (tmp_path / "in" / "b.txt").write_text(_line("b") + "\n")
    for q in start_log_etl(spark, src, out, ck, rejects_dir=rej, available_now=True):
        q.awaitTermination(120)
    assert sorted(r.sessionid for r in spark.read.parquet(out).collect()) == ["a", "b"]
    assert spark.read.parquet(rej).count() == 1
