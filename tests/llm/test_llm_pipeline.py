"""The corpus pipeline, stage by stage, against brute force on a small table."""

import llm_rows as helpers

import corpus_pipeline as P
from adlumen.llm import decontamination as D
from adlumen.llm import simhash_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def every_leak(spark, docs):
    """Documents with a passage of the benchmark, by an exact check of every window, without a candidate search."""
    left = {r.doc_id: r.text for r in docs.collect()}
    found = set()
    for block in D.benchmark_blocks(spark.read.parquet(f"{helpers.DATA}/benchmark.parquet")):
        found |= {d for d, _ in helpers.exhaustive(D.build_index(docs, block), left)}
    return found


def test_stages(spark):
    rows = spark.read.parquet(f"{helpers.DATA}/documents.parquet")
    letters = spark.createDataFrame([(9001, "123 456", "en", "s", 7), (9002, None, None, None, None),
                                     (9003, rows.first().text.upper(), "en", "s", 1)], helpers.DOCS)
    every = rows.unionByName(letters)
    a = P.language_id(spark, every, helpers.DATA)
    kept = {r.doc_id: r.text for r in a.collect()}
    assert set(kept) == {r.doc_id for r in every.collect()} - {9001, 9002} and a.columns == list(P.COLUMNS)
    b = P.exact(spark, a.unionByName(a.where("doc_id = 5")), helpers.DATA)  # one row repeated
    best = {}
    for d, t in kept.items():
        best[t.translate(LOWER)] = max(d, best.get(t.translate(LOWER), -1))
    left = {r.doc_id: r.text for r in b.collect()}
    assert sorted(left) == sorted(best.values()) and b.count() == len(left)
    c = P.near(spark, b, helpers.DATA)
    fp = {d: simhash_dedup.simhash(t.translate(LOWER)) for d, t in left.items()}
    parent = {d: d for d in fp}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(fp)
    for i in ids:
        for j in ids:
            if j < i and (fp[i] ^ fp[j]).bit_count() <= 4:
                x, y = sorted((find(i), find(j)))
                parent[y] = x
    assert sorted(r.doc_id for r in c.collect()) == sorted({find(d) for d in ids})
    d = P.decontaminate(spark, c, helpers.DATA)
    leaks = {r.doc_id for r in c.collect()} - {r.doc_id for r in d.collect()}
    assert d.columns == list(P.COLUMNS) and leaks == every_leak(spark, c)
    e = P.pack(spark, d, helpers.DATA)
    assert {r.doc_id for r in e.collect()} == {r.doc_id for r in d.collect()}
    assert [n for n, _ in P.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup",
                                        "benchmark_decontamination", "best_fit_packing"]


def test_rows_without_a_doc_id_are_judged_like_others(spark):
    text = [r.text for r in spark.read.parquet(f"{helpers.DATA}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    clean = max(text, key=lambda t: len(t or ""))
    leak = spark.read.parquet(f"{helpers.DATA}/benchmark.parquet").orderBy("item_id").first().text
    rows = [(7, clean, "en", "s", 1), (None, clean + " end", "en", "s", 2), (None, "before it " + leak, None, "s", 3),
            (None, "unlike any of the others , this stays", None, None, None), (None, None, None, None, None), (3, "also stays here", "en", "s", 4)]
    docs = spark.createDataFrame(rows, helpers.DOCS)
    near = P.near(spark, docs, helpers.DATA)
    assert sorted((r.n_chars or 0) for r in near.collect()) == [0, 0, 1, 3, 4]  # the row with a doc_id stays
    left = P.decontaminate(spark, near, helpers.DATA)
    assert sorted((r.n_chars or 0) for r in left.collect()) == [0, 0, 1, 4]
    assert P.near(spark, docs.where("doc_id is null"), helpers.DATA).count() == 4
    assert P.decontaminate(spark, P.near(spark, docs.limit(0), helpers.DATA), helpers.DATA).collect() == []
