"""Substring removal, the conversation trie and whitening against brute force."""

import hashlib
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest

from adlumen.llm import prefix_trie, queries, suffix_dedup, whitening

# --- suffix-array dedup ----------------------------------------------------------------


def expected_removals(texts, window):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + window] for b in raw for i in range(len(b) - window + 1))
    out = []
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                gone[i:i + window] = [True] * window
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("window", [1, 4, 12, 40, 120, 400])
def test_every_difference_is_covered(window):
    v, residues = suffix_dedup.difference_cover(window)
    assert {(a - b) % v for a in residues for b in residues} == set(range(v))
    assert window - v + 1 >= 0.3 * window


@pytest.mark.parametrize("window, segment, block", [
    (12, 1 << 18, 1 << 20),     # whole documents, one block a task
    (12, 50, 300),              # documents over several segments and blocks
    (40, 64, 500),
    (3, 1000, 100),             # every position sampled
])
def test_removed_bytes(spark, window, segment, block):
    rng = random.Random(window)
    base = ["".join(rng.choice("abé") for _ in range(rng.randint(0, 300))) for _ in range(20)]
    texts = [None, "", "x" * 500, "x" * 500, *base, *base[:3]]      # nulls, runs, exact copies
    for _ in range(30):
        a = rng.choice(base)
        i = rng.randint(0, len(a))
        texts.append("".join(rng.choice("cdefgh") for _ in range(rng.randint(0, 150)))
                     + a[i:rng.randint(i, len(a))] + "".join(rng.choice("ijkl") for _ in range(20)))
    rows = [(i, t, "en", 0) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, block string, data int").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.remove_repeats(docs, window, segment, block).collect()}
    assert got == dict(enumerate(expected_removals(texts, window)))


def test_removal_of_rows_without_a_name_and_of_an_empty_table(spark):
    schema = "doc_id bigint, text string"
    rows = [(None, "abcdefgh" * 2), (7, "abcdefgh" * 2), (7, "zzz"), (None, None)]
    got = suffix_dedup.remove_repeats(spark.createDataFrame(rows, schema), 12).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans) for r in got) == [(0, 0, 0), (3, 0, 0), (16, 16, 1), (16, 16, 1)]
    assert suffix_dedup.remove_repeats(spark.createDataFrame([], schema), 12).count() == 0


@pytest.mark.parametrize("window, segment, block", [(12, 1 << 18, 1 << 20), (12, 50, 300)])
def test_kept_bytes_and_spans(spark, window, segment, block):
    rng = random.Random(1)
    passage = "é".join("".join(rng.choice("abc") for _ in range(9)) for _ in range(20))
    texts = [None, "", "".join(map(chr, range(300, 900))), "p" + passage + "q", "rs" + passage[3:] + "t" + passage[:40]]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: r for r in suffix_dedup.kept_texts(docs, window, segment, block).collect()}
    assert len(got) == len(texts)
    for k, (n_bytes, n_removed, n_spans, kept_sha256) in enumerate(expected_removals(texts, window)):
        raw, r = (texts[k] or "").encode(), got[k]
        spans = [(x.start, x.start + x.length) for x in r.spans]
        assert (r.n_bytes, sum(x.length for x in r.spans), len(spans)) == (n_bytes, n_removed, n_spans)
        assert all(a[1] < b[0] for a, b in zip(spans, spans[1:], strict=False))      # maximal, in order
        kept = bytes(x for i, x in enumerate(raw) if not any(lo <= i < hi for lo, hi in spans))
        assert bytes(r.kept) == kept and hashlib.sha256(kept).hexdigest() == kept_sha256
    assert bytes(got[2].kept).decode() == texts[2] and bytes(got[3].kept) == b"pq"


def test_query_gives_the_text_that_stays(spark, tmp_path):
    rng = random.Random(2)

    def words(n):
        return " ".join("".join(rng.choice("abcdefghijklé") for _ in range(8)) for _ in range(n))

    passage, clean = words(60), words(80)
    texts = ["a " + passage + " b", "c " + passage + " d", clean, None]
    # the copies differ in their last character's last byte, so the repeat ends inside it
    texts += ["1" + "x" * 400 + "é", "2" + "x" * 400 + "è"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    out = queries.op11_suffix_array_dedup(spark, str(tmp_path))
    assert out.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"]
    got = {r.doc_id: r.text for r in out.collect()}
    # the blanks beside the passage belong to the repeat
    assert got == {0: "ab", 1: "cd", 2: clean, 3: "", 4: "1\ufffd", 5: "2\ufffd"}


# --- conversation trie ---------------------------------------------------------------------


def conversations():
    rng, rows = random.Random(5), []
    for c in [*range(-30, 90), None]:
        first = rng.randint(0, 3)
        for t in range(rng.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, rng.choice([t, t, t, None]), rng.choice(["u", "a", None]),
                         f"w{first if t < 3 else rng.randint(0, 2)} x" if rng.random() < 0.9 else None))
    rows += rows[-3:]                                                   # repeated rows
    rows += [(777, t, "u", f"long {t % 5}") for t in range(700)]        # one long conversation
    rows += [(c, t, "u", "same") for c in (800, 801, 820, 840) for t in range(50)]
    rows += [(c, 0, "u", "hello") for c in range(900, 1000)]            # a hot first turn
    return rows


CONVERSATIONS = "conv_id bigint, turn bigint, role string, text string"


@pytest.mark.parametrize("capacity, chunk, piece", [(1, 4096, 7), (40, 16, 8192), (4096, 4096, 8192)])
def test_trie_nodes(spark, monkeypatch, capacity, chunk, piece):
    """Everything burst, some levels burst, and containers below the root only."""
    monkeypatch.setattr(prefix_trie, "CHUNK", chunk)
    monkeypatch.setattr(prefix_trie, "PIECE", piece)
    rows = conversations()
    con = duckdb.connect()
    con.execute("create table conversations(conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    expected = con.execute(queries.ORACLES["op12_prefix_trie"]).fetchall()
    names = [d[0] for d in con.description]
    table = spark.createDataFrame(rows, CONVERSATIONS).repartition(6)
    got = prefix_trie.conversation_trie(table, capacity=capacity).select(*names).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))


def test_trie_of_an_empty_table_and_of_turnless_conversations(spark):
    empty = spark.createDataFrame([], CONVERSATIONS)
    assert prefix_trie.conversation_trie(empty).count() == 0
    # conversation 1 loses its turns: h(1) = crc32("1") % 4 = 3, and there is no conversation 0
    one = spark.createDataFrame([(1, 0, "u", "a b")], CONVERSATIONS)
    (root,) = prefix_trie.conversation_trie(one).collect()
    assert (root.conv_id, root.depth, root.parent_conv_id, root.n_convs, root.n_leaves) == (1, 0, None, 1, 1)
    assert root.ends_sha256 == hashlib.sha256(b"1").hexdigest()


# --- whitening --------------------------------------------------------------------------


def test_cross_products_are_exact():
    rng = np.random.default_rng(3)
    x = rng.integers(0, 1 << 40, (131, 5)).astype(np.uint64)
    x[:, 2] = 0
    exact = x.astype(object).T @ x.astype(object)
    assert {(i, j): s for i, j, s in whitening.cross_products(x)} == {
        (i, j): exact[i, j] for i in range(5) for j in range(i, 5)}


def test_whitening(spark):
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(20, 20))
    vectors = (rng.normal(size=(300, 20)) @ mix).astype(np.float32)
    vectors[200:] = vectors[0]                                  # a hot vector counts once
    odd = [None, [float("nan")] * 20, [float("inf")] * 20, [1.0, None] + [0.0] * 18, [], [1.0, 2.0], [3e38] * 20]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(vectors)] + [(1000 + i, v, "y") for i, v in enumerate(odd)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, n string").repartition(4)
    got = whitening.whiten(table).orderBy("vec_id", "component").collect()
    assert len(got) == 300 * 16 and {r.vec_id for r in got} == set(range(300))

    x = np.floor(64 * vectors.astype(np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    expected = (x - total / n) @ axes[:, :16] / np.sqrt(values[:16])
    found = np.array([r.whitened for r in got]).reshape(300, 16)
    signs = np.sign((found * expected).sum(axis=0))
    assert np.abs(found * signs - expected).max() < 1e-6
    assert {r.n for r in got} == {n} and got[0].identity_error < 1e-9
    assert [int(r.deviation) for r in got[::16]] == [int(d) for d in ((n * x - total) ** 2).sum(axis=1)]
    assert all(math.isclose(r.explained, e, rel_tol=1e-9) for r, e in zip(got, values[:16] / values.sum(), strict=False))


def test_whitening_without_variance(spark):
    schema = "vec_id bigint, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).count() == 0
    # a constant dimension has no component
    out = whitening.whiten(spark.createDataFrame([(1, [0.0, 5.0]), (2, [1.0, 5.0])], schema)).collect()
    assert [(r.component, abs(round(r.whitened, 9))) for r in out] == [(1, 1.0), (1, 1.0)]
