"""Exact dedup, SimHash near-dedup and decontamination against brute force."""

import hashlib
import os
import random
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

import llm_rows as helpers
from adlumen.llm import decontamination, exact_dedup, simhash_dedup


LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_fingerprints_combine():
    a, b = os.urandom(10_000), os.urandom(5_001)
    for w in (0, 1):
        p, base = exact_dedup.PRIMES[w], exact_dedup.BASES[w]
        plain = 0
        for x in a + b:
            plain = (plain * base + x) % p
        assert exact_dedup.fingerprint(a + b, w) == plain
        assert exact_dedup.combine(exact_dedup.fingerprint(a, w), exact_dedup.fingerprint(b, w), len(b), w) == plain


def expected_classes(rows):
    groups = defaultdict(list)
    for d, t in rows:
        groups[(t or "").translate(LOWER)].append(d)
    return groups


def test_exact_dedup_cases(spark, monkeypatch):
    long = "Äb c" * 40_000
    texts = ["a b", "A B", None, "", "x", long, long.replace("b", "B"), long + "x", "ä", "Ä"]
    df = helpers.docs(spark, texts)
    got = {r.doc_id: r for r in exact_dedup.exact_duplicates(df).collect()}
    for norm, ids in expected_classes(enumerate(texts)).items():
        for d in ids:
            assert (got[d].keep_id, got[d].group_size, got[d].kept) == (max(ids), len(ids), d == max(ids))
            assert got[d].text_sha256 == hashlib.sha256(norm.encode()).hexdigest()
    # repeated rows: one stays; a null doc_id is the smallest; an empty table has no rows
    same = spark.createDataFrame([(1, "q"), (1, "q"), (None, "q"), (None, "w"), (2, long), (2, long)],
                                 "doc_id bigint, text string")
    rows = exact_dedup.exact_duplicates(same).collect()
    assert sorted((r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in rows) == [
        (0, 0, 1, True), (0, 1, 3, False), (1, 1, 3, False), (1, 1, 3, True), (2, 2, 2, False), (2, 2, 2, True)]
    assert exact_dedup.exact_duplicates(df.limit(0)).collect() == []
    # colliding fingerprints are told apart by comparing the texts
    monkeypatch.setattr(exact_dedup, "_hashed", _colliding(exact_dedup._hashed))
    hit = exact_dedup.exact_duplicates(helpers.docs(spark, ["aa", "bb", "aa", "cc", "bb", "cc"])).collect()
    assert {r.doc_id: r.keep_id for r in hit} == {0: 2, 1: 4, 2: 2, 3: 5, 4: 4, 5: 5}


def test_exact_dedup_of_colliding_rows_without_a_name(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "_hashed", _colliding(exact_dedup._hashed))
    monkeypatch.setattr(exact_dedup, "REPEATS", 2)
    rows = [(5, "aa"), (None, "bb"), (None, "bb"), (3, "bb"), (2, "cc"), (None, "cc"), (None, "dd"), (None, "dd"),
            (4, "ee"), (4, "ee"), (4, "ee"), (4, "ff")]
    out = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept) for r in out) == sorted([
        ("5", "5", 1, True), ("None", "3", 3, False), ("None", "3", 3, False), ("3", "3", 3, True),
        ("2", "2", 2, True), ("None", "2", 2, False), ("None", "None", 2, True), ("None", "None", 2, False),
        ("4", "4", 3, True), ("4", "4", 3, False), ("4", "4", 3, False), ("4", "4", 1, True)])


def test_exact_dedup_hashes_huge_texts_in_parts_only(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "HUGE_CHARS", 1000)
    monkeypatch.setattr(exact_dedup, "PART_CHARS", 300)
    longest = []
    whole = exact_dedup._hashed
    monkeypatch.setattr(exact_dedup, "_hashed", lambda df: longest.append(df) or whole(df))
    df = helpers.docs(spark, ["ab" * 2000, "AB" * 2000, "ab" * 1999 + "xy", "short"])
    kept = {r.doc_id: r.keep_id for r in exact_dedup.exact_duplicates(df).collect()}
    assert kept == {0: 1, 1: 1, 2: 2, 3: 3}
    assert max(r.n for d in longest for r in d.selectExpr("length(text) as n").collect()) <= 1000


def test_exact_dedup_compares_repeated_rows_once(spark, monkeypatch):
    monkeypatch.setattr(exact_dedup, "BUCKET", 4)
    rows, compared = [(7, "same text")] * 60 + [(5, "same text"), (6, "SAME text"), (1, "x"), (2, "y"), (2, "y")], []
    once = exact_dedup._cut
    monkeypatch.setattr(exact_dedup, "_cut", lambda df, size: compared.append(df) or once(df, size))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = exact_dedup.exact_duplicates(df).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out) == sorted(
        [(7, 7, 62, False)] * 59 + [(7, 7, 62, True), (5, 7, 62, False), (6, 7, 62, False), (1, 1, 1, True),
                                    (2, 2, 2, False), (2, 2, 2, True)])
    dealt = [d for d in compared if "bucket" in d.columns]
    assert [d.where("leads").count() for d in dealt] == [2]  # one row for each of the two leaders
    # rows that collide, and of which only repeats are equal
    monkeypatch.setattr(exact_dedup, "_hashed", _colliding(exact_dedup._hashed))
    hit = exact_dedup.exact_duplicates(spark.createDataFrame([(1, "aa"), (1, "aa"), (2, "bb")], df.schema)).collect()
    assert sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in hit) == [
        (1, 1, 2, False), (1, 1, 2, True), (2, 2, 1, True)]


def _colliding(f):
    return lambda *a, **k: f(*a, **k).withColumns({"h1": F.lit(1).cast("bigint"), "h2": F.lit(1).cast("bigint")})


def test_simhash_matches_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(25):
        base = [rng.choice(words) for _ in range(120)]
        for _ in range(rng.randrange(1, 6)):
            one = list(base)
            one[rng.randrange(120)] = "changed"
            texts.append(" ".join(one))
    texts += [None, "", "A b", "a\tB", "only three words", *[" ".join(words) + f" tail{i}" for i in range(40)]]
    ids = {i: simhash_dedup.simhash((t or "").translate(LOWER)) for i, t in enumerate(texts)}
    parent = list(range(len(texts)))

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for i in ids:
        for j in range(i):
            if (ids[i] ^ ids[j]).bit_count() <= 4:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    df = helpers.docs(spark, texts)
    for crowd in (simhash_dedup.CROWD, 3):  # also with every crowded anchor cut into blocks
        monkeypatch.setattr(simhash_dedup, "CROWD", crowd)
        got = simhash_dedup.near_duplicates(df).collect()
        assert {r.doc_id: (r.fingerprint, r.component_id) for r in got} == {
            i: (f"{ids[i]:016x}", find(i)) for i in ids}
    assert simhash_dedup.near_duplicates(df.limit(0)).collect() == []


def test_every_pair_within_reach_shares_an_anchor():
    rng = np.random.default_rng(1)
    for d in (1, 4, 5):
        excess = -(-(d // 2) // 2)
        for _ in range(300):
            x = int(rng.integers(0, 1 << 63))
            y = x
            for b in rng.choice(64, rng.integers(0, d + 1), replace=False):
                y ^= 1 << int(b)
            both = np.array([x, y], dtype=np.uint64).view(np.int64)
            who, where = simhash_dedup.anchors(both, excess)
            assert set(where[who == 0]) & set(where[who == 1])
            assert len(where) <= 2 * 2 * 17 or d > 4


def test_decontamination(spark):
    rng = random.Random(5)
    words = [f"{a}{b}" for a in "bcdfghjklm" for b in ("ato", "eri", "ola", "umi", "ine", "asu", "oko", "ety")]
    common = ["the", "of", "and", "to", "in"]
    def say(n):
        return [rng.choice(common) if rng.random() < 0.4 else rng.choice(words) + str(rng.randrange(9)) for _ in range(n)]
    items = [say(rng.randrange(18, 45)) for _ in range(30)]
    clean = [" ".join(say(200)) for _ in range(60)]
    leaks, expected = [], set()
    for k in range(30):
        p = list(items[k])
        if k % 3 == 1:
            p = [w.upper() + "," for w in p]
        if k % 3 == 2:
            del p[3], p[9]
            p.insert(5, "inserted")
        text = say(rng.randrange(0, 90)) + p + say(rng.randrange(0, 90))
        leaks.append(" ".join(text))
        expected.add((60 + k, k))
    df = helpers.docs(spark, clean + leaks + [None, ""])
    bench = spark.createDataFrame([*[(i, " ".join(p)) for i, p in enumerate(items)], (99, None), (98, "too short")],
                                  "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(df, bench).collect()}
    assert got == expected
    small = list(decontamination.benchmark_blocks(bench, 7))
    assert [len(b.passages) for b in small] == [7, 7, 7, 7, 2]
    assert decontamination.contaminated(df.limit(0), bench).collect() == []
    assert decontamination.contaminated(df, bench.limit(0)).collect() == []


def said(rng, n):
    return [rng.choice("bcdfghjklm") + rng.choice("aeiou") + rng.choice(("tor", "ril", "lan", "mus")) + str(rng.randrange(9))
            for _ in range(n)]


def test_excerpts_across_the_cuts_of_long_items(spark):
    rng = random.Random(11)
    sizes = [(96, 56, 20), (96, 64, 16), (58, 32, 13), (58, 40, 9), (96, 36, 30), (150, 40, 83)]
    items = [said(rng, n) for n, _, _ in sizes]
    texts = [" ".join(said(rng, 70) + item[at: at + size] + said(rng, 70))
             for item, (_, size, at) in zip(items, sizes, strict=True)]
    df = helpers.docs(spark, texts + [" ".join(said(rng, 200)) for _ in range(40)])
    bench = spark.createDataFrame([(i, " ".join(p)) for i, p in enumerate(items)], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id) for r in decontamination.contaminated(df, bench).collect()}
    assert got == {(i, i) for i in range(len(sizes))}
    for n in range(49, 200):  # three quarters of a passage's words in a row lie in one passage
        spans = decontamination.passage_spans(n)
        width = min(b - a for a, b in spans)
        need = -(-3 * width // 4)
        assert all(any(a <= x and x + need <= b for a, b in spans) for x in range(n - need + 1))


def test_copies_are_found_whatever_the_latent_space_says():
    rng = random.Random(12)
    items = [said(rng, rng.randrange(6, decontamination.PASSAGE + 1)) for _ in range(60)]
    texts = [" ".join(said(rng, rng.randrange(60)) + p + said(rng, rng.randrange(60))) for p in items]
    block = decontamination._make_block(list(range(60)), items)
    nothing = np.zeros((len(block.terms), 4), dtype=np.float32)  # no term has a place in the latent space
    index = decontamination.Index(block, nothing, np.zeros((60, 4), dtype=np.float32), np.ones(60, dtype=np.float32),
                                  [frozenset(p.tolist()) for p in block.passages])
    out = decontamination._search(index)({"doc_id": list(range(62)), "text": [*texts, None, "two words"]})
    assert sorted(zip(out["doc_id"], out["item_id"], out["share"], strict=True)) == [(i, i, 1.0) for i in range(60)]


def test_search_finds_what_a_check_of_every_window_finds(spark):
    """Also copies whose every third or fourth word is another, so that no three words in a row are left."""
    rng = random.Random(21)
    items = [said(rng, rng.randrange(16, 49)) for _ in range(40)]
    texts = [" ".join(said(rng, rng.randrange(200))) for _ in range(20)]
    for k, item in enumerate(items):
        n = (3, 3, 4, 5)[k % 4]
        copy = [w if i % n < n - 1 else said(rng, 1)[0] for i, w in enumerate(item)]
        texts.append(" ".join(said(rng, rng.randrange(60)) + copy + said(rng, rng.randrange(60))))
    docs = helpers.docs(spark, texts)
    bench = spark.createDataFrame([(i, " ".join(p)) for i, p in enumerate(items)], "item_id bigint, text string")
    (block,) = decontamination.benchmark_blocks(bench)
    every = helpers.exhaustive(decontamination.build_index(docs, block), dict(enumerate(texts)))
    assert len(every) >= 20
    assert {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, bench).collect()} == every


def test_singular_vectors_are_those_of_an_exact_svd():
    rng = np.random.default_rng(3)
    u, v = (np.linalg.qr(rng.standard_normal((n, 30)))[0] for n in (400, 200))
    a = (u * 0.5 ** np.arange(30)) @ v.T
    omega = rng.standard_normal((200, 18))
    got = decontamination.singular_vectors(omega, a.T @ (a @ omega), 8)
    assert got.shape == (200, 8) and np.allclose(np.abs(got.T @ v[:, :8]), np.eye(8), atol=1e-3)
    few = a[:3]  # of rank 3
    assert decontamination.singular_vectors(omega, few.T @ (few @ omega), 8).shape == (200, 3)


def test_blocks_are_bounded_by_passages_and_terms(spark, monkeypatch):
    rng = random.Random(22)
    bench = spark.createDataFrame([(0, " ".join(said(rng, 3000))), (1, " ".join(said(rng, 30)))], "item_id bigint, text string")
    whole = list(decontamination.benchmark_blocks(bench))
    assert len(whole) == 1
    by_passage = list(decontamination.benchmark_blocks(bench, 50))  # a block ends inside an item
    monkeypatch.setattr(decontamination, "CELLS", 20_000)
    by_cells = list(decontamination.benchmark_blocks(bench))
    assert all(len(b.passages) <= 50 for b in by_passage) and len(by_cells) > 2
    assert all(len(b.passages) * len(b.terms) < 20_000 + 48 * len(b.passages) + len(b.terms) + 48 for b in by_cells)
    for blocks in (by_passage, by_cells):
        assert [i for b in blocks for i in b.items] == whole[0].items
        words = [[names[t] for t in p] for b in blocks for names in [list(b.terms)] for p in b.passages]
        assert words == [[list(whole[0].terms)[t] for t in p] for p in whole[0].passages]


def test_short_items_and_scripts_without_spaces(spark):
    rng = random.Random(13)
    han = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(30))
    thai = "".join(chr(0x0E01 + rng.randrange(40)) for _ in range(70))
    other = ["".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(25)) for _ in range(2)]
    items = [(1, "Two words"), (2, "alone!"), (3, han), (4, thai), (5, "one two three four five"), (6, "..."), (7, "two words"),
             (8, other[0][:3])]
    texts = ["here are two words, and more", "ALONE", other[0] + han + other[1], "x" + thai[15:] + "y", "one two three four",
             "zero one two three four five six", "words two", "二", None, ""]
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontamination.contaminated(helpers.docs(spark, texts), bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(0, 1), (0, 7), (1, 2), (2, 3), (3, 4), (5, 5), (2, 8)}
    assert decontamination.split_words("Ab c_1, é漢字kana") == ["ab", "c_1", "é", "漢", "字", "kana"]


def test_blocks_do_not_change_what_a_term_weighs(spark):
    rng = random.Random(14)
    bench = spark.createDataFrame([(i, " ".join(["so", "it", "is"] + said(rng, 12))) for i in range(50)]
                                  + [(50, "so it is so it is so it is")], "item_id bigint, text string")
    docs = helpers.docs(spark, [" ".join(said(rng, 100)) + " so it is so it is so it is"])
    orders = []
    for parts in (1, 7):  # the order of the rows does not matter either
        blocks = list(decontamination.benchmark_blocks(bench.repartition(parts), 25))
        orders.append([i for b in blocks for i in b.items])
        index = decontamination.build_index(docs, blocks[0])
        assert (np.linalg.norm(index.vectors, axis=1) > 0).all() and (blocks[0].counts().sum(axis=1) == 15).all()
    assert orders == [list(range(51))] * 2


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.randrange(5) for _ in range(rng.randrange(1, 20))]
        b = [rng.randrange(6) for _ in range(rng.randrange(0, 25))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        masks = {}
        for i, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << i
        assert decontamination.common_subsequence(masks, len(a), b) == t[-1][-1]
