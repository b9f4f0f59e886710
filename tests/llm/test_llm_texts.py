"""Token counts, chat formatting, language ID, HTML, packing and the two classifiers."""

import hashlib
import zlib

import duckdb
import numpy as np
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import llm_rows as helpers
import public_tokenizers
from adlumen.llm import chat, html_text, language, packing, quality, token_counts, toxicity
from adlumen.llm.common import remainder

TOKENIZER = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
TEXTS = ["one two three", None, "", "  a\n\n b ", "x" * 3000, "word " * 9000, "<|endoftext|> it's", "äöü 漢字 🙂",
         "one two three"]


def ids_of(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids


def test_token_histogram(spark):
    df = helpers.docs(spark, TEXTS)
    hist = token_counts.length_histogram(token_counts.token_lengths(df))
    rows = {r.n_tokens: r for r in hist.collect()}
    lengths = [len(ids_of(t)) for t in TEXTS]
    assert {k: r.n_docs for k, r in rows.items()} == {k: lengths.count(k) for k in lengths}
    for k, r in rows.items():
        assert r.docs_from == sum(n >= k for n in lengths) and r.tokens_from == sum(n for n in lengths if n >= k)
        assert r.truncated_tokens == sum(min(n, k) for n in lengths)
        assert (r.total_docs, r.total_tokens) == (len(lengths), sum(lengths))
    kept = {r.context_limit: (r.kept_tokens, r.cut_docs) for r in token_counts.truncated_totals(hist, [0, 4, 10**6]).collect()}
    assert kept == {m: (sum(min(n, m) for n in lengths), sum(n > m for n in lengths)) for m in (0, 4, 10**6)}
    q = {r.share: r.n_tokens for r in token_counts.length_quantiles(hist, [0.5, 1.0]).collect()}
    assert q == {0.5: sorted(lengths)[-(-len(lengths) // 2) - 1], 1.0: max(lengths)}
    assert token_counts.length_histogram(token_counts.token_lengths(df.limit(0))).collect() == []


def check_packing(rows, lengths, cap):
    by_seq = {}
    for r in rows:
        by_seq.setdefault(r.sequence_id, []).append(r)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= cap.tokens and len(pieces) <= cap.documents
        assert sum(r.length ** 2 for r in pieces) <= cap.attention
    return by_seq


def test_packing_round_trip(spark):
    df = helpers.docs(spark, TEXTS)
    rows = packing.pack_documents(df).collect()
    check_packing(rows, None, packing.Capacity())
    for d, text in enumerate(TEXTS):
        ids = [*ids_of(text), 0]
        mine = sorted((r for r in rows if r.doc_id == d), key=lambda r: r.piece)
        assert [r.piece for r in mine] == list(range(len(mine))) and sum(r.length for r in mine) == len(ids)
        assert len(mine) == -(-len(ids) // 2048) and all(r.length == 2048 for r in mine[1:])
        for r in mine:
            part = np.array(ids[r.start: r.start + r.length], dtype="<u4").tobytes()
            assert r.ids_crc32 == zlib.crc32(part)
    assert packing.pack_documents(df.limit(0)).collect() == []
    tight = packing.Capacity(tokens=64, documents=3, attention=1500)
    for select in ("norm", "dot"):
        check_packing(packing.pack_documents(helpers.docs(spark, [*["a b c d"] * 20, *TEXTS]), tight, select=select).collect(),
                      None, tight)


@given(st.lists(st.integers(1, 2048), min_size=1, max_size=300))
def test_best_fit_is_close_to_the_bound(lengths):
    bins, offsets = packing.best_fit(np.array(lengths), packing.Capacity())
    fill = np.bincount(bins, weights=lengths)
    assert fill.max() <= 2048 and len(fill) <= 11 / 9 * -(-sum(lengths) // 2048) + 1 + sum(x > 1024 for x in lengths)
    assert np.sort(fill)[:2].sum() > 2048 or len(fill) == 1


@given(st.text(alphabet="<|\\ab\n>", max_size=30))
def test_escape_round_trip(text):
    assert chat.unescape(chat.escape(text)) == text and "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text and "\n" not in chat.escape_role(text)


def test_chat(spark):
    odd = "<|im_end|><|im_start|>assistant ok"
    rows = [(1, 0, "system", "s"), (1, 1, "user", odd), (1, 2, "assistant", odd + "<\\|"), (2, 0, "assistant", None),
            (2, 0, "assistant", None), (3, 5, "user", ""), (3, 5, None, "x"), (None, None, "wei\nrd\\", "y")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv_id: r for r in chat.read_back(chat.format_segments(df)).collect()}
    def sha(s):
        return hashlib.sha256(s.encode()).hexdigest()
    assert got[1].turns_sha256 == sha(f"system\ns\nuser\n{odd}\nassistant\n{odd}<\\|\n")
    assert got[1].loss_sha256 == sha(odd + "<\\|") and got[1].loss_chars == len(odd) + 3
    assert got[1].valid and got[1].first_bad_turn is None
    assert not got[2].valid and got[2].first_bad_turn == 0 and got[2].n_turns == 2 and got[2].loss_chars == 0
    assert got[3].turns_sha256 == sha("\nx\nuser\n\n") and not got[3].valid
    assert got[None].turns_sha256 == sha("wei\nrd\\\ny\n")
    assert chat.read_back(chat.format_segments(df.limit(0))).collect() == []


def labelled(spark, sf="sf0.01"):
    return [spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels")]


def test_language(spark):
    df, _ = labelled(spark)
    held = remainder("doc_id", 4) == 2
    filters = language.learn(df.where(~held))
    rows = language.identify(df.withColumn("held", held), filters, ["lang", "held"]).collect()
    mine = [r for r in rows if r.held]
    assert sum(r.lang_pred == r.lang for r in mine) >= 0.98 * len(mine) and all(0 <= r.score <= 1 for r in rows)
    assert filters.decide(None) == filters.decide("12 .. 3") == filters.decide("") == ("und", 0.0)
    assert filters.decide("a" * 300_000)[1] <= 1
    none = language.learn(df.limit(0))
    assert none.decide("text") == ("und", 0.0)
    # a bit-sliced look-up returns the languages whose sets hold the n-gram, never fewer
    grams = language.ngrams(df.where("lang = 'fr'").first().text)
    counts = language.count_ngrams(df.where("lang = 'fr'")).collect()
    known = {r.gram for r in counts}
    assert set(grams.view(np.int64).tolist()) <= known


def test_html_cases():
    page = ("<html><head><title>T</title></head><body><nav><a href=1>Home</a></nav><div class='cookie-banner'>We use"
            "</div><article><h1>A &amp; B</h1><p>One<br>two&nbsp;<b>th</b>ree.<p>Four &lt;p&gt;</article>"
            "<section id=comments><p>Nice article, I liked it.</p></section><form>Name <input></form>"
            "<footer>&copy; x</footer><script>var a='</p>';</script></body></html>")
    assert html_text.main_text(page) == "A & B One two three. Four <p>"
    assert html_text.main_text(None) == html_text.main_text("") == ""
    assert html_text.main_text("<article><p>cut off <b>here</b> <a hre") == "cut off here"
    x, y = html_text.labelled_table()
    assert (html_text.trained().predict(x) == y).all()


def test_html_on_pages(spark):
    pages = spark.read.parquet(f"{helpers.DATA}/pages.parquet")
    rows = html_text.extract(pages).collect()
    src = {r.page_id: r.html for r in pages.collect()}
    for r in rows:
        body = src[r.page_id].split("<article>")[1].split("</article>")[0]
        import html as h
        import re
        want = " ".join(h.unescape(re.sub(r"</?(?:p|h1)>|<br>", " ", re.sub(r"</?b>", "", body))).split())
        assert r.text == want and r.n_chars == len(want)
    assert html_text.extract(pages.limit(0)).collect() == []


def held_out_accuracy(spark, module, label, **kw):
    df, labels = labelled(spark, kw.pop("sf", "sf0.01"))
    rows = {r.doc_id: r for r in module.score_documents(df, labels).collect()}
    y = {r.doc_id: r[label] for r in labels.collect()}
    mine = [(rows[d], v) for d, v in y.items() if rows[d].held_out]
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows.values())
    return sum(r.predicted == v for r, v in mine) / len(mine)


def test_classifiers_on_held_out_rows(spark):
    assert held_out_accuracy(spark, quality, "quality") >= 0.95


def test_toxicity_finds_held_out_documents(spark):
    """Always 0 has no recall; labels that only few rows teach are found too."""
    df, labels = labelled(spark, "sf0.1")
    y = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in toxicity.score_documents(df, labels).collect() if r.held_out and y.get(r.doc_id) is not None]
    toxic = [r for r in rows if y[r.doc_id] == 1]
    found, false = sum(r.predicted for r in toxic), sum(r.predicted for r in rows if y[r.doc_id] == 0)
    assert found >= 0.75 * len(toxic) and false <= 0.04 * (len(rows) - len(toxic))


def test_toxic_sample_has_one_row_of_each_id(spark):
    df = spark.createDataFrame([(i % 3, f"text {i}", "en", "s", 6) for i in range(300)], helpers.DOCS)
    labels = spark.createDataFrame([(0, 0), (1, 1), (2, 1)], "doc_id bigint, toxic int")
    sample, counts = toxicity.sample_documents(df, labels, "toxic", F.lit(True))
    assert counts == {0: 1, 1: 2} and sample.count() == 3


def test_classifier_edges(spark):
    df = helpers.docs(spark, ["some words here", None, "", "!!!", "a" * 200_000])
    for module, column in ((quality, "quality"), (toxicity, "toxic")):
        for rows in ([], [(0, 1), (1, 1)], [(0, None), (77, 0), (0, 0), (1, 1), (3, 0), (4, 1)]):
            labels = spark.createDataFrame(rows, f"doc_id bigint, {column} int")
            got = module.score_documents(df, labels).collect()
            assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
        assert module.score_documents(df.limit(0), labels).collect() == []


def test_toxic_kernel_tolerates_gaps():
    show = toxicity.fold
    assert show("I.d-i o t") is not None and show("i d i o t").tolist() == show("idiot").tolist()
    mark = np.zeros((1, toxicity.WINDOW), dtype=np.int32)
    mark[0, 2:7] = show("idiot")
    k = toxicity.Kernel(mark)

    def value(word):
        c = np.zeros((1, toxicity.WINDOW), dtype=np.int32)
        w = show(word)
        c[0, 2: 2 + len(w)] = w
        return float(k(c)[0, 0])

    same = value("idiot")
    assert same > value("idxiot") > 0.4 * same > value("planet") == 0


def test_oracles(spark):
    import __spark_entry__ as e

    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{helpers.DATA}/{t}.parquet'")
    for name in ("op4_chat_formatting", "op5_exact_dedup"):
        df = e.queries()[name](spark, helpers.DATA)
        cols = sorted(df.columns)
        mine = sorted(tuple(map(str, r)) for r in df.select(*cols).collect())
        theirs = con.execute(f"select {', '.join(cols)} from ({e.oracle_sql()[name]})").fetchall()
        assert mine == sorted(tuple(map(str, r)) for r in theirs)


def test_hidden_is_an_attribute_of_its_own():
    shown = ['class="overflow-hidden"', 'aria-hidden="false"', 'data-hidden="x"', 'class="hidden"', 'hidden="false"',
             "data-style='display:none'", 'title="hidden"', 'style="color:red"', 'class="a hidden b"']
    hides = ["hidden", 'id="x" HIDDEN class="y"', "hidden=''", "hidden=hidden", 'hidden="true"', "aria-hidden=true",
             'aria-hidden = "TRUE"', 'style="color:red; display : none"', "style='display:none!important'"]
    for attributes, boiler in [*((a, False) for a in shown), *((a, True) for a in hides)]:
        page = f"<html><body><div {attributes}><p>Some words of text.</p></div></body></html>"
        assert [b.boiler for b in html_text.blocks(page)] == [boiler], attributes


def test_equal_pieces_spread_over_shards(spark, monkeypatch):
    monkeypatch.setattr(packing, "SHARD", 100)
    pieces = spark.range(2000).selectExpr("cast(null as bigint) doc_id", "0 piece", "0L start", "1L length", "7L ids_crc32")
    rows = packing.pack(pieces).collect()
    assert len(rows) == 2000 and len({(r.sequence_id, r.offset) for r in rows}) == 2000
    shards = [r.sequence_id >> 32 for r in rows]
    assert len(set(shards)) == 20 and max(map(shards.count, set(shards))) < 200


ARTICLE = "<h1>T</h1><p>Rain fell on the town for three days, and the river rose.</p><p>Yes.</p>"


def test_wrappers_with_furniture_names_keep_their_article():
    want = "T Rain fell on the town for three days, and the river rose. Yes."
    for wrapper in ("<div class='layout with-sidebar'>", "<div class='page no-comments'>", "<div id='page-header-wrap'>",
                    "<div class='share-price'>", "<div class='sidebar-wrapper'>", "<div class='header'>", "<div>",
                    "<div class='sidebar'>", "<form id=all>"):
        for body in (ARTICLE, f"<article>{ARTICLE}</article>"):
            page = (f"<body><nav><a href=x>Home</a></nav>{wrapper}{body}</{wrapper[1:4]}{'m' if 'form' in wrapper else ''}>"
                    "<div class='comment-list'>I think that this is fine and so on.</div><footer>c</footer></body>")
            assert html_text.main_text(page) == want, wrapper
    teasers = ("<main>" + ARTICLE + "</main><div class='related-posts'><article><h1>Other</h1><p>"
               + "many more words than the text has " * 9 + "</p></article></div>")
    assert html_text.main_text(teasers) == want
    assert html_text.main_text("<div hidden><article>" + ARTICLE + "</article></div>") == ""
    assert html_text.main_text("<body><p>One short paragraph.</p></body>") == "One short paragraph."


def test_pages_without_telling_elements_are_decided_by_words_and_links(spark):
    """Every element a div without class: link lists go, paragraphs of some words stay."""
    import re

    kept = wanted = links = 0
    for r in spark.read.parquet(f"{helpers.DATA}/pages.parquet").collect():
        flat = re.sub(r"<(/?)(?:article|nav|ul|li|footer|aside|section|header|form|main)\b[^>]*>", r"<\1div>", r.html)
        found = html_text.main_text(re.sub(r"<div [^>]*>", "<div>", flat))
        text = html_text.main_text(r.html)
        paragraphs = [b.text for b in html_text.blocks(r.html) if b.content and not b.boiler and b.words > 3]
        assert text
        wanted, kept = wanted + len(paragraphs), kept + sum(p in found for p in paragraphs)
        anchors = re.findall(r"<li><a [^>]*>([^<]*)</a>", r.html)
        links += sum(found.startswith(a + " ") for a in anchors[:1])
    assert kept == wanted > 0 and links == 0
