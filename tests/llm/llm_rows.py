"""Rows shared by the tests of the training-data operators."""

DATA = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def docs(spark, texts, start=0):
    """A documents table of texts, with a column whose name may clash."""
    rows = [(start + i, t, "en", "s", len(t or ""), "x", 1.0) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS + ", sha string, score double")


def exhaustive(index, texts):
    """(doc_id, item_id) whose exact checks hold in some window, of all windows and passages."""
    from adlumen.llm import decontamination as D

    code, found, masks = D._coder(index.block.terms), set(), []
    for p in index.block.passages:
        masks.append({t: sum(1 << i for i, x in enumerate(p.tolist()) if x == t) for t in set(p.tolist())})
    for d, text in texts.items():
        ids = code(text)
        for window in range(-(-len(ids) // D.STRIDE)):
            words = ids[max(window - 1, 0) * D.STRIDE: (window + 4) * D.STRIDE]
            words = words[words >= 0].tolist()
            for k, p in enumerate(index.block.passages):
                if len(words) < D.PARAPHRASE * len(p):
                    continue
                share = D.common_subsequence(masks[k], len(p), words) / len(p)
                answer = len(index.answers[k].intersection(words)) / len(index.answers[k])
                if share >= D.VERBATIM or (share >= D.PARAPHRASE and answer >= D.ANSWER):
                    found.add((d, index.block.items[k]))
    return found
