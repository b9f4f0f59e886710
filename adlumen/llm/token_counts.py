"""Token counts: an exact length histogram answers every context limit.

Each document is encoded once; the documents are then aggregated by encoded
length (partial sums in every task).  Prefix and suffix sums over the lengths
give, for every limit, how many documents and tokens lie at or above it, what
truncation there keeps, and any quantile.

The running sums go by blocks of ``BLOCK`` lengths: a window inside each block
and one over the block totals, so the longest sequential part has at most
(longest document / BLOCK) rows.

Null and empty texts are documents of length 0.  Repeated rows count as often
as they occur.  An empty table gives an empty histogram.  Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from adlumen.llm.common import arrow_map
from adlumen.llm.tokens import encoder, vocabulary
from adlumen.session import materialize

BLOCK = 1024


def token_lengths(docs: DataFrame, text: str = "text", path: str | None = None) -> DataFrame:
    """``n_tokens`` of every row of ``docs``."""
    path = path or vocabulary()

    def make():
        encode = encoder(path)
        return lambda cols: {"n_tokens": [len(encode(t)) for t in cols["text"]]}

    return arrow_map(docs.select(F.col(text).alias("text")), "n_tokens bigint", make)


def length_histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """One row per length, with sums up to it, from it on, and truncated there.

    ``truncated_tokens`` is the corpus total when every document is cut to
    that length; ``share`` is the share of documents not longer than it.
    """
    # written once: the blocks and the windows both read it, and the texts are encoded before it
    counts, _, _ = materialize(lengths.groupBy(F.col(length).alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs")),
                               "lengths")
    h = (counts.withColumn("b", F.floor(F.col("n_tokens") / BLOCK))
               .withColumn("tokens", F.col("n_tokens") * F.col("n_docs")))
    upto = Window.partitionBy("b").orderBy("n_tokens").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    zero = F.lit(0).cast("bigint")
    blocks = (h.groupBy("b").agg(F.sum("n_docs").alias("d"), F.sum("tokens").alias("t"))
               .select("b", F.coalesce(F.sum("d").over(before), zero).alias("d0"),
                       F.coalesce(F.sum("t").over(before), zero).alias("t0"),
                       F.sum("d").over(everything).alias("total_docs"),
                       F.sum("t").over(everything).alias("total_tokens")))
    j = (h.withColumn("d1", F.sum("n_docs").over(upto)).withColumn("t1", F.sum("tokens").over(upto))
          .join(blocks, "b"))
    docs_upto, tokens_upto = F.col("d0") + F.col("d1"), F.col("t0") + F.col("t1")
    docs_from = F.col("total_docs") - docs_upto + F.col("n_docs")
    return j.select(
        "n_tokens", "n_docs", docs_upto.alias("docs_upto"), tokens_upto.alias("tokens_upto"),
        docs_from.alias("docs_from"),
        (F.col("total_tokens") - tokens_upto + F.col("tokens")).alias("tokens_from"),
        (tokens_upto - F.col("tokens") + F.col("n_tokens") * docs_from).alias("truncated_tokens"),
        (docs_upto / F.col("total_docs")).alias("share"), "total_docs", "total_tokens")


def truncated_totals(hist: DataFrame, limits: list[int]) -> DataFrame:
    """``(context_limit, kept_tokens, cut_docs)`` for any limits, from the histogram."""
    n, d = F.col("n_tokens"), F.col("n_docs")
    aggs = []
    for i, lim in enumerate(limits):
        aggs += [F.coalesce(F.sum(F.least(n, F.lit(lim)) * d), F.lit(0)).alias(f"k{i}"),
                 F.coalesce(F.sum(F.when(n > lim, d)), F.lit(0)).alias(f"c{i}")]
    rows = F.array(*[F.struct(F.lit(lim).cast("bigint").alias("context_limit"),
                              F.col(f"k{i}").alias("kept_tokens"), F.col(f"c{i}").alias("cut_docs"))
                     for i, lim in enumerate(limits)])
    return hist.agg(*aggs).select(F.inline(rows))


def length_quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """``(share, n_tokens)``: the smallest length that this share of documents doesn't exceed."""
    aggs = [F.min(F.when(F.col("docs_upto") >= F.ceil(F.lit(q) * F.col("total_docs")), F.col("n_tokens")))
            .alias(f"q{i}") for i, q in enumerate(shares)]
    rows = F.array(*[F.struct(F.lit(float(q)).alias("share"), F.col(f"q{i}").alias("n_tokens"))
                     for i, q in enumerate(shares)])
    return hist.agg(*aggs).select(F.inline(rows))
