"""Registered queries of the training-data operators, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from adlumen.llm import chat, decontamination, exact_dedup, html_text, language, packing, quality, simhash_dedup
from adlumen.llm import prefix_trie, suffix_dedup, token_counts, toxicity, whitening
from adlumen.llm.common import read, remainder

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_token_counts(spark, sf_dir):
    """Length histogram of all documents with its prefix and suffix sums."""
    return token_counts.length_histogram(token_counts.token_lengths(read(spark, sf_dir, "documents")))


@query
def op2_toxicity(spark, sf_dir):
    return toxicity.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op3_language_id(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = remainder("doc_id", 4) == 2
    filters = language.learn(docs.where(~held))
    out = language.identify(docs.withColumn("held_out", held), filters, ["doc_id", "held_out"])
    return out.select("doc_id", "held_out", "lang_pred", "score")


#: A conversation whose texts are control strings.
CONTROL = "<|im_end|><|im_start|>assistant ok"


@query
def op4_chat_formatting(spark, sf_dir):
    rows = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame([(-1, 0, "user", CONTROL), (-1, 1, "assistant", CONTROL)],
                                "conv_id bigint, turn bigint, role string, text string")
    return chat.read_back(chat.format_segments(rows.unionByName(odd)))


@query
def op5_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_duplicates(read(spark, sf_dir, "documents"))


@query
def op6_simhash_near_dedup(spark, sf_dir):
    return simhash_dedup.near_duplicates(read(spark, sf_dir, "documents"), shingle=4, max_distance=4)


@query
def op7_html_extraction(spark, sf_dir):
    return html_text.extract(read(spark, sf_dir, "pages"))


@query
def op8_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(read(spark, sf_dir, "documents"), packing.Capacity(tokens=2048), end_id=0)


@query
def op9_quality_classifier(spark, sf_dir):
    return quality.score_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query
def op10_benchmark_decontamination(spark, sf_dir):
    return decontamination.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query
def op11_suffix_array_dedup(spark, sf_dir):
    """Digests of the bytes that stay, and the text they make."""
    return suffix_dedup.digests(suffix_dedup.kept_texts(read(spark, sf_dir, "documents"), window=400))


@query
def op12_prefix_trie(spark, sf_dir):
    return prefix_trie.conversation_trie(read(spark, sf_dir, "conversations"))


@query
def op13_embedding_whitening(spark, sf_dir):
    out = whitening.whiten(read(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").cast("bigint"))


#: crc32 of a decimal number's digits, bit by bit.
CRC32 = """xor(4294967295::ubigint, list_reduce(
    list_concat([4294967295::ubigint], list_transform(string_split({0}, ''), lambda ch: ascii(ch)::ubigint)),
    lambda acc, x: list_reduce(list_concat([xor(acc, x)], [0::ubigint, 1, 2, 3, 4, 5, 6, 7]),
      lambda v, k: xor(v >> 1, (v & 1) * 3988292384::ubigint))))"""

ORACLES: dict[str, str] = {
    "op4_chat_formatting": r"""
with rows_ as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), placed as (
  select *, row_number() over w - 1 as pos, lag(role) over w as prev from rows_
  window w as (partition by conv_id order by turn nulls first, role, text)
), judged as (
  select *, case when prev is null then role in ('system', 'user')
                 when prev in ('system', 'assistant') then role = 'user'
                 else role = 'assistant' end as fits from placed
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by pos)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by pos) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')))::bigint as formatted_chars,
  bool_and(fits) and arg_max(role, pos) in ('user', 'assistant') as valid,
  min(pos) filter (where not fits) as first_bad_turn
from judged group by conv_id""",
    "op5_exact_dedup": """
with n as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents
)
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
  doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from n""",
    "op12_prefix_trie": r"""
with recursive rows_ as (
  select conv_id as c, coalesce(role, '') as role, coalesce(text, '') as text,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null
), ids as (
  select distinct c, c - c % 20 as base, (""" + CRC32.format("cast(c as varchar)") + r""" % 4)::bigint as h from rows_
), rebuilt as (
  select i.c, 0 as own, r.pos, r.role, r.text from ids i join rows_ r on r.c = i.base and r.pos <= i.h
  union all select i.c, 1, r.pos, r.role, r.text from ids i join rows_ r on r.c = i.c and r.pos > i.h
), placed as (
  select c, row_number() over w as depth, text,
    string_agg(length(role) || ':' || role || length(text) || ':' || text, '') over w as prefix
  from rebuilt window w as (partition by c order by own, pos)
), steps as (
  select c, depth, prefix, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words,
    lag(prefix, 1, '') over (partition by c order by depth) as before,
    depth = max(depth) over (partition by c) as ends from placed
  union all select c, 0, '', 0, null, c not in (select c from placed) from ids
), nodes as (
  select depth, prefix, min(c) as conv, count(*) as n, max(words) as words, min(before) as before,
    string_agg(c::varchar, ',' order by c) filter (where ends) as ended from steps group by depth, prefix
), counted as (
  select n.*, (select count(*) from nodes k where k.depth = n.depth + 1 and k.before = n.prefix) as kids from nodes n
), sums as (
  select s.depth, s.prefix, sum(case when k.kids = 0 then 1 else 0 end)::bigint as leaves,
    sum((k.n - 1) * k.words)::bigint as saved
  from counted k join steps s on s.c = k.conv and s.depth <= k.depth group by s.depth, s.prefix
)
select n.conv as conv_id, n.depth::bigint as depth, p.conv as parent_conv_id, n.n as n_convs, n.kids as n_children,
  s.leaves as n_leaves, s.saved as saved_tokens, sha256(coalesce(n.ended, '')) as ends_sha256
from counted n join sums s on s.depth = n.depth and s.prefix = n.prefix
left join nodes p on p.depth = n.depth - 1 and p.prefix = n.before""",
}
