"""Registered queries of this package and, where SQL can say it, their
DuckDB equivalents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalla.llm import chat_format, conversation_repair, decontaminate, embedding_dedup, lang_id, license_scan, line_dedup, minhash_dedup, packing, prefix_trie, quality_rules, sharding, suffix_dedup
from medalla.llm.common import read

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_lang_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return lang_id.identify(spark, docs).select(
        "doc_id", "held_out", "lang_pred", "score", "nats", "n_letters", "rejected")


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(read(spark, sf_dir, "documents"), size=3, percent=85).select(
        "doc_id", "n_shingles", "component_id", "kept")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contamination(docs, read(spark, sf_dir, "benchmark")).select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated")


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)],
                                  "conv_id long, turn long, role string, text string")
    rows = read(spark, sf_dir, "conversations").select(*probe.columns).unionByName(probe)
    return chat_format.read_back(chat_format.format_conversations(rows, TOKENIZER), TOKENIZER)


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.tokenize_pieces(read(spark, sf_dir, "documents"), TOKENIZER)
    return packing.described(packing.pack(pieces))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = license_scan.scan(read(spark, sf_dir, "documents").select("doc_id", "text"),
                             license_scan.PHRASES | license_scan.TEMPLATES)
    base = F.filter("matches", lambda m: m["label"].isin(*license_scan.PHRASES))

    def joined(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    # words under any match: matches are sorted by start
    covered = F.aggregate("matches", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
                          lambda a, m: F.struct((a["n"] + F.greatest(F.lit(0).cast("long"), m["end"] - F.greatest(
                              m["start"], a["to"]))).alias("n"), F.greatest(a["to"], m["end"]).alias("to")))["n"]
    return (docs.withColumn("_base", base)
            .select("doc_id", "n_words", F.size("_base").cast("long").alias("n_base"),
                    F.array_min(F.transform("_base", lambda m: m["start"])).alias("first_word"),
                    F.array_max(F.transform("_base", lambda m: m["start"])).alias("last_word"),
                    joined(F.col("_base")).alias("base_labels"), joined(F.col("matches")).alias("labels"),
                    F.when(F.col("n_words") > 0, covered / F.col("n_words")).otherwise(F.lit(0.0)).alias("score"),
                    "matches"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.dedup_lines(docs).select("doc_id", "n_lines", "n_removed", "removed_lines",
                                               F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(read(spark, sf_dir, "embeddings"), cosine=0.98)


def op9_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_by_bytes(docs, shards=16).select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.damage_and_repair(read(spark, sf_dir, "conversations"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(read(spark, sf_dir, "conversations"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return quality_rules.quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "dup_line_chars", "dup_5gram_chars", "dup_10gram_chars")


QUERIES = {f.__name__: f for f in (op1_lang_id, op2_minhash, op3_decontaminate, op4_chat_format, op5_pack,
                                   op6_license_scan, op7_line_dedup, op8_embedding_dedup, op9_shard,
                                   op10_suffix_dedup, op11_conversation_repair, op12_prefix_trie,
                                   op13_quality_rules)}

_ESCAPED = r"[<](?:\x{2060}*)(?:/?s>|[|](?:turn|text|end|im_start|im_end|endoftext|system|user|assistant|eot_id|begin_of_text|start_header_id|end_header_id)[|]>)|\[(?:\x{2060}*)/?INST\]"

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_ANY_WORD = r"[^\x20\x09-\x0D]+"


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    return (f"xor(list_reduce(list_prepend(4294967295, list_transform(string_split({text}, ''), lambda c: cast(ascii(c) as bigint))), "
            "lambda a, b: list_reduce(list_prepend(xor(a, b), [0::bigint, 0, 0, 0, 0, 0, 0, 0]), "
            "lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")



SQL = {
    "op3_decontaminate": f"""
with d as (select doc_id, {_WORDS} as w from documents),
b as (select coalesce(cast(item_id as varchar), '') as item, {_WORDS} as w from benchmark),
win as (select distinct item, unnest(case when len(w) >= 10 then list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9])
        else [w] end) as terms from b where len(w) > 0),
sizes as (select distinct len(terms) as n from win),
places as (select doc_id, n, unnest(range(0, len(w) - n + 1)) as start, w from d, sizes where len(w) >= n),
hits as (select doc_id, start, places.n, item from places join win on win.terms = places.w[start + 1:start + places.n]),
cover as (select doc_id, count(distinct p) as n_hit from (
  select doc_id, unnest(range(start, start + n)) as p from hits) group by 1),
items as (select doc_id, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as ids
  from hits group by 1)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join cover using (doc_id) left join items using (doc_id)""",
    "op8_embedding_dedup": """
with recursive v as (
  select vec_id, label, cast(embedding as double[]) as e from embeddings),
ok as (select * from v where label is not null and e is not null and len(e) > 0
  and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0 and len(list_filter(e, lambda x: x <> 0)) > 0),
l as (select a.vec_id as a, b.vec_id as b from ok a join ok b on a.label = b.label and a.vec_id <> b.vec_id
      and len(a.e) = len(b.e) where list_cosine_similarity(a.e, b.e) >= 0.98),
r as (select vec_id, vec_id as c from embeddings union select r.vec_id, l.b from r join l on r.c = l.a),
m as (select vec_id, min(c) as component_id from r group by 1),
n as (select a as vec_id, count(*) as n from l group by 1)
select e.vec_id, coalesce(n.n, 0) as n_links, m.component_id, e.vec_id = m.component_id as kept
from embeddings e join m using (vec_id) left join n using (vec_id)""",
    "op2_minhash": r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) end as s from w),
e as (select doc_id, len(s) over_n, unnest(s) as g from s),
p as (select a.doc_id as a, b.doc_id as b, count(*) as hits, any_value(a.over_n) as na, any_value(b.over_n) as nb
      from e a join e b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
l as (select a, b from p where 100 * hits >= 85 * (na + nb - hits)),
u as (select a, b from l union all select b, a from l),
r as (select doc_id, doc_id as c from documents union select r.doc_id, u.b from r join u on r.c = u.a),
m as (select doc_id, min(c) as component_id from r group by 1)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, m.component_id, s.doc_id = m.component_id as kept
from s join m using (doc_id)""",
    "op4_chat_format": f"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
           union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
           union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
  cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  cast(sum(length(role) + length(text) + 23 + len(regexp_extract_all(text, '{_ESCAPED}'))
       + len(regexp_extract_all(role, '{_ESCAPED}'))) as bigint) as formatted_chars
from c group by conv_id""",
    "op12_prefix_trie": f"""
with t as (select conv_id, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) as x,
    row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null),
own as (select conv_id, list(x order by pos) as ts from t group by 1),
h as (select *, {_crc32('cast(conv_id as varchar)')} % 4 as h from own),
s as (select h.conv_id, list_concat(coalesce(b.ts[1:h.h], []), h.ts[h.h + 1:]) as ts
  from h left join own b on b.conv_id = h.conv_id - h.conv_id % 20),
m as (select conv_id, ts[1:d] as p, d, d = len(ts) as ends from (select *, unnest(range(0, len(ts) + 1)) as d from s)),
n as (select p, d, min(conv_id) as conv_id, count(*) as n_convs,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (ends), '')) as ends_sha256
  from m group by p, d),
k as (select n.*, (select count(*) from n c where c.d = n.d + 1 and c.p[1:n.d] = n.p) as n_children,
    case when d > 0 then (n_convs - 1) * len(regexp_extract_all(p[d].t, '{_ANY_WORD}')) else 0 end as saved from n),
u as (select p[1:a] as p, a as d, sum(saved) as saved, count(*) filter (n_children = 0) as leaves
  from (select *, unnest(range(0, d + 1)) as a from k) group by 1, 2)
select k.conv_id, k.d as depth, o.conv_id as parent_conv_id, k.n_convs, k.n_children, u.leaves as n_leaves,
  cast(u.saved as bigint) as saved_tokens, k.ends_sha256
from k join u on u.d = k.d and u.p = k.p left join n o on o.d = k.d - 1 and o.p = k.p[1:k.d - 1]""",
    "op13_quality_rules": f"""
with d as (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
w as (select *, regexp_extract_all(text, '{_ANY_WORD}') as w, string_split(text, chr(10)) as l from d),
lines as (select rid, line, row_number() over (partition by rid, line) as k
  from (select rid, unnest(l) as line from w) where regexp_matches(line, '{_ANY_WORD}')),
dup_lines as (select rid, count(*) as n, sum(length(regexp_replace(line, '[\x20\x09-\x0D]+', '', 'g'))) as chars
  from lines where k > 1 group by 1),
words as (select rid, p, w[p] as word, length(w[p]) as chars from (select rid, w, unnest(range(1, len(w) + 1)) as p from w)),
nums as (select word, row_number() over () as num from (select distinct word from words)),
ids as (select rid, p, chars, num from words join nums using (word)),
win as (select rid, p, {', '.join(f'lead(num, {j}) over r as a{j}' for j in range(10))} from ids window r as (partition by rid order by p)),
seen as ({' union all '.join(f"""select rid, {n} as n, p, count(*) over (partition by rid, {', '.join(f'a{j}' for j in range(n))}) as times,
  row_number() over (partition by rid, {', '.join(f'a{j}' for j in range(n))} order by p) as k from win where a{n - 1} is not null"""
     for n in (quality_rules.BASE_WINDOW, *quality_rules.MOST_IN_NGRAMS))}),
marked as (select distinct rid, n, unnest(range(p, p + n)) as p from seen where times > 1 and (n = 3 or k > 1)),
cover as (select rid, n, count(*) as words, sum(chars) as chars from marked join ids using (rid, p) group by all),
c as (select w.doc_id, cast(len(w) as bigint) as n_words,
    cast(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) as bigint) as word_chars,
    cast(len(regexp_extract_all(text, '[#*$%&|<>]')) as bigint) as n_symbols,
    coalesce(dup_lines.n, 0) as n_dup_lines, cast(coalesce(dup_lines.chars, 0) as bigint) as dup_line_chars,
    coalesce((select words from cover where cover.rid = w.rid and n = 3), 0) as n_repeat_words,
    cast(coalesce((select chars from cover where cover.rid = w.rid and n = 5), 0) as bigint) as dup_5gram_chars,
    cast(coalesce((select chars from cover where cover.rid = w.rid and n = 10), 0) as bigint) as dup_10gram_chars,
    exists (select 1 from cover where cover.rid = w.rid and n > 3 and 100 * chars > (case n {' '.join(
        f'when {n} then {most}' for n, most in quality_rules.MOST_IN_NGRAMS.items())} end) * word_chars) as over
  from w left join dup_lines using (rid))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (base_failed or over or 100 * dup_line_chars > 20 * word_chars) as kept,
  dup_line_chars, dup_5gram_chars, dup_10gram_chars
from c""",
}
