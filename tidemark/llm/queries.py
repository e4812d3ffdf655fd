"""Queries over whole tables for the operators of this subpackage, and SQL for those that it can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import language_id
from .bpe import bpe_round_trip
from .chat_format import format_preferences, neighbour_pairs
from .common import id_remainder, read_table
from .exact_dedup import exact_dedup
from .lm_scoring import lm_scores
from .mixing import mix_report
from .ngram_join import Link, ngram_join
from .periodic_runs import longest_run, periodic_runs, with_planted_periods
from .quality_rules import quality_rules
from .simhash import simhash_components
from .token_file import new_folder, read_tokens, write_tokens
from .turn_repair import damaged, repair_conversations
from .url_filter import url_filter

#: Rules of the url query: host, path, action.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents").select(*columns)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup(_documents(spark, sf_dir, "doc_id", "text"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules(_documents(spark, sf_dir, "doc_id", "text"), read_table(spark, sf_dir, "labels"))
    return rows.drop("text")


def op3_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.tiktoken") -> DataFrame:
    import public_tokenizers

    return bpe_round_trip(_documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)


def op4_token_file(spark: SparkSession, sf_dir: str, vocabulary: str = "byte_bpe_50k.json") -> DataFrame:
    import public_tokenizers

    folder = new_folder(spark)
    write_tokens(_documents(spark, sf_dir, "doc_id", "text"), folder, public_tokenizers.path(vocabulary), public_tokenizers.PATTERN)
    return read_tokens(spark, folder)


def op5_language_id(spark: SparkSession, sf_dir: str, vocabulary: str = "piece_bpe_32k.model") -> DataFrame:
    import public_tokenizers

    held_out = id_remainder(F.col("doc_id"), 4) == 2
    training = _documents(spark, sf_dir, "doc_id", "text", "lang").filter(~held_out)
    rows = language_id.identify(_documents(spark, sf_dir, "doc_id", "text"), training, public_tokenizers.path(vocabulary))
    return rows.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(_documents(spark, sf_dir, "doc_id", "text", "source"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_documents(spark, sf_dir, "doc_id", "text"), Link(words=3, over=90))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule_host string, rule_path string, action string")
    return url_filter(read_table(spark, sf_dir, "pages").select("page_id", "url"), rules)


def op9_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lm_scores(_documents(spark, sf_dir, "doc_id", "text"), id_remainder(F.col("doc_id"), 10) != 0)
    return rows.withColumn("held_out", ~F.col("learn")).drop("learn")


def op10_chat_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = format_preferences(conversations, neighbour_pairs(conversations))
    spans = {f"{c}_spans": F.array_join(F.transform(f"{c}_spans", lambda s: F.concat(s["begin"].cast("string"), F.lit("-"), s["end"].cast("string"))), ",")
             for c in ("chosen", "rejected")}
    return rows.withColumns(spans)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = periodic_runs(with_planted_periods(_documents(spark, sf_dir, "doc_id", "text"))).withColumn("longest", longest_run(F.col("runs")))
    lines = F.transform("runs", lambda run: F.concat_ws(",", run["start"], run["length"], run["period"]))
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "longest.start", "longest.length", "longest.period",
        F.expr("1000 * longest.length div longest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(_documents(spark, sf_dir, "doc_id", "text"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_byte_bpe": op3_byte_bpe,
    "op4_token_file": op4_token_file,
    "op5_language_id": op5_language_id,
    "op6_mix_sources": op6_mix_sources,
    "op7_ngram_join": op7_ngram_join,
    "op8_url_filter": op8_url_filter,
    "op9_lm_scores": op9_lm_scores,
    "op10_chat_preferences": op10_chat_preferences,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_simhash": op12_simhash,
    "op13_turn_repair": op13_turn_repair,
}

ORACLE_SQL = {
    "op1_exact_dedup": r"""
with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from n
""",
    "op6_mix_sources": r"""
with sized as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, '')), 1, 12))::bigint as h
  from documents),
src as (
  select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as place from sized group by source),
weighted as (select *, ((place - 1) % 3 + 1)::bigint as weight, 3 * source_size as cap from src),
summed as (
  select *, sum(source_size) over () - coalesce(sum(cap) over before, 0) as remaining,
         sum(weight) over () - coalesce(sum(weight) over before, 0) as shares
  from weighted window before as (order by cap / weight, place rows between unbounded preceding and 1 preceding)),
capped as (select *, cap * shares <= remaining * weight as is_capped from summed),
free as (select remaining, shares from capped where not is_capped order by cap / weight, place limit 1),
targets as (
  select source, source_size,
         case when is_capped then cap::double else (weight * (select remaining from free))::double / (select shares from free) end as target
  from capped),
plan as (
  select *, case when source_size > 0 then floor(floor(target) / source_size)::bigint else 0 end as full_copies, floor(target)::bigint as budget from targets),
hist as (select source, h, sum(size) as in_bucket from sized group by source, h),
running as (select *, sum(in_bucket) over (partition by source order by h) - in_bucket as below from hist),
boundary as (
  select p.source, max_by(r.h, r.h) as h, max_by(r.below, r.h) as below, max_by(r.in_bucket, r.h) as in_bucket
  from plan p join running r on p.source is not distinct from r.source
  where r.below <= p.budget - p.full_copies * p.source_size group by p.source),
cuts as (
  select p.*, case when p.full_copies >= 3 then 0
                   when b.below + b.in_bucket - (p.budget - p.full_copies * p.source_size) <= (p.budget - p.full_copies * p.source_size) - b.below then b.h + 1
                   else b.h end as cut
  from plan p join boundary b on p.source is not distinct from b.source)
select s.doc_id, s.size, c.source_size, c.target, (s.size * (c.full_copies + case when s.h < c.cut then 1 else 0 end))::bigint as taken
from sized s join cuts c on s.source is not distinct from c.source
""",
    "op8_url_filter": r"""
with parsed as (
  select page_id, url, case when contains(url, '://') then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (
  select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from parsed),
rules(rule_host, rule_path, action) as (
  values ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
judged as (
  select p.*, (select max_by({'rule': rule_host || rule_path, 'action': action}, length(rule_host || rule_path)) from rules r
               where (p.host = r.rule_host or ends_with(p.host, '.' || r.rule_host)) and starts_with(p.path, r.rule_path)) as best
  from parts p)
select page_id, host, path, best.rule as rule, coalesce(best.action, 'allow') as verdict from judged
""",
    "op10_chat_preferences": r"""
with t as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, conv_id >> 1 as pair_id,
         row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) as pos
  from conversations where conv_id is not null),
pairs as (
  select conv_id >> 1 as pair_id, max(case when (conv_id & 1) = 0 then conv_id end) as chosen_id, max(case when (conv_id & 1) = 1 then conv_id end) as rejected_id
  from t group by 1),
lengths as (select p.pair_id, coalesce(min(n), 0) as least_n from pairs p left join (select conv_id, pair_id, count(*) as n from t group by all) c using (pair_id)
            group by 1 having count(c.conv_id) = 2),
differing as (
  select a.pair_id, min(a.pos) as pos from t a join t b on a.pair_id = b.pair_id and a.pos = b.pos and (a.conv_id & 1) = 0 and (b.conv_id & 1) = 1
  where a.role <> b.role or a.text <> b.text group by 1),
cut as (
  select p.*, coalesce(d.pos - 1, l.least_n, 0)::int as common
  from pairs p left join lengths l using (pair_id) left join differing d using (pair_id)),
rendered as (
  select t.conv_id, t.pair_id, t.pos, t.role, '<|' || t.role || '|>' || chr(10) as head, t.text || '<|end|>' || chr(10) as body, c.common
  from t join cut c using (pair_id)),
placed as (
  select *, sum(length(head) + length(body)) over (partition by conv_id order by pos) as stop from rendered where pos > common),
completions as (
  select conv_id, string_agg(head || body, '' order by pos) as completion,
         coalesce(string_agg((stop - length(body))::varchar || '-' || stop::varchar, ',' order by pos) filter (role = 'assistant'), '') as spans
  from placed group by 1),
prompts as (select pair_id, string_agg(head || body, '' order by pos) as prompt from rendered where pos <= common and (conv_id & 1) = 0 group by 1)
select c.pair_id, c.chosen_id, c.rejected_id, c.common, coalesce(pr.prompt, '') as prompt,
       case when c.chosen_id is not null then coalesce(a.completion, '') end as chosen, case when c.rejected_id is not null then coalesce(b.completion, '') end as rejected,
       case when c.chosen_id is not null then coalesce(a.spans, '') end as chosen_spans, case when c.rejected_id is not null then coalesce(b.spans, '') end as rejected_spans
from cut c left join prompts pr using (pair_id) left join completions a on a.conv_id = c.chosen_id left join completions b on b.conv_id = c.rejected_id
""",
    "op13_turn_repair": r"""
with recursive keyed as (
  select conv_id, dense_rank() over (order by conv_id) as c, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
         list_transform(string_split(coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ascii(x)::bigint) as bytes
  from conversations),
hashed as (
  select *, xor(4294967295, list_reduce(bytes, lambda crc, b: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, b)), 4294967295)) % 20 as kind
  from keyed),
changed as (
  select c, turn, case when kind = 4 then 'user' else role end as role,
         case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(case when kind = 3 then 2 else 1 end)) as copy
  from hashed where kind <> 0),
seen as (select *, row_number() over (partition by c, role, text order by turn nulls first) as times from changed),
placed as (
  select *, row_number() over (partition by c order by turn nulls first, role, text, times) as i, substr(role, 1, 1) as initial,
         case when not regexp_matches(text, '[^\x20\x09-\x0D]') then 'blank' when times > 1 then 'duplicate'
              when not regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') then 'truncated' else '' end as fault
  from seen),
paired as (select *, lag(initial) over (partition by c order by i) || initial as pair from placed),
counts as (
  select c, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0)::bigint as gaps, count(*) filter (fault = 'blank') as blank,
         count(*) filter (fault = 'duplicate') as duplicate, count(*) filter (fault = 'truncated') as truncated,
         count(*) filter (pair not in ('su', 'ua', 'au')) as illegal
  from paired group by c),
kept(state, initial, next) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
edits(edit, fee) as (values ('D', 3), ('K', 0), ('R', 2)),
inserts(m) as (values (0), (1), (2)),
ways(c, i, state, best) as (
  select c, 0::bigint, case m when 0 then 0 when 1 then 2 else 3 end, {'cost': (2 * m)::bigint, 'audit': repeat('I', m)} from counts, inserts
  union all
  select c, i, state, min(best) from (
    select s.c, s.i, case when m = 0 then s.state when (s.state = 2) = (m = 1) then 3 else 2 end as state,
           {'cost': s.cost + 2 * m, 'audit': s.audit || repeat('I', m)} as best
    from (
      select w.c, p.i, case edit when 'D' then w.state when 'K' then k.next else case when w.state = 2 then 3 else 2 end end as state,
             w.best.cost + fee + case when edit <> 'D' and fault = 'truncated' then 1 else 0 end as cost, w.best.audit || edit as audit
      from ways w join placed p on p.c = w.c and p.i = w.i + 1 cross join edits left join kept k on k.state = w.state and k.initial = p.initial
      where edit = 'D' or (fault not in ('blank', 'duplicate') and (edit = 'R' or k.next is not null))) s cross join inserts)
  group by c, i, state),
chosen as (select w.c, min(w.best) as best from ways w join counts n on n.c = w.c and n.n = w.i where w.state in (0, 3) group by w.c),
letters as (select c, unnest(range(1, length(best.audit) + 1)) as pos, best.audit as audit from chosen),
steps as (
  select c, pos, substr(audit, pos, 1) as edit, sum(case when substr(audit, pos, 1) = 'I' then 0 else 1 end) over w as i,
         sum(case when substr(audit, pos, 1) = 'D' then 0 else 1 end) over w as made
  from letters window w as (partition by c order by pos)),
lines as (
  select s.*, p.role, p.text, max(case when s.made = 1 and s.edit = 'K' and p.initial = 's' then 1 else 0 end) over (partition by s.c) as system
  from steps s left join placed p on p.c = s.c and p.i = s.i and s.edit <> 'I' where s.edit <> 'D'),
repaired as (
  select c, string_agg(case when edit = 'K' then role when (made - system) % 2 = 1 then 'user' else 'assistant' end || ':' || coalesce(text, ''), chr(10) order by pos) as whole
  from lines group by c)
select conv_id, coalesce(gaps, 0) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
       coalesce(illegal, 0) as illegal, coalesce(best.cost, 0) as cost, coalesce(best.audit, '') as audit, sha256(coalesce(whole, '')) as repaired_sha256
from (select distinct c, conv_id from keyed) k left join counts using (c) left join chosen using (c) left join repaired using (c)
""",
}
