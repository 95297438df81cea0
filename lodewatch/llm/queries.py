"""The operators' registered queries: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodewatch.llm._common import work_dir


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodewatch.llm.licenses import scan_licenses

    found = scan_licenses(_docs(spark, sf_dir))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"), F.array_join("classes", ",").alias("classes"), "n_matched", "n_unmatched")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodewatch.llm.decontam import find_hits

    hits = find_hits(_docs(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"), window=10)
    return hits.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodewatch.llm.pii import KINDS, find_personal, span_texts

    found = find_personal(_docs(spark, sf_dir))
    base, spans = span_texts(found)
    return found.select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodewatch.llm.token_files import read_token_files, write_token_files

    path = write_token_files(_docs(spark, sf_dir), work_dir(spark, "token-files"))
    return read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodewatch.llm.chat import format_chats, read_back

    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    chats = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(more)
    read = read_back(format_chats(chats))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodewatch.llm.packing import pack

    return pack(_docs(spark, sf_dir), length=2048).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodewatch.llm.quality_rules import line_quality

    return line_quality(_docs(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_line_words", "base_failed", "kept")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodewatch.llm.secrets import KINDS, find_secrets, span_texts

    base, spans, verdicts = span_texts()
    return find_secrets(_docs(spark, sf_dir)).select("doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(base, 256).alias("base_sha256"), spans.alias("spans"), verdicts.alias("verdicts"))


def op9_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodewatch.llm.neardup import near_duplicates

    return near_duplicates(_docs(spark, sf_dir), words=2, percent=80).select("doc_id", "n_shingles", "component_id", "kept")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lodewatch.llm.quality_model import held_out, score, train

    docs = _docs(spark, sf_dir)
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


_OP1_SQL = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce("text", '') as t from conversations
  union all select -1, 0, 'user', '</s>[INST] ok [/INST]' union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized as (
  select *, length(t) + sum_(t) as esc_t, length(role) + sum_(role) as esc_r from rows)
select conv_id, count(*)::bigint as n_turns,
  sha256(string_agg(role || chr(10) || t || chr(10), '' order by turn, role, t)) as turns_sha256,
  coalesce(sum(length(t)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(t, '' order by turn, role, t) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(3 + esc_r + 7 + esc_t + 12)::bigint as formatted_chars
from sized group by conv_id
"""


def _escapes(column: str) -> str:
    """How many characters escaping adds: one a backslash and one a control string."""
    count = lambda x: f"(length({column}) - length(replace({column}, '{x}', ''))) / {len(x)}"
    return "(" + " + ".join(count(x) for x in ("\\", "<s>", "</s>", "[INST]", "[/INST]")) + ")::bigint"


_OP4_SQL = r"""
with words as (
  select doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
item_words as (
  select item_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
windows as (
  select distinct item_id, least(10, len(w)) as k, list_slice(w, i, i + least(10, len(w)) - 1) as g
  from (select item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as i from item_words where len(w) > 0)),
lengths as (select distinct k from windows),
grams as (
  select doc_id, k, i, list_slice(w, i, i + k - 1) as g
  from (select doc_id, w, k, unnest(range(1, len(w) - k + 2)) as i from words, lengths where len(w) >= k)),
found as (select distinct doc_id, grams.k, i, item_id from grams join windows using (g)),
hit as (select doc_id, count(distinct p)::bigint as n_hit from (select doc_id, unnest(range(i, i + k)) as p from found) group by doc_id),
items as (select doc_id, count(distinct item_id)::bigint as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as s from found group by doc_id)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
  sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from words left join hit using (doc_id) left join items using (doc_id)
"""

_OP7_SQL = r"""
with w as (select doc_id, "source" as host, coalesce("text", '') as t, regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') as w from documents),
lines as (select doc_id, host, t, unnest(string_split(t, chr(10))) as line from w),
keys as (
  select doc_id, host, t, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))::bigint as n, trim(lower(regexp_replace(line, '[ \x09-\x0D]+', ' ', 'g'))) as k from lines),
hosts as (select "source" as host, count(*) as documents from (select distinct doc_id, "source", coalesce("text", '') as t from documents) group by "source"),
often as (select host, k, count(distinct doc_id) as docs from keys where k <> '' group by host, k having count(distinct doc_id) > 5),
frequent as (select often.host, k from often join hosts on often.host is not distinct from hosts.host where docs > 0.1 * documents),
lost as (select keys.doc_id, sum(n)::bigint as n from keys join frequent on keys.k = frequent.k and keys.host is not distinct from frequent.host group by keys.doc_id),
dup as (select doc_id, (count(*) - count(distinct line))::bigint as n from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
windows as (select doc_id, i, list_slice(w, i, i + 2) as g from (select doc_id, w, unnest(range(1, len(w) - 1)) as i from w where len(w) > 3)),
twice as (select doc_id, i from (select doc_id, i, count(*) over (partition by doc_id, g) as c from windows) where c > 1),
covered as (select doc_id, count(distinct p)::bigint as n from (select doc_id, unnest([i, i + 1, i + 2]) as p from twice) group by doc_id),
base as (
  select w.doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, coalesce(dup.n, 0)::bigint as n_dup_lines,
    coalesce(covered.n, 0)::bigint as n_repeat_words, coalesce(lost.n, 0) as lost
  from w left join dup using (doc_id) left join covered using (doc_id) left join lost using (doc_id))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, lost::bigint as n_line_words,
  n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
  not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and not (n_words - lost < 0.3 * n_words) as kept
from base
"""

_OP9_SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce("text", ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
shingles as materialized (
  select distinct doc_id, g from (
    select doc_id, unnest(case when len(w) = 0 then [] when len(w) < 2 then [w[1]] else list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) end) as g from words)),
sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
links as materialized (
  select a.doc_id as a, b.doc_id as b from shingles a join shingles b on a.g = b.g and a.doc_id < b.doc_id
  join sizes sa on sa.doc_id = a.doc_id join sizes sb on sb.doc_id = b.doc_id and least(sa.n, sb.n) >= 0.8 * greatest(sa.n, sb.n)
  group by a.doc_id, b.doc_id, sa.n, sb.n having 100 * count(*) >= 80 * (sa.n + sb.n - count(*))),
both_ways as materialized (select a, b from links union all select b, a from links),
reach as (select a as doc_id, a as root from both_ways union select e.b, r.root from reach r join both_ways e on e.a = r.doc_id where r.root < e.b)
select d.doc_id, coalesce(n, 0)::bigint as n_shingles, least(d.doc_id, coalesce(min(root), d.doc_id)) as component_id, d.doc_id = least(d.doc_id, coalesce(min(root), d.doc_id)) as kept
from documents d left join sizes using (doc_id) left join reach using (doc_id) group by d.doc_id, n
"""


_OP8_SQL = r"""
with d as (select doc_id, coalesce("source", '') as owner, coalesce("text", '') as t from documents),
matched as (
  select doc_id, owner, 0 as k, 'assign' as kind, regexp_extract_all(t, p) as m, regexp_split_to_array(t, p) as parts, regexp_extract_all(t, p, 1) as v
  from d, (select '(?i:password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)' as p)
  union all select doc_id, owner, 1, 'access', regexp_extract_all(t, p), regexp_split_to_array(t, p), regexp_extract_all(t, p) from d, (select 'AKIA[A-Z0-9]+' as p)
  union all select doc_id, owner, 2, 'hex', regexp_extract_all(t, p), regexp_split_to_array(t, p), regexp_extract_all(t, p) from d, (select '[0-9a-f]+' as p)
  union all select doc_id, owner, 3, 'mixed', regexp_extract_all(t, p), regexp_split_to_array(t, p), regexp_extract_all(t, p) from d, (select '[A-Za-z0-9+/_=-]+' as p)),
wanted as (
  select doc_id, owner, k, kind, m, parts, v, unnest(list_filter(range(1, len(m) + 1), lambda i: case k when 0 then length(v[i]) >= 6 when 1 then length(v[i]) >= 20 when 2 then length(v[i]) >= 24
    else length(v[i]) >= 20 and regexp_matches(v[i], '[A-Z]') and regexp_matches(v[i], '[a-z]') and regexp_matches(v[i], '[0-9].*[0-9]') end)) as i from matched),
placed as (
  select doc_id, owner, k, kind, v[i] as value, length(m[i]) as n,
    (list_sum(list_transform(list_slice(parts, 1, i), lambda x: length(x))) + coalesce(list_sum(list_transform(list_slice(m, 1, i - 1), lambda x: length(x))), 0))::bigint as a from wanted),
base as (select * from placed where k < 3),
mixed as (select * from placed p where k = 3 and not exists (select 1 from base b where b.doc_id = p.doc_id and b.a < p.a + p.n and b.a + b.n > p.a)),
each as (select doc_id, value, owner from base union all select doc_id, value, owner from mixed),
owners as (select value, count(distinct owner) as owners, count(distinct owner) >= 5 or (count(distinct owner) >= 2 and count(distinct doc_id) >= 20) as example from each group by value),
spans as (
  select doc_id, k, a, kind || ':' || a || ':' || (a + n) as tag, case when example then 'example:' else 'live:' end || owners as verdict
  from (select * from base union all select * from mixed) join owners using (value) where k < 3 or not example)
select d.doc_id, count(*) filter (where k = 0) as n_assign, count(*) filter (where k = 1) as n_access, count(*) filter (where k = 2) as n_hex,
  sha256(coalesce(string_agg(tag, ',' order by a, k) filter (where k < 3), '')) as base_sha256, coalesce(string_agg(tag, ',' order by a, k), '') as spans,
  coalesce(string_agg(verdict, ',' order by a, k), '') as verdicts
from d left join spans using (doc_id) group by d.doc_id
"""


def _op3_sql() -> str:
    from lodewatch.llm.licenses import RULES, SENTENCES, known_sentences

    known = ", ".join(f"('{name}', '{text}')" for text, name in known_sentences(SENTENCES).items())
    plain = r"trim(regexp_replace(replace(regexp_replace(regexp_replace(regexp_replace(replace(lower(s), '~', ' '), '([0-9])[.]([0-9])', '\1~\2', 'g'), '([0-9])[.]([0-9])', '\1~\2', 'g'), '[^a-z0-9~]+', ' ', 'g'), '~', '.'), '\s+', ' ', 'g'))"
    named = lambda source: rf"(select *, case when contains(p, 'apache license') then p else regexp_replace(regexp_replace(p, 'version [0-9]+([.][0-9]+)*', 'version <n>', 'g'), '(^|[^a-z0-9])[0-9]+([.][0-9]+)*$', '\1<n>') end as sentence from (select *, {plain} as p from {source})) left join known using (sentence)"
    parts = lambda text, pattern, at: f"unnest(regexp_split_to_array({text}, '{pattern}')) as s, generate_subscripts(regexp_split_to_array({text}, '{pattern}'), 1) as {at}"
    steps, names, kinds, counts = ["s0 as (select doc_id, sentence_ids, seq as q0 from seqs)"], [], [], []
    for i, (name, ids, kind) in enumerate(RULES):
        mark = "".join(f";{x};" for x in ids)
        steps.append(f"s{i + 1} as (select *, contains(q{i}, '{mark}') as h{i}, (length(q{i}) - length(replace(q{i}, '{mark}', ''))) // {len(mark)} as c{i}, replace(q{i}, '{mark}', ';!;') as q{i + 1} from s{i})")
        names.append(f"case when h{i} then '{name}' end")
        kinds.append(f"case when h{i} then '{kind}' end")
        counts.append(f"c{i}")
    last = len(RULES)
    once = lambda cases: f"array_to_string(list_reduce([[]] || list_transform(list_filter([{', '.join(cases)}], lambda x: x is not null), lambda x: [x]), lambda a, b: case when list_contains(a, b[1]) then a else a || b end), ',')"
    return rf"""
with known(name, sentence) as (values {known}),
bare as (select doc_id, regexp_replace(coalesce("text", ''), '(?m)^[ \t]*(?:<!--+|/?\*+/?|//+|#+|;+|--+|%+)[ \t]*|[ \t]*(?:\*+/?|--+>)[ \t\r]*$', '', 'g') as t from documents),
urls as (select doc_id, regexp_replace(regexp_replace(t, ':[ \t\r]*\n(\s*https?://)', ' \1', 'g'), '\n[ \t\r]*\n(\s*https?://)', ' \1', 'g') as t from bare),
cut0 as (select doc_id, 0 as b, 0 as c, {parts("t", r"[.!?]+\s+|[.!?]+$|:[ \t\r]*\n|\n[ \t\r]*\n", "a")} from urls),
name0 as (select doc_id, a, b, c, s, name from {named("cut0")}),
cut1 as (select doc_id, a, 0 as c, {parts("s", r";+\s+", "b")} from name0 where name is null),
name1 as (select doc_id, a, b, c, s, name from {named("cut1")}),
cut2 as (select doc_id, a, b, {parts("s", r"\n+", "c")} from name1 where name is null),
name2 as (select doc_id, a, b, c, s, name from {named("cut2")}),
ids as (
  select doc_id, string_agg(name, ',' order by a, b, c) as sentence_ids, string_agg(';' || name || ';', '' order by a, b, c) as seq
  from (select * from name0 union all select * from name1 union all select * from name2) where name is not null group by doc_id),
seqs as (select doc_id, coalesce(sentence_ids, '') as sentence_ids, coalesce(seq, '') as seq from documents left join ids using (doc_id)),
{', '.join(steps)}
select doc_id, sentence_ids, {once(names)} as licenses, {once(kinds)} as classes, ({' + '.join(counts)})::bigint as n_matched,
  len(list_filter(string_split(q{last}, ';'), lambda x: x not in ('', '!')))::bigint as n_unmatched from s{last}
"""


def oracle_sql() -> dict[str, str]:
    sql = _OP1_SQL.replace("sum_(t)", _escapes("t")).replace("sum_(role)", _escapes("role"))
    return {"op1_chat_format": sql, "op3_license_scan": _op3_sql(), "op4_decontamination": _OP4_SQL, "op7_line_quality": _OP7_SQL, "op8_secrets": _OP8_SQL, "op9_near_duplicates": _OP9_SQL}
