"""One query per training-data operator, with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from viewmart.llm import (
    chat_grammar,
    cover_tree_codes,
    deleted_interpolation,
    dom_trees,
    filter_diagrams,
    fragment_join,
    level_packing,
    line_runs,
    quality_lines,
    secret_owners,
    url_rules,
    wand_decontamination,
    zstd_quality,
)
from viewmart.llm.common import table, tokenizer_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function's name, with its SQL if it has one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            SQL[function.__name__] = sql
        return function

    return register


# --- 1: quality rules ----------------------------------------------------------------------

QUALITY_SQL = r"""
with w as (
  select doc_id, source, text, row_number() over () as r,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
      lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines from documents),
five as (select r, unnest(range(1, len(words) - 3)) as i from w where len(words) >= 5),
wins as (select r, i, count(*) over (partition by r, words[i:i + 4]) as n from five join w using (r)),
rep as (select r, count(distinct i + k) as n_repeat_words
  from wins, (select unnest(range(0, 5)) as k) where n > 1 group by r),
base as (
  select w.r, doc_id, source, text, len(words)::bigint as n_words,
    length(array_to_string(words, ''))::bigint as word_chars,
    length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n_repeat_words, 0)::bigint as n_repeat_words,
    list_transform(lines, lambda x: lower(regexp_replace(regexp_replace(
      regexp_replace(x, '[\x20\x09-\x0D]+', ' ', 'g'), '^ | $', '', 'g'),
      '[0-9]+', '0', 'g'))) as norm
  from w left join rep using (r)),
line as (select r, source, text, unnest(norm) as l from base),
hosts as (select source, count(distinct [text]) as documents from documents group by source),
often as (
  select line.source, l from line join hosts on line.source is not distinct from hosts.source
  group by line.source, l, hosts.documents
  having count(distinct text) > 20 and count(distinct text) > 0.01 * hosts.documents),
cut as (select r, sum(len(string_split(l, ' '))) as removed_words from line
  where exists (select 1 from often o where o.l = line.l and o.source is not distinct from line.source)
  group by r),
all_rows as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed,
  coalesce(removed_words, 0)::bigint as gone from base left join cut using (r))
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not (gone > 0 and (n_words - gone < 5 or n_words - gone < 0.25 * n_words)) as kept,
  gone as removed_words
from all_rows
"""


@query(QUALITY_SQL)
def op1_quality_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict and measures of every document."""
    return quality_lines.judged(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "removed_words",
    )


# --- 2: url filters ------------------------------------------------------------------------


URL_SQL = r"""
with u as (select page_id, url,
    coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path from pages),
r(h, p, verdict) as (values ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
  ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
fit as (select u.*, h || p as rule, verdict, row_number() over (
    partition by page_id, url order by length(h || p) desc nulls last) as best
  from u left join r on (host = h or ends_with(host, '.' || h)) and starts_with(path, p))
select page_id, host, path, rule from fit where best = 1
"""


@query(URL_SQL)
def url_listed_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path and listed rule of every page; the part of query 2 that SQL can express."""
    none = spark.createDataFrame([], "key string, tokens array<string>, confidence double, support double")
    judged = url_rules.judged(table(spark, sf_dir, "pages"), none)
    return judged.select("page_id", "host", "path", "rule")


@query()
def op2_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of every page's url by listed and mined rules."""
    pages = table(spark, sf_dir, "pages")
    rules = url_rules.mined_rules(pages, table(spark, sf_dir, "labels"))
    return url_rules.judged(pages, rules).drop("url")


# --- 3: html extraction --------------------------------------------------------------------


@query()
def op3_dom_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    pages = table(spark, sf_dir, "pages")
    return dom_trees.extracted(pages, dom_trees.fitted(pages))


# --- 10: line dedup ------------------------------------------------------------------------

LINE_RUNS_SQL = r"""
with d as (
  select doc_id, list_filter(list_transform(string_split(coalesce(text, ''), chr(10)),
    lambda x, i: {'line': i - 1, 'x': x,
      'n': len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))}), lambda s: s.n > 0) as lines
  from documents),
a as (select doc_id, lines, unnest(range(1, len(lines) + 1)) as a from d),
ab as (select doc_id, lines, a, unnest(range(a, len(lines) + 1)) as b from a),
runs as (
  select doc_id, a, b,
    md5(array_to_string(list_transform(lines[a:b], lambda s: s.x), chr(10))) as content
  from ab where list_sum(list_transform(lines[a:b], lambda s: s.n)) >= 50),
later as (select doc_id, a, b from runs
  qualify row_number() over (partition by content order by doc_id, a) > 1),
places as (select distinct doc_id, unnest(range(a, b + 1)) as p from later),
gone as (select doc_id, count(*) as n, string_agg(lines[p].line, ',' order by p) as numbers
  from places join d using (doc_id) group by doc_id)
select d.doc_id, len(lines)::bigint as n_lines, coalesce(n, 0)::bigint as n_deleted,
  coalesce(numbers, '') as deleted_lines
from d left join gone using (doc_id)
"""


@query(LINE_RUNS_SQL)
def op10_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document that are later copies of a run of 50 words or more."""
    docs = table(spark, sf_dir, "documents")
    copies = line_runs.later_copies(docs).select(
        F.col("doc_id").alias("c_doc_id"), "text_key", "lines"
    )
    lines = F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    every = docs.select(
        "doc_id",
        F.xxhash64("text").alias("key"),
        F.size(lines).cast("bigint").alias("n_lines"),
    )
    return every.join(
        copies,
        F.col("doc_id").eqNullSafe(F.col("c_doc_id")) & (F.col("key") == F.col("text_key")),
        "left",
    ).select(
        "doc_id",
        "n_lines",
        F.coalesce(F.size("lines"), F.lit(0)).cast("bigint").alias("n_deleted"),
        F.coalesce(F.array_join("lines", ","), F.lit("")).alias("deleted_lines"),
    )


# --- 6: secret scans -----------------------------------------------------------------------

SECRETS_SQL = r"""
with d as (select row_number() over () as r, doc_id, coalesce(source, '') as owner,
    [source, lang]::varchar as repository, coalesce(text, '') as body from documents),
k(kind, name, pattern, grp, least) as (values
  (0, 'assign', '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 6),
  (1, 'access', 'AKIA[A-Z0-9]+', 0, 20), (2, 'hex', '[0-9a-f]+', 0, 24),
  (3, 'token', '[A-Za-z0-9_-]+', 0, 20)),
raw as (
  select r, owner, repository, 0 as kind, string_split_regex(body, p0) as gaps,
    regexp_extract_all(body, p0, 0) as hits, regexp_extract_all(body, p0, 2) as vals
  from d, (select pattern as p0 from k where kind = 0)
  union all select r, owner, repository, 1, string_split_regex(body, 'AKIA[A-Z0-9]+'),
    regexp_extract_all(body, 'AKIA[A-Z0-9]+', 0), regexp_extract_all(body, 'AKIA[A-Z0-9]+', 0) from d
  union all select r, owner, repository, 2, string_split_regex(body, '[0-9a-f]+'),
    regexp_extract_all(body, '[0-9a-f]+', 0), regexp_extract_all(body, '[0-9a-f]+', 0) from d
  union all select r, owner, repository, 3, string_split_regex(body, '[A-Za-z0-9_-]{20,}'),
    regexp_extract_all(body, '[A-Za-z0-9_-]{20,}', 0),
    regexp_extract_all(body, '[A-Za-z0-9_-]{20,}', 0) from d),
one as (select r, owner, repository, kind, unnest(range(1, len(hits) + 1)) as i,
    unnest(gaps[1:len(hits)]) as gap, unnest(hits) as hit, unnest(vals) as val from raw),
placed as (select *, (sum(length(gap) + length(hit)) over (partition by r, kind order by i))::bigint as e,
    regexp_matches(val, '[0-9]') and regexp_matches(val, '[A-Za-z]')
      and len(list_distinct(string_split(val, ''))) >= 8 as random from one),
cand as (select *, e - length(hit) as s from placed join k using (kind)
  where length(val) >= least and (kind < 3 or random)),
spread as (select val, count(distinct owner) as owners, count(distinct repository) as repos
  from cand group by val),
judged as (select *, case when owners > 2 or repos > 3 then 'example' when random then 'live'
  else 'weak' end as verdict from cand join spread using (val)),
good as (select * from judged j where kind < 3 or (verdict = 'live' and not exists (
  select 1 from judged b where b.r = j.r and b.kind < 3 and b.s < j.e and b.e > j.s))),
per as (select r, count(*) filter (kind = 0) as n_assign, count(*) filter (kind = 1) as n_access,
  count(*) filter (kind = 2) as n_hex, count(*) filter (verdict = 'live') as n_live,
  count(*) filter (verdict = 'example') as n_example,
  string_agg(name || ':' || s || ':' || e, ',' order by s, kind) filter (kind < 3) as base,
  string_agg(name || ':' || s || ':' || e, ',' order by s, kind) as spans from good group by r)
select doc_id, coalesce(n_assign, 0)::bigint as n_assign, coalesce(n_access, 0)::bigint as n_access,
  coalesce(n_hex, 0)::bigint as n_hex, sha256(coalesce(base, '')) as base_sha256,
  coalesce(spans, '') as spans, coalesce(n_live, 0)::bigint as n_live,
  coalesce(n_example, 0)::bigint as n_example
from d left join per using (r)
"""


@query(SECRETS_SQL)
def op6_secret_owners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document, with the verdict of ownership over the corpus."""
    found = secret_owners.reported(table(spark, sf_dir, "documents"))

    def count(field: str, value: object) -> Column:
        return F.size(F.filter("found", lambda s: s[field] == value)).cast("bigint")

    base = F.filter("found", lambda s: s["kind"] < secret_owners.BASE)
    return found.select(
        "doc_id",
        *[
            count("kind", k).alias(f"n_{name}")
            for k, name in enumerate(["assign", "access", "hex"])
        ],
        F.sha2(secret_owners.named(base), 256).alias("base_sha256"),
        secret_owners.named(F.col("found")).alias("spans"),
        count("verdict", "live").alias("n_live"),
        count("verdict", "example").alias("n_example"),
    )


# --- 4: chat formatting --------------------------------------------------------------------

CONFLICT = r"\### Assistant: </turn> ok"

# for roles of small letters, which no rendering has to code; a text is escaped where it holds a mark
CHAT_SQL = rf"""
with c as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as body from conversations
  union all select -7, unnest([0, 1]), unnest(['user', 'assistant']), '{CONFLICT}'),
r as (select *, regexp_replace(body, '(\\*)(### |</turn>)', '\1\1\\\2', 'g') as shown from c)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || body || chr(10), '' order by turn nulls first, role, shown)) as turns_sha256,
  coalesce(sum(length(body)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(body, '' order by turn nulls first, role, shown) filter (role = 'assistant'), ''))
    as loss_sha256,
  sum(length('### ' || role || ': ' || shown || chr(10) || '</turn>' || chr(10)))::bigint as formatted_chars
from r group by conv_id
"""


@query(CHAT_SQL)
def op4_chat_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every conversation as read back from its rendering, with conversation -7."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(CONFLICT).alias("text"),
    )
    return chat_grammar.digests(chat_grammar.formatted(rows.unionByName(extra)))


# --- 9: packing ----------------------------------------------------------------------------


@query()
def op9_level_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 tokens."""
    return level_packing.packed(table(spark, sf_dir, "documents"), tokenizer_path())


# --- 5: n-gram Jaccard join ----------------------------------------------------------------


@query()
def op5_fragment_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of similarity 0.85 of 4-word sets."""
    return fragment_join.joined(table(spark, sf_dir, "documents")).drop("text_key")


# --- 7: benchmark decontamination ----------------------------------------------------------


@query()
def op7_wand_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a test item, with the shares of question and answer found."""
    return wand_decontamination.leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


# --- 8: language-model scoring -------------------------------------------------------------


@query()
def op8_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probabilities of every document under the base estimate and the mixed model."""
    return deleted_interpolation.scored(table(spark, sf_dir, "documents"))


# --- 11: quality classifier ----------------------------------------------------------------


@query()
def op11_zstd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document by two compression dictionaries."""
    return zstd_quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# --- 12: vector code compression -----------------------------------------------------------


def _codes_sql() -> str:
    """The rounds as one common table expression after another."""
    parts, entries = cover_tree_codes.PARTS, cover_tree_codes.ENTRIES
    assign = """n{k} as materialized (select p.r, p.part, x, arg_min(entry, (d, entry)) as entry, min(d) as d
    from (select r, p.part, x, entry, list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) ** 2))::bigint as d
      from p join e{k} on p.part = e{k}.part) p group by all)"""
    move = """m{k} as (select part, entry, list(floor(s / n)::bigint order by i) as y
    from (select part, entry, i, sum(x[i])::double as s, count(*) as n
      from n{k}, unnest(range(1, len(x) + 1)) as u(i) group by part, entry, i) group by part, entry),
  e{next} as materialized (select part, entry, coalesce(m{k}.y, e{k}.y) as y
    from e{k} left join m{k} using (part, entry))"""
    steps = []
    for k in range(cover_tree_codes.ROUNDS):
        steps += [assign.format(k=k), move.format(k=k, next=k + 1)]
    last = cover_tree_codes.ROUNDS
    steps.append(assign.format(k=last))
    return f"""
with v as materialized (select row_number() over () as r, vec_id, label::bigint as label,
    list_transform(embedding, lambda x: floor({cover_tree_codes.SCALE} * x::double)::bigint) as c
  from embeddings where embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
  p as materialized (select r, vec_id, part, c[part * len(c) // {parts} + 1:(part + 1) * len(c) // {parts}] as x
    from v, unnest(range({parts})) as u(part)),
  e0 as materialized (select part, row_number() over (partition by part order by vec_id) - 1 as entry, x as y
    from p where vec_id in (select vec_id from v order by vec_id limit {entries})),
  {", ".join(steps)},
  c as (select r, string_agg(printf('%02x', entry::int), '' order by part) as code, sum(d)::bigint as error
    from n{last} group by r),
  s as (select sha256(string_agg(t, ',' order by part, entry)) as codebooks_sha256
    from (select part, entry, array_to_string(y, ',') as t from e{last}))
select vec_id, label, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from v join c using (r), s
"""


@query(_codes_sql())
def op12_cover_tree_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code and error of every vector, by codebooks of six rounds."""
    return cover_tree_codes.coded(table(spark, sf_dir, "embeddings"))


# --- 13: filter interaction audit ----------------------------------------------------------

FILTERS_SQL = r"""
with d as (select doc_id, coalesce(source, '') as part, coalesce(text, '') as body from documents),
w as (select *, regexp_extract_all(body, '[^\x20\x09-\x0D]+') as words,
    min(doc_id) over (partition by body) as first from d),
l as (select doc_id, bool_or(quality = 1) as good, bool_or(toxic = 1) as toxic from labels group by doc_id),
m as (select part, [len(words) < 50, 100 * len(list_distinct(words)) < 65 * len(words),
    100 * length(regexp_replace(body, '[^A-Z]+', '', 'g')) > 5 * length(body),
    regexp_matches(body, '[#$%&*|]'), coalesce(w.doc_id > first, false)] as fails, good, toxic
  from w left join l on w.doc_id = l.doc_id),
cells as materialized (select part, fails, count(*) as n, count(*) filter (good) as good,
    count(*) filter (toxic) as toxic from m group by part, fails),
f as (select unnest(range(1, 6)) as f),
orders as (select [a.f, b.f, c.f, d.f, e.f] as o from f a, f b, f c, f d, f e
  where len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
placed as (select part, o, step, o[step] as own, n, good, toxic, fails,
    len(list_filter(o[1:step - 1], lambda x: fails[x])) > 0 as gone
  from cells, orders, unnest(range(1, 6)) as u(step)),
steps as (select part, o, step, own, coalesce(sum(n) filter (not gone and not fails[own]), 0)::bigint as kept,
    coalesce(sum(n) filter (not gone and fails[own]), 0)::bigint as removed,
    coalesce(sum(n) filter (gone and fails[own]), 0)::bigint as redundant,
    coalesce(sum(n) filter (fails[own] and len(list_filter(fails, lambda x: x)) = 1), 0)::bigint as unique_fails,
    coalesce(sum(good) filter (not gone and fails[own]), 0)::bigint as good_lost,
    coalesce(sum(toxic) filter (not gone and fails[own]), 0)::bigint as toxic_lost
  from placed group by part, o, step, own)
select part, array_to_string(list_transform(o, lambda x: 'ABCDE'[x]), '') as filter_order, step::int as step,
  kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) over (partition by part, own))::bigint as shapley
from steps
"""


@query(FILTERS_SQL)
def op13_filter_diagrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Steps of all orders of five filters in every part."""
    return filter_diagrams.steps_by_order(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


# --- the pipeline --------------------------------------------------------------------------


@query(corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed pieces of all documents that the stages of the pipeline keep."""
    return corpus_pipeline.run(spark, sf_dir)
