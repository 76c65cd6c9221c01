"""Columns of the conversation, language-model and Jaccard queries that SQL can give, against DuckDB."""

import os

import duckdb
import pytest

from viewmart.llm.queries import QUERIES, SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = rf"regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+')"

# crc32, bit by bit, of the digits of doc_id
CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(
    string_split(doc_id::varchar, ''), lambda x: ascii(x)::bigint)), lambda c, b: list_reduce(
    list_prepend(xor(c, b), range(8)), lambda y, k: xor(y >> 1, 3988292384 * (y & 1)))))"""

BASE_SCORES = f"""
with d as materialized (select doc_id, {WORDS} as words, {CRC} % 7 = 2 as held_out from documents),
t as (select doc_id, held_out, unnest(list_append(words, chr(10))) as token from d),
c as materialized (select token, count(*) as c from t where not held_out group by token),
s as (select sum(c)::bigint as n, count(*) as v from c)
select doc_id, held_out, count(*) as n_tokens, count(c) as n_known, any_value(n) as train_tokens,
  sum(log10((coalesce(c, 0) + 1) / (n + v + 1))) as base_score
from t left join c using (token), s group by doc_id, held_out
"""

COMPONENTS = f"""
with recursive d as (select doc_id, {WORDS} as w from documents),
g as materialized (select distinct doc_id, case when len(w) < 4 then array_to_string(w, ' ')
    else array_to_string(w[i:i + 3], ' ') end as gram
  from d, unnest(range(1, greatest(len(w) - 2, 2))) as u(i) where len(w) > 0),
n as materialized (select doc_id, count(*) as n from g group by doc_id),
shared as (select x.doc_id as a, y.doc_id as b, count(*) as k from g x join g y using (gram)
  where x.doc_id <> y.doc_id group by all),
links as materialized (select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b
  where 100 * k >= 85 * (x.n + y.n - k)),
reach as (select doc_id as a, doc_id as b from d union select reach.a, links.b from reach join links on links.a = reach.b)
select a as doc_id, coalesce(any_value(n), 0) as n_shingles, min(b) as component_id
from reach left join n on n.doc_id = a group by a
"""


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in ("documents", "conversations"):
        connection.sql(f"create view {name} as select * from '{SF_DIR}/{name}.parquet'")
    return connection


def test_conversations(spark, db):
    expected = db.sql(SQL["op4_chat_grammar"])
    ours = QUERIES["op4_chat_grammar"](spark, SF_DIR).select(*expected.columns).collect()
    assert sorted(map(tuple, ours)) == sorted(expected.fetchall())


def test_marks_in_texts(spark, db, tmp_path):
    texts = [r"\### x", "#### ", "</turn></turn>", "a\n</turn>\n### User: b", "\\\\", "\\", r"\\</turn>", "###", None, "é\u2028"]
    roles = ["user", "assistant", "system"]
    rows = ", ".join(
        f"({k % 3}, {k}, '{roles[k % 2 + k % 3 // 2]}', {'null' if t is None else repr_sql(t)})"
        for k, t in enumerate(texts)
    )
    db.sql(f"copy (select * from (values {rows}) t(conv_id, turn, role, text)) to '{tmp_path}/conversations.parquet'")
    other = duckdb.connect()
    other.sql(f"create view conversations as select * from '{tmp_path}/conversations.parquet'")
    expected = other.sql(SQL["op4_chat_grammar"])
    ours = QUERIES["op4_chat_grammar"](spark, str(tmp_path)).select(*expected.columns).collect()
    assert len(ours) == 4 and sorted(map(tuple, ours)) == sorted(expected.fetchall())


def repr_sql(text):
    return "'" + text.replace("'", "''") + "'"


def test_base_scores(spark, db):
    expected = {r[0]: r[1:] for r in db.sql(BASE_SCORES).fetchall()}
    ours = QUERIES["op8_deleted_interpolation"](spark, SF_DIR).collect()
    assert {r.doc_id for r in ours} == set(expected) and len(ours) == len(expected)
    for r in ours:
        *counts, base = expected[r.doc_id]
        assert [r.held_out, r.n_tokens, r.n_known, r.train_tokens] == counts
        assert r.base_score == pytest.approx(base)


def test_components(spark, db):
    ours = QUERIES["op5_fragment_join"](spark, SF_DIR).select("doc_id", "n_shingles", "component_id").collect()
    expected = db.sql(COMPONENTS).fetchall()
    assert sorted(map(tuple, ours)) == sorted(expected)
    assert any(a != c for a, _, c in expected)
