"""Quality rules, line dedup and secrets against plain Python on small tables."""

import hashlib
import re

import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F

from viewmart.llm import line_runs, quality_lines, secret_owners

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept int, line int, removed int, lines int, text_key int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    """Documents from (doc_id, text, source), with two columns whose names operators use themselves."""
    full = [(i, t, "en", s, None if t is None else len(t), 7, 8, 9, 10, 11) for i, t, s in rows]
    return spark.createDataFrame(full, SCHEMA)


def repeat_words(words):
    seen, places = {}, set()
    for i in range(len(words) - 4):
        seen.setdefault(tuple(words[i : i + 5]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            places |= {i + k for i in at for k in range(5)}
    return len(places)


ODD = [
    (1, None, "a"),
    (2, "", "a"),
    (3, "\n\n \t\n", None),
    (4, "one two three four five one two three four five", "a"),
    (4, "one two three four five one two three four five", "a"),
    (5, "a a a a a a a a a a a a", "b"),
    (6, "same line\nsame line\nother # $ line|\r\nsame line", "b"),
    (None, "É é x y <tag> & more words to have ten of them here", "b"),
    (7, " ".join(f"w{i}" for i in range(3000)) + " w0 w1 w2 w3 w4", "b"),
]


def test_measures(spark):
    got = {
        (r.doc_id, r.text_key): r for r in quality_lines.text_measures(table(spark, ODD)).collect()
    }
    keys = table(spark, ODD).select("doc_id", "text", F.xxhash64("text").alias("k")).collect()
    for row in keys:
        text = row.text or ""
        words = WORD.findall(text)
        lines = [x for x in text.split("\n") if WORD.search(x)]
        r = got[row.doc_id, row.k]
        assert (r.n_words, r.word_chars) == (len(words), sum(map(len, words)))
        assert r.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert r.n_dup_lines == len(lines) - len(set(lines))
        assert r.n_repeat_words == repeat_words(words)


def test_boilerplate_is_counted_by_host_and_copies_count_once(spark):
    menu = "Home About Contact"
    terms = "Imprint and terms of use"
    rows = [(i, f"{menu}\n{terms}\nText number {i} of host a is its own and long enough indeed", "a") for i in range(30)]
    # other words, as numbers are one in normalised lines
    rows = [(i, t.replace(f"number {i}", "number " + "x" * (i + 1)), s) for i, t, s in rows]
    rows += [(100 + i, "A page that was copied\nto very many places of host b by someone else", "b") for i in range(40)]
    rows += [(200 + i, f"{menu}\nfew", "c") for i in range(5)]
    rows += [(300, f"home  ABOUT contact\n{terms}\nthis and that thing", "a")]
    out = {r.doc_id: r for r in quality_lines.judged(table(spark, rows), max_documents=20).collect()}
    assert all(out[i].removed == [0, 1] and out[i].kept for i in range(30))
    assert all(out[100 + i].removed is None and out[100 + i].kept for i in range(40))
    assert out[300].removed == [0, 1] and not out[300].kept and not out[300].base_failed
    kept = {r.doc_id: r for r in quality_lines.filtered(table(spark, rows), max_documents=20).collect()}
    assert set(kept) == set(range(30)) | {100 + i for i in range(40)}
    assert kept[3].text.startswith("Text number") and kept[3].n_chars == len(kept[3].text)
    assert kept[3].line == 8 and kept[3].kept == 7


def test_documents_are_told_apart_by_their_whole_text(spark):
    menu = "Home About Contact"
    notice = " ".join(["notice"] + [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(59)])
    # letters, as numbers are one in normalised lines
    own = lambda i: f"body {'x' * (i + 1)} " + " ".join(f"part{chr(97 + k)}" for k in range(18))
    rows = [(i, f"{menu}\n{notice}\n{own(i)}", "a") for i in range(30)]
    rows += [(100 + i, f"{menu}\n{notice}", "a") for i in range(5)]
    # copies are one document: 15 documents hold this menu, in 45 rows
    rows += [(200 + i, f"News Sport\n{own(i % 15)}", "b") for i in range(45)]
    # 25 of the host's 26 documents; the 3,000 copies of one count once for the host's share too
    rows += [(300 + i, f"Shop Cart\n{own(i)}", "c") for i in range(25)]
    rows += [(400 + i, "one page that was copied very many times by the host itself", "c") for i in range(3000)]
    out = {r.doc_id: r for r in quality_lines.judged(table(spark, rows), max_documents=20).collect()}
    assert all(out[i].removed == [0, 1] for i in range(30))
    assert all(out[100 + i].removed == [0, 1] and not out[100 + i].kept for i in range(5))
    assert all(out[200 + i].removed is None and out[200 + i].kept for i in range(45))
    assert all(out[300 + i].removed == [0] and out[300 + i].kept for i in range(25))
    assert all(out[400 + i].removed is None and out[400 + i].kept for i in range(3000))


    # the query's SQL says the same
    import duckdb

    from viewmart.llm.queries import QUALITY_SQL

    db = duckdb.connect()
    db.sql("create table documents (doc_id bigint, text varchar, source varchar)")
    db.executemany("insert into documents values (?, ?, ?)", [list(r) for r in [*rows, *ODD[:3]]])
    odd = {r.doc_id: r for r in quality_lines.judged(table(spark, [*rows, *ODD[:3]])).collect()}
    told = db.sql(f"select doc_id, kept, removed_words from ({QUALITY_SQL})").fetchall()
    assert len(told) == len(rows) + 3 and any(gone for _, _, gone in told)
    # numbers 1 to 3 stand in two rows with different texts
    assert all((odd[i].kept, odd[i].removed_words) == (kept, gone) for i, kept, gone in told if i > 3)


def test_quality_of_odd_rows_and_empty_tables(spark):
    out = quality_lines.judged(table(spark, ODD))
    assert out.count() == len(ODD)
    assert quality_lines.filtered(table(spark, ODD)).columns == table(spark, ODD).columns
    assert quality_lines.judged(table(spark, [])).count() == 0
    assert quality_lines.filtered(table(spark, [])).count() == 0


def later_lines(docs, limit):
    """All runs of ``limit`` words or more, first by document and place; the lines of later ones."""
    seen, gone = set(), {}
    for doc_id, text in sorted(docs):
        lines = [(i, x) for i, x in enumerate(text.split("\n")) if WORD.search(x)]
        for a in range(len(lines)):
            words = 0
            for b in range(a, len(lines)):
                words += len(WORD.findall(lines[b][1]))
                if words >= limit:
                    run = tuple(x for _, x in lines[a : b + 1])
                    if run in seen:
                        gone.setdefault(doc_id, set()).update(i for i, _ in lines[a : b + 1])
                    seen.add(run)
    return {d: sorted(x) for d, x in gone.items()}


def test_line_runs_equal_brute_force(spark):
    import random

    rng = random.Random(5)
    lines = ["a b c", "d e", "f", "g h i j k l m", "n", "o p q"]
    docs = []
    for i in range(60):
        picked = [rng.choice(lines) if rng.random() < 0.8 else f"own{i} line" for _ in range(rng.randint(0, 14))]
        picked.insert(rng.randint(0, len(picked)), rng.choice(["", "  "]))
        docs.append((i, "\n".join(picked)))
    frame = table(spark, [(i, t, "s") for i, t in docs])
    for limit in (1, 6, 10):
        got = {r.doc_id: r.lines for r in line_runs.later_copies(frame, limit).collect()}
        assert got == later_lines(docs, limit)


def test_line_runs_of_odd_rows(spark):
    long = "\n".join(f"line {i} of the long text that is here" for i in range(300))
    rows = [*ODD, (8, long, "a"), (8, long, "a"), (9, "before\n" + long + "\nafter", "a"), (None, long, "b")]
    frame = table(spark, rows)
    out = {}
    for r in line_runs.deduplicated(frame).collect():
        out.setdefault(r.doc_id, []).append(r.text)
    # the null id comes first, so its text stays and both rows of 8 lose all their lines
    assert 8 not in out and out[9] == ["before\nafter"] and len(out[4]) == 2
    assert out[1] == [None] and out[2] == [""]
    assert sorted(map(len, out[None])) == sorted([len(ODD[7][1]), len(long)])
    assert line_runs.deduplicated(frame).columns == frame.columns
    assert line_runs.later_copies(table(spark, [])).count() == 0


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def base_spans(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(found))


def test_base_spans_equal_python(spark):
    import random

    rng = random.Random(9)
    parts = [
        "token", "=", ": ", "\"", "api_key", "APIKEY", "é😀 ", "AKIA", "0123456789abcdef", "deadbeef" * 3, "Secret",
        "ABCDEFGH12345678", "x", " ", "\n", "passwd='", "abc.def/gh+", "short",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(300)]
    frame = table(spark, [(i, t, f"s{i}") for i, t in enumerate(texts)])
    base = F.filter("found", lambda s: s["kind"] < 3)
    got = {r.doc_id: r.s for r in secret_owners.reported(frame).select("doc_id", secret_owners.named(base).alias("s")).collect()}
    assert got == {i: base_spans(t) for i, t in enumerate(texts)}


def test_ownership_tells_examples_from_live_values(spark):
    example, live, plain = "q7Zk29XcVb31MnLp8RtY", "Zx81kQp04LmWn93VbTyU", "abcdefghijklmnopqrstuvwxyz"
    rows = [(i, f"use {example} here", f"o{i}") for i in range(6)]
    rows += [(10, f"key {live} ok {plain}", "o1"), (11, f"token={live}", "o1")]
    out = {
        r.doc_id: (r.s, [x.verdict for x in r.found])
        for r in secret_owners.reported(table(spark, rows)).select("*", secret_owners.named(F.col("found")).alias("s")).collect()
    }
    assert out[0] == ("", []) and out[5] == ("", [])
    assert out[10] == ("token:4:24", ["live"])
    assert out[11] == ("assign:0:26", ["live"])  # the token inside is covered


def test_repeated_rows_count_each_owner(spark):
    value = "q7Zk29XcVb31MnLp8RtY"
    one = [(1, f"use {value} here", f"o{k}") for k in range(3)]
    three = [(k, f"use {value} here", f"o{k}") for k in range(3)]
    for rows in (one, three):
        found = secret_owners.ownership(secret_owners.matches(table(spark, rows))).collect()
        assert [(r.owners, r.repositories) for r in found] == [(3, 3)]
        assert all(r.found == [] for r in secret_owners.reported(table(spark, rows)).collect())  # an example
    same = [(1, f"use {value} here", "o1")] * 5
    assert [len(r.found) for r in secret_owners.reported(table(spark, same)).collect()] == [1] * 5


def test_secrets_of_odd_rows(spark):
    rows = [*ODD, (8, None, None), (9, "token=abcdef12", None)]
    out = secret_owners.reported(table(spark, rows)).collect()
    assert len(out) == len(rows)
    assert sum(len(r.found) for r in out) == 1
    assert secret_owners.reported(table(spark, [])).count() == 0


def test_columns_named_as_helpers_keep_their_values(spark):
    from viewmart.llm import fragment_join

    names = ["__key", "__doc_id", "__text_key", "__removed", "__lines", "__KEY_"]
    rows = [(i, f"document {'x' * (i + 1)} has words of its own and no copy anywhere " + "y" * i, "a", *[f"mine {i}"] * 6) for i in range(4)]
    schema = "doc_id bigint, text string, source string, " + ", ".join(f"`{n}` string" for n in names)
    frame = spark.createDataFrame(rows, schema)
    for keep in (quality_lines.filtered, line_runs.deduplicated, fragment_join.one_of_each):
        out = keep(frame)
        assert out.columns == frame.columns and sorted(map(tuple, out.collect())) == rows
