"""Every stage of the pipeline on the documents of sf0.001 against a brute-force version of it."""

from collections import defaultdict

import duckdb
import pytest
from test_corpus import brute_leaks, components
from test_text_rules import ODD, later_lines, table

import __spark_entry__
import corpus_pipeline
from viewmart.llm.common import materialised, tokenizer_path
from viewmart.llm.queries import QUALITY_SQL

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def outputs(spark):
    """The input and each stage's result."""
    frames = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(materialised(stage(spark, frames[-1], SF), f"test-{name}"))
    return frames


def texts(frame):
    return {r.doc_id: r.text for r in frame.collect()}


def test_stages(outputs):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_runs", "near", "benchmark", "packing"]
    assert all(f.columns == outputs[0].columns for f in outputs[:-1])
    assert all(r.n_chars == len(r.text) for f in outputs[1:-1] for r in f.collect())


def test_quality_stage(outputs):
    db = duckdb.connect()
    db.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    rows = db.sql(f"select doc_id, kept, removed_words from ({QUALITY_SQL})").fetchall()
    before, after = texts(outputs[0]), texts(outputs[1])
    assert set(after) == {d for d, kept, _ in rows if kept}
    assert all(after[d] == before[d] for d, kept, gone in rows if kept and not gone)


def test_line_stage(outputs):
    before, after = texts(outputs[1]), texts(outputs[2])
    gone = later_lines(list(before.items()), 50)
    expected = {}
    for d, text in before.items():
        left = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone.get(d, ()))
        if left.strip() or d not in gone:
            expected[d] = left
    assert after == expected and gone


def test_near_stage(outputs):
    before, after = texts(outputs[2]), texts(outputs[3])
    parts = components(list(before.items()), words=5, percent=80)
    assert after == {d: before[d] for d, (_, least) in parts.items() if d == least}


def test_benchmark_stage(spark, outputs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = texts(outputs[3]), texts(outputs[4])
    leaky = {d for d, _ in brute_leaks(list(before.items()), items)}
    assert after == {d: t for d, t in before.items() if d not in leaky} and leaky


def test_packing_stage_and_run(spark, outputs):
    tokenizers = pytest.importorskip("tokenizers")
    plain = tokenizers.Tokenizer.from_file(tokenizer_path())
    documents = texts(outputs[4])
    for rows in (outputs[5].collect(), __spark_entry__.queries()["pipeline"](spark, SF).collect()):
        pieces = defaultdict(list)
        for r in rows:
            pieces[r.doc_id].append(r)
        assert set(pieces) == set(documents)
        for d, own in pieces.items():
            own.sort(key=lambda r: r.start)
            assert [r.start for r in own] == [sum(r.length for r in own[:k]) for k in range(len(own))]
            ids = plain.encode(documents[d], add_special_tokens=False).ids
            assert sum(r.length for r in own) == len(ids) + 1 == own[0].doc_tokens


def test_odd_rows_and_empty_tables(spark):
    for rows in (ODD, []):
        docs = table(spark, rows)
        for name, stage in corpus_pipeline.STAGES:
            out = materialised(stage(spark, docs, SF), f"test-{name}")
            if name != "packing":
                assert out.columns == docs.columns
                docs = out
        assert out.count() >= (1 if rows else 0)
