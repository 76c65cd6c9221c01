"""Chat formatting and packing: exact round trips."""

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from viewmart.llm import chat_grammar, level_packing
from viewmart.llm.common import tokenizer_path

tokenizers = pytest.importorskip("tokenizers")

PIECES = st.lists(
    st.sampled_from(["\\", "### ", "</turn>", "\n", "### Assistant: ", ":", " ", "#", "é", "text", "</turn", "%41"]), max_size=12
).map("".join)


@settings(max_examples=400, deadline=None)
@given(PIECES, st.sampled_from(["user", "assistant", "", "Tool: x", "%User", "Ünïcode", "a b\\"]))
def test_turn_round_trip(text, role):
    rendered, start, end, escaped = chat_grammar.round_trip(role, text)
    assert chat_grammar.parse(rendered) == [(role, text)]
    assert chat_grammar.unescape(rendered[start:end]) == text
    assert escaped == (rendered[start:end] != text) or escaped


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), PIECES), max_size=5))
def test_conversation_round_trip(turns):
    assert chat_grammar.parse("".join(chat_grammar.round_trip(*t)[0] for t in turns)) == turns


def test_outside_the_grammar():
    for bad in ["x", "### User: open", "### User: a### b\n</turn>\n", "### User: a</turn>\n"]:
        with pytest.raises(ValueError):
            chat_grammar.parse(bad)


def test_digests(spark):
    rows = [
        (1, 1, "assistant", r"\### Assistant: </turn> ok", 5),
        (1, 0, "user", "hi", 5),
        (2, None, None, None, 5),
        (None, 0, "assistant", "x" * 50_000, 5),
        (None, 0, "assistant", "y", 5),
        (2**60 + 1, 0, "assistant", "", 5),
        *[(7, k, "assistant", "ab", 5) for k in range(25_000)],
    ]
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, rendered int")
    out = {r.conv_id: r for r in chat_grammar.digests(chat_grammar.formatted(frame)).collect()}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert set(out) == {1, 2, None, 2**60 + 1, 7}
    assert out[1].turns_sha256 == sha("user\nhi\nassistant\n" + rows[0][3] + "\n")
    assert (out[1].loss_sha256, out[1].loss_chars) == (sha(rows[0][3]), len(rows[0][3]))
    assert (out[2].n_turns, out[2].turns_sha256, out[2].loss_chars) == (1, sha("\n\n"), 0)
    assert out[None].loss_sha256 == sha("x" * 50_000 + "y")
    assert (out[7].n_turns, out[7].loss_chars) == (25_000, 50_000)
    empty = spark.createDataFrame([], frame.schema)
    assert chat_grammar.digests(chat_grammar.formatted(empty)).count() == 0


TEXTS = [
    "", "a", "  two  spaces ", "line\n\nbreak \n x", " lead", "tab\tand nbsp  end ", "it's 12,345.67 we've",
    "é" * 300, "no-space" * 400, "<|endoftext|> a<|endoftext|>b", "emoji 😀 😀\r\n ok", "\x1c odd \x85 white  space",
]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from(" \n\t\r\x1c\x85  ab'1é."), max_size=30), max_size=4))
def test_encoder_equals_tokenizer(texts):
    plain = tokenizers.Tokenizer.from_file(tokenizer_path()) if not hasattr(test_encoder_equals_tokenizer, "t") else test_encoder_equals_tokenizer.t
    test_encoder_equals_tokenizer.t = plain
    for text, ids in zip(texts, level_packing.encoder(tokenizer_path()).encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def packed_rows(spark, rows, size=1024, parts=3, **more):
    frame = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, offset int").repartition(parts, "doc_id")
    return level_packing.packed(frame, tokenizer_path(), size, **more).collect()


@pytest.mark.parametrize("size,max_open", [(64, 4096), (64, 5), (1024, 4096)])
def test_packing_holds_each_id_once_and_pads_nothing(spark, size, max_open):
    rng = np.random.default_rng(3)
    words = ["alpha", "beta", "of", "the", "thanedble", "."]
    rows = [(k, " ".join(rng.choice(words, rng.integers(0, 160)))) for k in range(150)]
    rows += [(900 + k, t) for k, t in enumerate(TEXTS)] + [(990, None)]
    out = packed_rows(spark, rows, size, max_open=max_open)
    plain = tokenizers.Tokenizer.from_file(tokenizer_path())
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in out:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    assert set(by_doc) == {k for k, _ in rows}
    for doc, text in rows:
        ids = np.array([*plain.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        pieces = sorted(by_doc[doc], key=lambda r: r.start)
        assert [r.start for r in pieces] == np.cumsum([0, *(r.length for r in pieces[:-1])]).tolist()
        assert sum(r.length for r in pieces) == len(ids) and {r.doc_tokens for r in pieces} == {len(ids)}
        for r in pieces:
            assert r.ids_crc32 == zlib.crc32(ids[r.start : r.start + r.length].tobytes())
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        assert [r.offset for r in pieces] == np.cumsum([0, *(r.length for r in pieces[:-1])]).tolist()
        total = sum(r.length for r in pieces)
        assert total <= size and total & (total - 1) == 0


def test_packing_of_repeated_rows_and_empty_tables(spark):
    out = packed_rows(spark, [(1, "same"), (1, "same"), (None, "x")])
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in out) == [(0, 2), (1, 2), (1, 2)]
    assert packed_rows(spark, []) == []
    with pytest.raises(ValueError):
        packed_rows(spark, [(1, "x")], size=1000)


def test_placement_makes_the_sum_of_squares_least():
    rng = np.random.default_rng(1)
    packer = level_packing.Packer(16, 0)
    for k in range(400):
        length = int(rng.integers(1, 16))
        counts = packer.counts.copy()
        options = []
        for level in range(0, 17 - length):
            if level == 0 or counts[level]:
                after = counts.copy()
                if level:
                    after[level] -= 1
                if level + length < 16:
                    after[level + length] += 1
                options.append(int((after**2).sum()))
        packer.add(k, b"\0\0\0\0" * length)
        assert int((packer.counts**2).sum()) == min(options)
