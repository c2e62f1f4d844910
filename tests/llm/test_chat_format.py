"""Chat formatting: exact round trips, reserved ids, masks and digests."""

import hashlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from rowproof.llm import chat_format, turn_chunks
from rowproof.llm.chat_format import ChatTemplate, escape, unescape

TEMPLATE = ChatTemplate.load(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
TEXT = st.lists(st.sampled_from(["\\", "<|", "<", "|", "<|turn|>", "<|end|>", "ok", " ", "\n", "é漢😀", "\x00"]), max_size=9).map("".join)


@given(TEXT)
def test_escape_is_undone_and_hides_control_strings(text):
    assert unescape(escape(text)) == text
    assert chat_format.OPENER not in escape(text)


@settings(deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "<|body|>\\"]), TEXT), max_size=6))
def test_ids_and_formatted_text_read_back(turns):
    ids, mask = TEMPLATE.assemble(turns)
    formatted = TEMPLATE.formatted(ids)
    assert TEMPLATE.read(ids, mask) == (turns, "".join(t for r, t in turns if r == "assistant"), len(formatted))
    assert TEMPLATE.parse(formatted) == turns
    # Each segment is encoded on its own: between reserved ids stands what its text alone gives.
    plain = [k for role, text in turns for s in (role, text) for k in TEMPLATE._encoding.encode_ordinary(escape(s))]
    assert ids[ids < TEMPLATE.reserved[0]].tolist() == plain


def expected(rows):
    by = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0)):
        by.setdefault(conv, []).append((role or "", text or ""))
    out = []
    for conv, turns in by.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        said = "".join(f"{r}\n{t}\n" for r, t in turns)
        chars = sum(len(escape(r)) + len(escape(t)) + sum(map(len, chat_format.CONTROL)) for r, t in turns)
        out.append((conv, len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), chars))
    return sorted(out, key=str)


SCHEMA = "conv_id bigint, turn bigint, role string, text string, ids string, part string"


def report(rows):
    written = chat_format.format_chats(rows, TEMPLATE)
    found = chat_format.chat_report(written, TEMPLATE)
    return sorted((tuple(r) for r in found.select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars").collect()), key=str)


@pytest.mark.parametrize("chunk_rows", [1024, 2])
def test_report_of_odd_rows(spark, monkeypatch, chunk_rows):
    monkeypatch.setattr(turn_chunks, "CHUNK_ROWS", chunk_rows)
    rows = [
        (None, None, None, None), (None, 3, "assistant", "<|end|>"), (1, None, "system", "first"), (1, 0, "user", None),
        (1, 1, "assistant", ""), (2, 0, "assistant", "same"), (2, 0, "assistant", "same"), (3, 7, "tool", "x" * 300_000),
        (-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok"),
        *[(9, k, "user" if k % 2 else "assistant", f"turn {k} \\ <|") for k in range(40)],
    ]
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(3)
    assert report(frame) == expected(rows)
    assert report(frame.limit(0)) == []


def test_mask_covers_assistant_texts_alone(spark):
    ids, mask = TEMPLATE.assemble([("user", "hi"), ("assistant", "a b"), ("assistant", ""), ("assistant", "c")])
    assert mask.sum() == len(TEMPLATE._ids("a b")) + len(TEMPLATE._ids("c"))
    assert not (mask & np.isin(ids, TEMPLATE.reserved)).any()
