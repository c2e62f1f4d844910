"""Token alignment against a plain two-pointer merge and the two libraries."""

import hashlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from rowproof.llm import token_alignment
from rowproof.llm.queries import BYTE_TOKENIZER, PIECE_MODEL, QUERIES
from rowproof.llm.token_alignment import TokenizerPair, align_texts, merge_cuts, merge_pieces
from llm_samples import ODD, documents

BOTH = TokenizerPair.load(BYTE_TOKENIZER, PIECE_MODEL)
LIBRARY = Tokenizer.from_file(BYTE_TOKENIZER)
LIBRARY.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
DECODED = token_alignment._byte_of_char()
DATA = "/root/testdata/sf0.01"


@settings(max_examples=200, deadline=None)
@given(st.sets(st.integers(1, 60)), st.sets(st.integers(1, 60)), st.integers(1, 9))
def test_pieces_equal_one_merge(a, b, piece):
    a, b = sorted(a | {61}), sorted(b | {61})
    found = [x.tolist() for x in merge_pieces(np.array(a), np.array(b), piece)]
    ends = sorted({*a, *b})
    assert found[0] == [sum(x < e for x in a) for e in ends]
    assert found[1] == [sum(x < e for x in b) for e in ends]
    assert found[2] == [e in a and e in b for e in ends]
    i, j = merge_cuts(np.array(a), np.array(b), piece)
    assert (np.diff(i) + np.diff(j)).max() <= piece + 1


def plain(text):
    """(a ids, b ids, [(a tokens, b tokens)] of groups, links) by walking along the bytes."""
    if not text:
        return [], [], [], []
    a, b = LIBRARY.encode(" " + text, add_special_tokens=False), PIECES.encode(text)
    a_bytes = [bytes(DECODED[c] for c in t) for t in a.tokens]
    pieces = [PIECES.id_to_piece(k) for k in b]
    b_bytes = [bytes([int(p[3:5], 16)]) if PIECES.is_byte(k) else p.replace("▁", " ").encode() for k, p in zip(b, pieces, strict=True)]
    whole = (" " + text).encode()
    if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
        return [], [], [], []
    ids = a.ids
    i = j = 0
    groups, links, side_a, side_b = [], [], [0], [0]
    at_a, at_b = len(a_bytes[0]), len(b_bytes[0])
    while True:
        links.append((ids[i], b[j]))
        if at_a == at_b:
            groups.append(([ids[k] for k in side_a], [b[k] for k in side_b]))
            if i + 1 == len(ids):
                return ids, b, groups, links
            i, j, side_a, side_b = i + 1, j + 1, [i + 1], [j + 1]
            at_a, at_b = at_a + len(a_bytes[i]), at_b + len(b_bytes[j])
        elif at_a < at_b:
            i += 1
            side_a.append(i)
            at_a += len(a_bytes[i])
        else:
            j += 1
            side_b.append(j)
            at_b += len(b_bytes[j])


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def expected(rows):
    found = [(key, *plain(text)) for key, text in rows]
    docs = Counter(pair for *_, links in found for pair in set(links))
    best = defaultdict(int)
    for (a, _), n in docs.items():
        best[a] = max(best[a], n)
    return sorted(((key, len(a), len(b), len(groups), len(links), sum(docs[p] == best[p[0]] for p in links), sum(docs[p] for p in links),
                    hashlib.sha256(written(groups).encode()).hexdigest() if groups else "") for key, a, b, groups, links in found), key=str)


ALPHABET = st.sampled_from(["a", "the", " ", "  ", "\n", "\t", "é", "漢", "😀", "<|endoftext|>", "</s>", "<0x41>", ".", "'s", "12", "\x00", " ", "ﬁ", "don't"])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(ALPHABET, max_size=12).map("".join), min_size=1, max_size=4))
def test_groups_of_any_texts(texts):
    found = align_texts(BOTH, texts)
    for k, text in enumerate(texts):
        a, b, groups, links = plain(text)
        assert (found.n_a[k], found.n_b[k], found.n_groups[k]) == (len(a), len(b), len(groups))
        assert found.groups[k].decode() == written(groups)
        assert found.times[k].sum() == len(links) and len(found.pairs[k]) == len(set(links))


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("shared", [2_000_000, 0])
def test_report_of_odd_rows(spark, monkeypatch, shared):
    # Both ways of bringing the counts to the documents.
    monkeypatch.setattr(token_alignment, "SHARED_PAIRS", shared)
    docs = documents(spark, ODD).repartition(3)
    aligned = token_alignment.align(docs, BOTH)
    rows = token_alignment.alignment_report(aligned, BOTH).select(COLUMNS).collect()
    assert sorted(map(tuple, rows), key=str) == expected([r[:2] for r in ODD])
    assert token_alignment.alignment_report(token_alignment.align(docs.limit(0), BOTH), BOTH).collect() == []


def test_groups_are_kept_when_wanted(spark):
    row = token_alignment.align(documents(spark, [(1, "Hello world, naïve")]), BOTH).first()
    assert row["groups"] == written(plain("Hello world, naïve")[2])


def test_another_kind_of_tokenizer_is_refused():
    with pytest.raises((ValueError, KeyError)):
        TokenizerPair.load(public_tokenizers.path("word_bpe_49k.json"), PIECE_MODEL)


@pytest.mark.skipif(not Path(DATA).exists(), reason="given tables are not here")
def test_query_over_given_documents(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_token_alignment"](spark, DATA).select(COLUMNS).collect()
    assert sorted(map(tuple, found), key=str) == expected(rows)
