import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from rowproof.llm import piece_lattice as lattice
from rowproof.llm import shards, token_files

from llm_samples import ODD, documents, prose

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def check_shards(rows, found, n):
    assert len(found) == len(rows)
    counts, slots = Counter(), defaultdict(list)
    for r in found:
        counts[r.shard] += 1
        slots[r.shard].append(r.slot)
    if rows:
        assert max(counts.values()) - min(counts[k] for k in range(n)) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in found) == want


@pytest.mark.parametrize("n", [1, 3, 24])
def test_shards_of_odd_rows(spark, n):
    found = shards.assign_shards(documents(spark, ODD), n).collect()
    check_shards(ODD, found, n)


def test_groups_stay_together_where_there_is_room(spark):
    rows = [(k, f"hot text {0 if k % 3 == 0 else k // 7}") for k in range(1200)]
    found = shards.assign_shards(documents(spark, rows), 8).collect()
    check_shards(rows, found, 8)
    text, where, size = dict(rows), defaultdict(set), Counter(t for _, t in rows)
    for r in found:
        where[text[r.doc_id]].add(r.shard)
    # The hot group needs three shards at least; else only the cuts between shards part a group.
    assert len(where["hot text 0"]) <= 6
    assert sum(len(v) > 1 for t, v in where.items() if t != "hot text 0") <= 30  # of 171
    assert len(size) == len(where)


def test_shards_of_an_empty_table(spark):
    assert shards.assign_shards(documents(spark, []), 24).collect() == []


def texts():
    random.seed(4)
    signs = list("abcdeé  \n\t▁.,漢字́😀'0123==  --")
    out = ["".join(random.choice(signs) for _ in range(random.randrange(80))) for _ in range(300)]
    return out + [" " * k + "x" for k in range(40)] + ["=" * k + " " * k for k in range(30)] + ["It's don't WE'LL. A.B..c <|endoftext|>x"]


def test_pieces_equal_the_library(spark, monkeypatch):
    monkeypatch.setattr(lattice, "CHUNK_CHARS", 37)
    rows = ODD[:-1] + [(50 + k, t) for k, t in enumerate(texts())] + [(11, prose(1, 2000))]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    docs = documents(spark, rows)
    encoded = lattice.encode(docs.drop("ids"), PIECES)
    want = Counter((i, tuple(model.encode(t or ""))) for i, t in rows)
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, '<u4').tolist())) for r in encoded.select("doc_id", "ids").collect()) == want
    back = lattice.decoded(encoded, PIECES, "ids", "again").select("text", "again").collect()
    assert all(r.again == (r.text or "").replace("▁", " ") for r in back)
    report = lattice.encoding_report(docs, PIECES).collect()
    assert all(r.round_trip for r in report)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in report) == Counter(
        (i, len(v), zlib.crc32(np.array(v, "<u4").tobytes())) for i, v in want.elements()
    )


def test_report_carries_the_ids(spark, monkeypatch):
    monkeypatch.setattr(lattice, "CHUNK_CHARS", 300)
    rows = [(1, None), (2, ""), (3, "one two"), (3, "one two"), (None, "é漢字 😀"), (4, prose(8, 400))]
    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    want = Counter((i, np.array(model.encode(t or ""), "<u4").tobytes()) for i, t in rows)
    report = lattice.encoding_report(documents(spark, rows), PIECES).collect()
    assert Counter((r.doc_id, bytes(r.ids)) for r in report) == want


def test_scan_is_associative():
    random_ = np.random.default_rng(2)
    m = [np.where(random_.random((4, 4)) < 0.5, random_.random((4, 4)), -np.inf) for _ in range(9)]
    so_far = lattice.prefixes(m)
    step = m[0]
    for k in range(1, 9):
        step = lattice.max_plus(step, m[k])
        assert np.allclose(so_far[k], step, equal_nan=True)


def test_pieces_of_an_empty_table(spark):
    assert lattice.encoding_report(documents(spark, []), PIECES).collect() == []


def test_token_files_equal_the_library(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "SHARD_BYTES", 3000)
    monkeypatch.setattr(token_files, "PART_KEYS", 50)
    rows = ODD + [(50 + k, t) for k, t in enumerate(texts())]
    docs = documents(spark, rows)
    files = token_files.write_token_files(docs, str(tmp_path / "files"), WORDS)
    tokenizer = Tokenizer.from_file(WORDS)
    ids = {t: [*tokenizer.encode(t or "", add_special_tokens=False).ids, 2] for _, t in rows}
    found = token_files.file_report(docs, files).collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == Counter(
        (i, len(ids[t]), zlib.crc32(np.array(ids[t], "<u4").tobytes())) for i, t in rows
    )
    at = 0
    for r in sorted(found, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: -1 if i is None else i)
    keys = spark.createDataFrame([(k,) for k in (50, 60, 9, -5, 10**9)], "doc_id bigint")
    read = {r.doc_id: r.ids for r in files.read(keys).collect()}
    assert read == {k: ids[dict(rows)[k]] for k in (50, 60, 9)}
    assert {r.doc_id: r.copies for r in files.lookup(docs).collect()}[6] == 2


def test_perfect_hash_is_minimal():
    keys = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 5000)
    for n in (1, 2, 3, 10, 5000):
        hashed = token_files.PerfectHash.build(keys[:n])
        assert sorted(hashed.slots(keys[:n]).tolist()) == list(range(n))


def test_token_files_of_an_empty_table(spark, tmp_path):
    docs = documents(spark, [])
    files = token_files.write_token_files(docs, str(tmp_path / "none"), WORDS)
    assert token_files.file_report(docs, files).collect() == []


def test_a_name_that_is_taken(spark):
    import pytest

    docs = documents(spark, ODD)
    with pytest.raises(ValueError, match="already"):
        lattice.encode(docs, PIECES)
    with pytest.raises(ValueError, match="already"):
        lattice.decoded(docs, PIECES, "ids", "text")


def test_generations_of_memory_keep_results():
    pieces = lattice.Pieces.load(PIECES)
    texts = [prose(k % 7, 300, vocabulary=50 + k) + "\n" + "  two  blanks \x00 ▁" * (k % 2) for k in range(40)]
    want = [lattice.packed(lattice_model().encode(t)) for t in texts]
    lattice_words = lattice.CACHE_WORDS
    try:
        lattice.CACHE_WORDS = 20
        assert [pieces.encode([t])[0] for t in texts] == want
    finally:
        lattice.CACHE_WORDS = lattice_words
    assert lattice.decode_all(pieces, want) == [t.replace(lattice.MARK, " ") for t in texts]


def lattice_model():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def test_other_kinds_of_models_are_refused():
    import public_tokenizers
    import pytest

    with pytest.raises(ValueError, match="lower-case"):
        token_files.load_encoder(public_tokenizers.path("byte_bpe_50k.json"))
