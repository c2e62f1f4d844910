import hashlib
import re

from rowproof.llm import decontaminate as d

from llm_samples import ODD, documents, prose

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORDS.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(rows, items):
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for s in range(len(w) - n + 1 if w else 0):
            windows.setdefault(tuple(w[s:s + n]), set()).add(str(item))
    out = []
    for doc_id, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in windows:
                    hit |= set(range(s, s + n))
                    found |= windows[tuple(w[s:s + n])]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc_id, len(w), len(hit), len(found), digest, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


ITEMS = [(1, prose(1, 40)), (2, prose(2, 13)), (10, "A short, ITEM"), (3, "one"), (4, ""), (5, None), (2, prose(2, 13)),
         (11, prose(1, 40)), (12, "w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1 w1")]
ROWS = ODD + [
    (20, prose(1, 60)), (21, "x " * 30 + prose(2, 13)), (22, prose(2, 12)), (23, "a SHORT-item; a short item"),
    (24, " ".join(prose(1, 40).split()[:20]) + " " + prose(50, 900)), (25, "w1 " * 40), (26, prose(1, 40) + " " + prose(2, 13)),
]


def benchmark(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id bigint, text string")


def report(spark, rows=ROWS, items=ITEMS):
    found = d.contamination_report(documents(spark, rows), benchmark(spark, items))
    return sorted((tuple(r) for r in found.collect()), key=str)


def test_equals_brute_force(spark):
    assert report(spark) == plain(ROWS, ITEMS)


def test_long_documents_in_pieces_and_benchmarks_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(d, "SHARD_WORDS", 17)
    assert report(spark) == plain(ROWS, ITEMS)
    monkeypatch.setattr(d, "BLOCK_WORDS", 40)
    assert report(spark) == plain(ROWS, ITEMS)


def test_longest_match_and_its_place(spark):
    item = prose(1, 40)
    found = d.find_contamination(documents(spark, [(1, "x y " + " ".join(item.split()[5:30]) + " z")]), benchmark(spark, [(7, item)]), "m")
    m = found.select("m.matches", "m.hits").first()
    assert [tuple(x) for x in m.matches] == [("7", 2, 5, 25)]
    assert [tuple(x) for x in m.hits] == [(2, 27)]


def test_removal_keeps_clean_rows_and_columns(spark):
    docs = documents(spark, ROWS)
    kept = d.remove_contaminated(docs, benchmark(spark))
    assert kept.columns == docs.columns
    want = [r[0] for r in plain(ROWS, ITEMS) if not r[5]]
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(want, key=str)


def test_empty_tables(spark):
    assert report(spark, rows=[]) == []
    assert report(spark, items=[]) == plain(ROWS, [])


def test_a_block_is_small_in_memory():
    import resource

    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    items = [(str(k), prose(k, 5_000, vocabulary=60_000).encode()) for k in range(200)]
    tests = d.TestSuffixes(items)  # a million words, as many as a block holds
    assert len(tests.lengths) > 990_000
    assert resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 700_000  # KB


def test_a_name_that_is_taken(spark):
    import pytest

    with pytest.raises(ValueError, match="already"):
        d.find_contamination(documents(spark, ROWS), benchmark(spark), "FP")
