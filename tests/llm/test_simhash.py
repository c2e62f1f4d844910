import numpy as np
import pytest
import xxhash

from rowproof.llm import simhash
from rowproof.llm.components import components

from llm_samples import ODD, documents, prose


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    width = min(3, len(words))
    hashes = [
        xxhash.xxh64_intdigest(b" ".join(words[k:k + width]), 42) for k in range(len(words) - width + 1)
    ] if words else []
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    """{row number: smallest doc_id reachable} by comparing all pairs."""
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if (rows[a][1] ^ rows[b][1]).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[find(k)] = min(least.get(find(k), doc_id), doc_id)
    return [least.get(find(k)) for k in range(len(rows))]


def near_copies(n):
    base = prose(3, 400).split()
    return [" ".join(base[:50 + k] + ["changed"] + base[51 + k:]) for k in range(n)]


def test_equals_brute_force(spark):
    rows = ODD + [(100 + k, t) for k, t in enumerate(near_copies(40))] + [(200 + k, prose(9, 40)) for k in range(5)]
    found = simhash.near_duplicates(documents(spark, rows)).collect()
    want = plain_components([(i, plain_fingerprint(t)) for i, t in rows])
    expected = sorted(((i, plain_fingerprint(t), c) for (i, t), c in zip(rows, want, strict=True)), key=str)
    assert sorted(((r.doc_id, r.fp & (1 << 64) - 1, r.component_id) for r in found), key=str) == expected


def test_long_texts_are_hashed_in_parts(monkeypatch):
    text = prose(5, 900).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "_HASHES_AT_ONCE", 7)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text.decode())


@pytest.mark.parametrize("parts", [2, 4, 8, 16])
def test_no_link_is_lost_for_any_cut_of_the_fingerprint(spark, monkeypatch, parts):
    monkeypatch.setattr(simhash, "parts_for", lambda n: parts)
    monkeypatch.setattr(simhash, "TILE_ROWS", 8)
    monkeypatch.setattr(simhash, "TILE_VISITORS", 16)
    random = np.random.default_rng(parts)
    centres = random.integers(0, 1 << 63, 12, dtype=np.uint64)
    fps = set(centres.tolist())
    for c in centres.tolist():
        for _ in range(25):
            fps.add(c ^ (1 << int(random.integers(64))) ^ (1 << int(random.integers(64))))
    fps = sorted(fps)
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in signed], "fp bigint"), len(fps))
    root = {r.node: r.root for r in components(links).collect()}
    want = plain_components([(s, f) for s, f in sorted(zip(signed, fps, strict=True))])
    assert [root.get(s, s) for s in sorted(signed)] == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 101), (5, 5)], "a bigint, b bigint")
    assert {r.node: r.root for r in components(edges).collect()} == {**{k: 0 for k in range(1, 61)}, 101: 100}


def test_one_of_each_keeps_the_smallest_and_the_nameless(spark):
    docs = documents(spark, ODD)
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.select("doc_id").collect()), key=str)
    # 1, 2 and 3 have no words; 6 (twice) and 7 differ in case only.
    assert ids == sorted([None, None, 1, 4, 5, 6, 6, 8, 9, 10, 11], key=str)


def test_one_of_each_keeps_a_document_of_every_class(spark):
    a, b, c = prose(21, 60), prose(22, 60), prose(23, 60)
    rows = [(3, a), (5, a), (5, b), (7, b), (7, c), (5, None), (8, ""), (9, c)]
    kept = simhash.one_of_each(documents(spark, rows))
    # 5 is the smallest of b and of the texts without words, 7 of c, although both repeat a smaller one.
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted([(3, a), (5, b), (5, None), (7, c)], key=str)


def test_empty_table(spark):
    assert simhash.near_duplicates(documents(spark, [])).collect() == []
    assert simhash.one_of_each(documents(spark, [])).collect() == []


def test_one_row_of_each_component(spark):
    a, b = prose(21, 60), prose(22, 60)
    rows = [*ODD, (30, a), (29, a), (29, a), (None, a), (None, b), (None, b), (40, a + " "), (41, None), (41, None)]
    docs = documents(spark, rows).repartition(3)
    kept = simhash.one_row_of_each(docs)
    assert kept.columns == docs.columns
    found = kept.select("doc_id", "text").collect()
    assert sorted((r.doc_id for r in found), key=str) == sorted([1, None, 4, 5, 6, 8, 9, 10, 11, 29, None], key=str)
    assert {r.text for r in found if r.doc_id is None} == {"no name here", b}
    assert simhash.one_row_of_each(docs.limit(0)).collect() == []
